import os
import random

import numpy as np
import pytest
from helpers import docs_of, prose, sha

from affinis.llm import bpe
from affinis.llm.queries import TOKENIZER, op3

pytestmark = pytest.mark.skipif(not os.path.exists(TOKENIZER), reason="the tokenizer's file is not here")
tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(TOKENIZER)


def odd_texts():
    rng = random.Random(4)
    planes = [(32, 127), (1, 0x3000), (0xA0, 0x250), (0x1F300, 0x1F700), (0x10000, 0x1FFFF), (0xA000, 0xD7FF)]
    random_ones = ["".join(chr(rng.randrange(*rng.choice(planes))) for _ in range(60)) for _ in range(600)]
    return [
        "", "  ", "\n\t", "aaaa aaaaaaa aaa", "Hello<|endoftext|>World <|startoftext|>", "<|endoftext|><|endoftext|>", "it's WE'LL 12345 !!!?? x y\x1cz\x85q",
        "ΣΑΣ ΟΔΟΣ. İI Ǆ ﬁ é é 日本語 😀😀 ÀÉ", "a\x00b\tc", "ẞ ŉ lll'll 'S 'ſ", "᠎​﻿x ½²³ ⅷ", "ｈｅｌｌｏ", "x" * 50_000, *random_ones,
    ]


def test_ids_and_texts_equal_the_library(library):
    rng = random.Random(5)
    texts = odd_texts() + [prose(rng, 300) for _ in range(30)]
    known = bpe.vocabulary(TOKENIZER)
    ids = bpe.encode(texts, known)
    want = library.encode_batch(texts, add_special_tokens=False)
    assert [x.tolist() for x in ids] == [x.ids for x in want]
    assert [t.decode() for t in bpe.decode(ids, known)] == [library.decode(x.ids, skip_special_tokens=False) for x in want]


def test_query_digests(spark, library, tmp_path, monkeypatch):
    texts = [*odd_texts()[:30], None, "two", "two"]
    docs_of(spark, texts).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(bpe, "TEXT_CHARS", 1_000)
    monkeypatch.setattr(bpe, "OUT_TOKENS", 100)  # several flushes
    got = {r.doc_id: r for r in op3(spark, str(tmp_path)).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == sha(np.array(ids, "<u4").tobytes())
        assert got[i].decoded_sha256 == sha(library.decode(ids, skip_special_tokens=False))


def test_empty_table_and_null_id(spark):
    docs = docs_of(spark, ["a b"])
    assert bpe.coded(docs.limit(0), TOKENIZER).count() == 0
    row = bpe.coded(spark.createDataFrame([(None, "a b", 3)], "doc_id long, text string, ids int"), TOKENIZER).first()
    assert row.doc_id is None and row.n_tokens == 2 and row.decoded == "a</w> b</w>"
