import hashlib
import random

import corpus_pipeline
import numpy as np
import pytest
from helpers import DOCS, components, contained, prose, without_repeats

from affinis.llm import toxicity
from affinis.llm.queries import TOKENIZER

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    rng = random.Random(9)
    items = [prose(rng, 30) for _ in range(5)]
    passage = prose(rng, 55)
    rows, labels = [], []
    for i in range(400):
        words = prose(rng, rng.randrange(20, 120)).split()
        toxic = int(i % 5 == 0)
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["grumpfish", "zorgblat"]))
        text = " ".join(words)
        if i % 17 == 1:
            text = f"{text} {rng.choice(items)} {prose(rng, 20)}"
        if i % 11 == 2:
            text = f"{prose(rng, 80)} {passage} {text}"
        if i % 13 == 3 and rows:
            text = rows[rng.randrange(len(rows))][1]
        rows.append((i, text, "en", "s", len(text or "")))
        labels.append((i, 1, toxic if i % 13 != 3 else int(any(w in (text or "") for w in ("grumpfish", "zorgblat")))))
    rows += [(400, None, None, None, None), (401, "", "en", "s", 0)]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, items


def test_run_against_brute_force(spark, tables):
    folder, rows, items = tables
    model = toxicity.fit(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    lexicon = toxicity.Lexicon(model.lexicon)
    docs = [(i, t) for i, t, *_ in rows if model.score(lexicon.marks(t)) < 0.7]
    assert 60 < len(rows) - len(docs) < 110
    roots = components([t for _, t in docs])
    after = [d for at, d in enumerate(docs) if roots[at] == at]
    assert len(after) < len(docs)
    cut = [(i, kept if gone else t) for (i, t), (_, gone, kept) in zip(after, without_repeats([t for _, t in after]), strict=True)]
    clean = [(i, t) for i, t in cut if not any(contained(t, item) for item in items)]
    assert len(clean) < len(cut)
    library = tokenizers.Tokenizer.from_file(TOKENIZER)
    want = {i: library.encode(t or "", add_special_tokens=False).ids for i, t in clean}
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in corpus_pipeline.run(spark, folder).collect()}
    assert got == want


def test_stages_keep_columns_and_take_empty_tables(spark, tables):
    folder, *_ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and out.count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == 0


def test_last_stage_decodes(spark, tables):
    folder, *_ = tables
    texts = ["Some words, and MORE of them.", "naïve 日本 <|endoftext|> x", "", None]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS)
    library = tokenizers.Tokenizer.from_file(TOKENIZER)
    got = {r.doc_id: r.decoded_sha256 for r in corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert got[i] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
