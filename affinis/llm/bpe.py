"""Byte-pair encoding with a pair occurrence index, and decoding.

The distinct words of a stretch of a partition are laid out as one linked list of
symbols. An index maps the rank of every pair that occurs to all its positions. The
smallest active rank is taken, all its positions are merged at once, and the pairs
that arise to the left and right are entered under their ranks. A text's ids are
then put together from its words.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from affinis.llm.tasks import give_back, releasing

TEXT_CHARS = 16 << 20  # of text whose distinct words are merged together
OUT_TOKENS = 1 << 20  # in one batch handed on
#: White space of the tokenizer's patterns.
SPACES = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Lower case of letters newer than this Python's tables, as (first, last, distance).
NEWER_LETTERS = [
    (0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, 0x264 - 0xA7CB), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1), (0xA7D2, 0xA7D2, 1),
    (0xA7D4, 0xA7D4, 1), (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, 0x19B - 0xA7DC), (0x10D50, 0x10D65, 0x20), (0x16EA0, 0x16EB8, 0x1B),
]
LOWER = {c: c + by for first, last, by in NEWER_LETTERS for c in range(first, last + 1)} | {ord("Σ"): ord("σ")}
SPECIAL_CASE = re.compile("[" + "".join(map(chr, LOWER)) + "]")


#: Ranges of letters and digits that are newer than the tokenizer's tables.
NEWER = """558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf 10940-10959
10ec5-10ec7 10ed9-10eee 11b0a 11db0-11ddb 11de0-11de9 11df1 1246f 12475-1247f 12550-12686 16ea0-16eb8 16ebb-16ed3
16ff2-16ff6 187f8-187ff 18cd6-18cda 18d09-18d20 18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128 1b168 1d6a6
1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4
1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead 323b0-33479 3d000-3fc3f"""


def _class(ranges: str) -> str:
    return "".join("-".join(f"\\U{int(c, 16):08x}" for c in part.split("-")) for part in ranges.split())


def _words(letter: str, digit: str) -> regex.Pattern:
    return regex.compile(f"'s|'t|'re|'ve|'m|'ll|'d|{letter}+|{digit}|[^{SPACES}{letter}{digit}]+", flags=regex.V1)


WORD = _words(r"\p{L}", r"\p{N}")
NEW_LETTER = re.compile(f"[{_class(NEWER)}]")
WORD_WITH_NEW = _words(*(f"[\\p{{{kind}}}--[{_class(NEWER)}]]" for kind in "LN"))


def words_of(text: str) -> list[str]:
    """The words that are merged each by itself; ``text`` is in lower case."""
    return (WORD_WITH_NEW if NEW_LETTER.search(text) else WORD).findall(text)


#: Ranges of combining marks that the tokenizer doesn't order, as they are newer than its tables.
NEWER_MARKS = """7fd 898-89f 8ca-8d3 9fe c3c d3b-d3c eba 1715 1abf-1ace 1df6-1dfa a82c 10d24-10d27 10eab-10eac
10efd-10eff 10f46-10f50 10f82-10f85 11070 1133b 1145e 11839-1183a 1193d-1193e 11943 119e0 11a34 11a47 11a99 11d42
11d44-11d45 11d97 11f41-11f42 16ff0-16ff1 1e08f 1e130-1e136 1e2ae 1e2ec-1e2ef 1e4ec-1e4ef"""
NEW_MARK = re.compile(f"([{_class(NEWER_MARKS)}])")


def lowered(text: str) -> str:
    """Composed and in lower case, letter by letter: a final sigma has no form of its own."""
    if text.isascii():
        return text.lower()
    composed = "".join(unicodedata.normalize("NFC", part) for part in NEW_MARK.split(text))
    return (composed.translate(LOWER) if SPECIAL_CASE.search(composed) else composed).lower()


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where it is printable, else the next free one from 256."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class Vocabulary:
    """Tables of a tokenizer file: word ends are marked, the text is composed and in lower case."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        model, ids = held["model"], held["model"]["vocab"]
        end = model["end_of_word_suffix"]
        special = {t["content"]: t["id"] for t in held["added_tokens"]}
        letters = byte_letters()
        self.inner = np.array([ids[c] for c in letters], np.int32)
        self.last = np.array([ids[c + end] for c in letters], np.int32)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.parts = np.array([ids[a] << 32 | ids[b] for a, b in pairs], np.int64)
        self.by_key = np.argsort(self.parts, kind="stable")  # the ranks, in order of keys
        self.keys = self.parts[self.by_key]
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int32)
        self.special = special
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        tokens = [""] * (max([*ids.values(), *special.values()]) + 1)
        for token, at in {**ids, **special}.items():
            tokens[at] = token
        spelled = [f"{t} ".encode() for t in tokens]
        self.spelling = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled_to = np.cumsum([0, *map(len, spelled)])

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, -1 where there is no merge."""
        wanted = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.by_key[at], -1)


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def merge_words(words: list[bytes], known: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, one after another, and where each word's ids begin."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes)
    raw = np.frombuffer(b"".join(words), np.uint8)
    symbols = known.inner[raw]
    symbols[ends - 1] = known.last[raw[ends - 1]]
    n = len(symbols)
    after = np.arange(1, n + 1)
    after[ends - 1] = -1
    before = np.arange(-1, n - 1)
    before[np.r_[0, ends[:-1]]] = -1
    index: dict[int, list[np.ndarray]] = {}

    def enter(ranks: np.ndarray, at: np.ndarray) -> list[int]:
        """Enter positions under their ranks; returns the ranks that become active."""
        held = ranks >= 0
        ranks, at = ranks[held], at[held]
        if not len(ranks):
            return []
        order = np.argsort(ranks, kind="stable")
        ranks, at = ranks[order], at[order]
        cuts = np.flatnonzero(np.diff(ranks)) + 1
        fresh = []
        bounds = [0, *cuts.tolist(), len(ranks)]
        for i, rank in enumerate(ranks[bounds[:-1]].tolist()):
            part = at[bounds[i] : bounds[i + 1]]
            if rank in index:
                index[rank].append(part)
            else:
                index[rank] = [part]
                fresh.append(rank)
        return fresh

    heads = np.flatnonzero(after >= 0)
    active = enter(known.ranks(symbols[heads], symbols[heads + 1]), heads)
    heapify(active)
    while active:
        rank = heappop(active)
        lists = index.pop(rank)
        at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
        left, right = int(known.parts[rank] >> 32), int(known.parts[rank] & 0xFFFFFFFF)
        at = at[symbols[at] == left]
        at = at[after[at] >= 0]
        at = at[symbols[after[at]] == right]
        if left == right and len(at) > 1:  # in a run every second position, from the left
            kept, taken = [], set()
            for p in at.tolist():
                if before[p] not in taken or before[p] < 0:
                    kept.append(p)
                    taken.add(p)
            at = np.array(kept, np.int64)
        if not len(at):
            continue
        gone = after[at]
        behind = after[gone]
        symbols[at] = known.merged[rank]
        symbols[gone] = -1
        after[at] = behind
        some = behind >= 0
        before[behind[some]] = at[some]
        lefts = before[at]
        has = lefts >= 0
        lefts = lefts[has]
        rights, ahead = at[some], behind[some]
        merged = symbols[at]
        pairs = np.concatenate([known.ranks(symbols[lefts], merged[has]), known.ranks(merged[some], symbols[ahead])])
        for new in enter(pairs, np.concatenate([lefts, rights])):
            heappush(active, new)
    alive = symbols >= 0
    starts = np.concatenate([[0], np.cumsum(alive)])[np.r_[0, ends]]
    return symbols[alive], starts


def gathered(values: np.ndarray, starts: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """values[starts[i]:starts[i + 1]] of each chosen i, one after another, and where each ends."""
    sizes = (starts[1:] - starts[:-1])[chosen]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total) + np.repeat(starts[chosen] - (ends - sizes), sizes)
    return values[at], ends


class Encoder:
    """Takes texts one by one as numbers of their words; the words are merged together when the ids are asked for."""

    def __init__(self, known: Vocabulary):
        self.known = known
        self.numbers: dict[str, int] = {s: i for i, s in enumerate(known.special)}
        self.taken: list[np.ndarray] = []

    def take(self, text: str) -> None:
        known, numbers, chosen = self.known, self.numbers, []
        for piece in known.split.split(text) if known.split and "<" in text else [text]:
            if piece in known.special:
                chosen.append(numbers[piece])
            elif piece:
                chosen += [numbers.setdefault(w, len(numbers)) for w in words_of(lowered(piece))]
        self.taken.append(np.array(chosen, np.int32))

    def ids(self) -> Iterator[np.ndarray]:
        """Ids of each text, in the order taken."""
        own = np.fromiter(self.known.special.values(), np.int32, len(self.known.special))
        words = [w.encode() for w in self.numbers][len(own) :]
        self.numbers.clear()
        ids, starts = merge_words(words, self.known) if words else (np.zeros(0, np.int32), np.zeros(1, np.int64))
        ids, starts = np.concatenate([own, ids]), np.concatenate([np.arange(len(own)), starts + len(own)])
        for chosen in self.taken:
            yield gathered(ids, starts, chosen)[0]


def encode(texts: list[str], known: Vocabulary) -> list[np.ndarray]:
    """Ids of each text."""
    encoder = Encoder(known)
    for text in texts:
        encoder.take(text)
    return list(encoder.ids())


def decode(encoded: list[np.ndarray], known: Vocabulary) -> list[bytes]:
    """The tokens' spellings with a space between, in UTF-8."""
    out = []
    for ids in encoded:
        spelled, _ = gathered(known.spelling, known.spelled_to, ids)
        out.append(spelled[:-1].tobytes())
    return out


def _coded(path: str, text_chars: int, out_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)
        encoder, doc_ids, size = Encoder(known), [], 0

        def batch_of(doc_ids: pa.Array, encoded: list[np.ndarray]) -> pa.RecordBatch:
            columns = {
                "doc_id": doc_ids,
                "n_tokens": pa.array([len(x) for x in encoded], pa.int64()),
                "ids": pa.array([x.astype("<u4").tobytes() for x in encoded], pa.binary()),
                "decoded": pa.array(decode(encoded, known), pa.binary()).cast(pa.string()),
            }
            return pa.RecordBatch.from_pydict(columns)

        def handed() -> Iterator[pa.RecordBatch]:
            whole, part, first, weight = pa.concat_arrays(doc_ids), [], 0, 0
            for ids in encoder.ids():
                part.append(ids)
                weight += len(ids)
                if weight >= out_tokens:
                    yield batch_of(whole.slice(first, len(part)), part)
                    part, first, weight = [], first + len(part), 0
            yield batch_of(whole.slice(first), part)

        for batch in batches:
            texts, at = batch.column("text"), 0
            for i in range(batch.num_rows):
                text = texts[i].as_py() or ""
                encoder.take(text)
                size += len(text)
                if size >= text_chars:
                    doc_ids.append(batch.column("doc_id").slice(at, i + 1 - at))
                    yield from handed()
                    encoder, doc_ids, size, at = Encoder(known), [], 0, i + 1
                    give_back()
            doc_ids.append(batch.column("doc_id").slice(at))
        if doc_ids:
            yield from handed()

    return run


def coded(docs: DataFrame, path: str, text_chars: int | None = None, out_tokens: int | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every text: ids as little-endian unsigned 32-bit numbers.

    ``path`` names the tokenizer's file, which every executor has. The text is whole,
    however long. A null or empty text has no ids and decodes to an empty text; the
    special tokens' spellings in a text are those tokens. Rows, repeated or with a null
    ``doc_id``, stay one each; other columns of ``docs`` are ignored. ``text_chars`` and
    ``out_tokens`` (None: the module's) bound what a task holds at once (a longer text is held whole); the rows are the same.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_tokens long, ids binary, decoded string"
    return docs.select("doc_id", "text").mapInArrow(releasing(_coded(path, text_chars or TEXT_CHARS, out_tokens or OUT_TOKENS)), schema)
