"""Plain Python versions of what the operators do, for small inputs."""

from __future__ import annotations

import hashlib
import random

from affinis.llm import simhash
from affinis.llm.decontaminate import shingle_texts

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = "the an re ing th er on sh ou ti ha nd st en ble ly wh at es or ed he".split()


def prose(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.choice((1, 1, 2, 2, 3)))) for _ in range(words))


def docs_of(spark, texts, start=0):
    return spark.createDataFrame([(start + i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], DOCS)


def contained(text, item, threshold=0.8):
    wanted = shingle_texts(item)
    return bool(wanted) and len(wanted & shingle_texts(text)) >= threshold * len(wanted) - 1e-9


def components(texts):
    """Smallest index reachable over fingerprints at most three bits apart."""
    prints = [simhash.fingerprint(t) for t in texts]
    least = list(range(len(texts)))

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = root(i), root(j)
                least[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(texts))]


def without_repeats(texts, window=35):
    words = [(t or "").encode().split() for t in texts]
    seen = {}
    for w in words:
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            seen[key] = seen.get(key, 0) + 1
    out = []
    for w in words:
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        out.append((len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()
