"""Phrase collocations against brute force and on odd input."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from dnsight.llm import collocations
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, lang string"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def brute_force(rows, least=10, top=2000):
    """lang, rank, phrase, a, l, r, n, score by the words of the contract."""
    counts = {}
    for text, lang in rows:
        own = counts.setdefault("und" if lang is None else lang, [0, Counter()])
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", lowered(text or "")):
            words = re.findall(r"[^ \t]+", piece)
            own[0] += len(words)
            for size in (1, 2, 3):
                own[1].update(tuple(words[k: k + size]) for k in range(len(words) - size + 1))
    out = []
    for lang, (n, f) in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        covered = {
            p for longer, b in candidates.items() if len(longer) == 3 for p in (longer[:2], longer[1:])
            if p in candidates and 100 * b >= 50 * candidates[p]
        }
        scored = []
        for p, a in candidates.items():
            if p not in covered:
                score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def found(docs, **options):
    return sorted(tuple(r)[:8] for r in collocations.collocations(docs, **options).collect())


def texts(count):
    random.seed(8)
    vocabulary = [f"W{k}" for k in range(12)] + ["É", "é", "漢", "a b", "x-y"]
    marks = [" ", " ", " ", "\t ", ". ", ",", "\n", "\x0b", "!?"]
    rows = []
    for k in range(count):
        text = "".join(random.choice(vocabulary) + random.choice(marks) for _ in range(60))
        rows.append((text + " new york city" * (k % 3), random.choice(["en", "de", None])))
    return rows


def test_small_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r["text"], r["lang"]) for r in docs.collect()]
    assert found(docs) == brute_force(rows)


@pytest.mark.parametrize("limits", [(1 << 21, 1 << 15), (60, 8)], ids=["plain", "bursts and runs"])
def test_random_texts(spark, monkeypatch, limits):
    monkeypatch.setattr(collocations, "CAPACITY", limits[0])
    monkeypatch.setattr(collocations, "BURST", limits[1])
    rows = texts(300)
    docs = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], SCHEMA).repartition(5)
    assert found(docs) == brute_force(rows)
    assert found(docs, top=7) == brute_force(rows, top=7)


def test_saturated_filter_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(collocations, "bit_filter", lambda keys, column: None)
    rows = texts(100)
    assert found(spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], SCHEMA)) == brute_force(rows)


def test_odd_rows(spark):
    rows = [
        (None, "en"), ("", "en"), ("...", None), ("x" * 30_000, "de"), ("word " * 20_000, "fr"),
        *[("Same words here. again", "en")] * 12, *[("und text", "und")] * 6, *[("und text", None)] * 6,
    ]
    docs = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], SCHEMA)
    odd = docs.withColumns({c: F.lit(1) for c in ("n", "w1", "id", "word", "phrase", "score", "bucket", "a")})
    assert found(odd) == brute_force(rows)
    assert collocations.collocations(docs.filter("false")).count() == 0


def test_products_beyond_64_bits(spark):
    row = spark.createDataFrame([(10**13, 10**13, 3 * 10**13)], "a long, l long, r long")
    assert row.select(collocations._score(F.col("a"), F.col("l"), F.col("r"))).first()[0] == 333333


def test_trie_runs_hold_every_sequence_once_and_sorted():
    random.seed(9)
    trie, counts, runs = collocations.HatTrie(3, burst=16), Counter(), []
    for _ in range(60):
        keys = [(random.choice([3, 5, 1 << 40, 7 << 60]), random.randrange(20), random.randrange(9)) for _ in range(50)]
        counts.update({k: 2 * n for k, n in Counter(keys).items()})
        trie.add([*np.array(keys, np.uint64).T, np.full(len(keys), 2)])
        if trie.size > 300:
            runs.append(trie.run(150))
            assert trie.size <= 150
    assert any(type(child) is dict for child in trie.root.values())
    runs.append(trie.run(0))
    total = Counter()
    for run in runs:
        rows = [tuple(r) for r in zip(*[c.tolist() for c in run])]
        assert rows == sorted(rows) and len({r[:3] for r in rows}) == len(rows)
        for *key, n in rows:
            total[tuple(key)] += n
    assert len(runs) > 1 and total == counts and trie.size == 0 and not trie.root
