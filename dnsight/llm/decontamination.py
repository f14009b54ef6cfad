"""Benchmark passages in documents: a prefix-filtered join with exact verification.

An item's windows are its runs of 13 words (the whole item if it is shorter). A document contains a
window only if it contains each of its words, so one necessary word, the window's rarest by its count
in all documents, is enough of a prefix: documents are joined with windows on it. The word's place in
the window fixes where the window would begin; it has to fit into the document (length and position
bounds), and there all words have to be equal.

The windows are sent to the tasks in blocks of items whose texts sum up to `block_chars` characters at
most; a benchmark of any size is worked through block by block, each against all documents.

Defined cases: null texts have no words; items without an id or without words have no windows; items
with one id are one item; an empty benchmark hits nothing; every document row gives one row, repeated
ids included. Words are compared by 64-bit hashes (see words.py).
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dnsight.llm import words as W
from dnsight.sources.storage import stage

WIDTH = 13
RESULT = (
    "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
)


def _blocks(benchmark: DataFrame, block_chars: int):
    """Items (id, text) in lists of bounded size."""
    items = benchmark.select(
        F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")
    ).filter("item_id is not null and text is not null")
    size = items.agg(F.sum(F.char_length("text") + F.char_length("item_id") + 16)).first()[0] or 0
    count = int(2 * size // block_chars) + 1
    if count == 1:
        yield [tuple(r) for r in items.collect()]
        return
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for k in range(count):
        yield [tuple(r) for r in items.filter(block == k).collect()]


def _windows(items: list[tuple[str, str]], width: int):
    """Distinct windows as hash arrays, with the item each belongs to."""
    hashes, first = W.word_hashes(pa.array([t for _, t in items], pa.large_string()), W.ALPHANUMERIC)
    found: dict[tuple[str, bytes], np.ndarray] = {}
    for (item, _), a, z in zip(items, first, first[1:]):
        for start in range(a, max(z - width, a) + 1 if z > a else a):
            window = hashes[start: min(start + width, z)]
            found[item, window.tobytes()] = window
    return [(item, window) for (item, _), window in found.items()]


def _counts(docs: DataFrame, vocabulary: np.ndarray) -> dict[int, int]:
    """Occurrences of some words in all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches):
        vocabulary = shared.value
        total = np.zeros(len(vocabulary) + 1, np.int64)
        for batch in batches:
            for part in W.slices(batch, "text"):
                hashes, _ = W.word_hashes(part.column("text"), W.ALPHANUMERIC)
                place = np.searchsorted(vocabulary, hashes)
                place[place == len(vocabulary)] = 0
                place[vocabulary[place] != hashes] = len(vocabulary)
                total += np.bincount(place, minlength=len(vocabulary) + 1)
        seen = np.flatnonzero(total[:-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["word", "n"]
        )

    rows = docs.select("text").mapInArrow(count, "word long, n long")
    return {r["word"]: r["n"] for r in rows.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def _index(windows, rarity: dict[int, int]) -> dict:
    """Windows by their rarest word, as arrays in the order of that word's hash."""
    entries = []
    for item, window in windows:
        place = min(range(len(window)), key=lambda i: (rarity.get(int(window[i]), 0), int(window[i])))
        entries.append((int(window[place]), place, len(window), item, int(W.rolled(window, len(window))[0])))
    entries.sort()
    items = sorted({e[3] for e in entries})
    number = {item: i for i, item in enumerate(items)}
    return {
        "items": items,
        "prefix": np.array([e[0] for e in entries], np.uint64),
        "place": np.array([e[1] for e in entries], np.int64),
        "length": np.array([e[2] for e in entries], np.int64),
        "item": np.array([number[e[3]] for e in entries], np.int64),
        "whole": np.array([e[4] for e in entries], np.uint64),
    }


def _occurrences(index: dict, hashes: np.ndarray, first: np.ndarray):
    """Start, length and item of every window that occurs in a row (rows begin at `first`)."""
    prefix, length = index["prefix"], index["length"]
    if not len(prefix):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = np.searchsorted(prefix, hashes, side="left")
    low[low == len(prefix)] = 0
    at = np.flatnonzero(prefix[low] == hashes)
    low = low[at]
    times = np.searchsorted(prefix, hashes[at], side="right") - low
    entry = np.repeat(low, times) + np.arange(times.sum()) - np.repeat(times.cumsum() - times, times)
    start = np.repeat(at, times) - index["place"][entry]
    row = np.searchsorted(first, np.repeat(at, times), side="right") - 1
    fits = (start >= first[row]) & (start + length[entry] <= first[row + 1])
    start, entry = start[fits], entry[fits]
    same = np.zeros(len(start), bool)
    for size in np.unique(length[entry]):
        mine = np.flatnonzero(length[entry] == size)
        text = np.zeros(len(mine), np.uint64)
        for k in range(size):
            text = W.mix(text + hashes[start[mine] + k] + np.uint64(k + 1))
        same[mine] = text == index["whole"][entry[mine]]
    return start[same], length[entry[same]], index["item"][entry[same]]


def _summary(n_words: int, n_hit: int, items: list[str]) -> tuple:
    digest = sha256(",".join(sorted(items)).encode()).hexdigest()
    return n_words, n_hit, len(items), digest, n_hit > 0 and 20 * n_hit >= n_words


def _scan(index):
    """A function for mapInArrow: per row its words, the spans hit and the items."""

    def scan(batches):
        windows = index.value
        for batch in batches:
            for part in W.slices(batch, "text"):
                hashes, first = W.word_hashes(part.column("text"), W.ALPHANUMERIC)
                start, length, item = _occurrences(windows, hashes, first)
                row = np.searchsorted(first, start, side="right") - 1
                order = np.lexsort((start, row))
                start, length, item, row = start[order], length[order], item[order], row[order]
                begin = start - first[row]
                bound = np.searchsorted(row, np.arange(part.num_rows + 1))
                spans, items = [], []
                for a, z in zip(bound, bound[1:]):
                    spans.append([(int(b), int(b + n)) for b, n in zip(begin[a:z], length[a:z])])
                    items.append([windows["items"][i] for i in np.unique(item[a:z])])
                span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
                spans = pa.array([[{"begin": b, "end": e} for b, e in s] for s in spans], span)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in part.schema.names if c != "text"],
                     pa.array(np.diff(first), pa.int64()), spans, pa.array(items, pa.list_(pa.string()))],
                    [*[c for c in part.schema.names if c != "text"], "n_words", "spans", "items"],
                )

    return scan


FOUND = "n_words long, spans array<struct<begin:long,end:long>>, items array<string>"


def _prepared(docs: DataFrame, benchmark: DataFrame, block_chars: int, width: int):
    """The documents, and an index for each block of items, broadcast."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    indexes = []
    for items in _blocks(benchmark, block_chars):
        windows = _windows(items, width)
        vocabulary = np.unique(np.concatenate([w for _, w in windows])) if windows else np.zeros(0, np.uint64)
        places = _counts(rows, vocabulary) if windows else {}
        rarity = {int(vocabulary[place]): n for place, n in places.items()}
        indexes.append(spark.sparkContext.broadcast(_index(windows, rarity)))
    return rows, indexes


def _found(rows: DataFrame, indexes: list) -> DataFrame:
    kind = rows.schema["doc_id"].dataType.simpleString()
    if len(indexes) == 1:
        return rows.mapInArrow(_scan(indexes[0]), f"doc_id {kind}, {FOUND}")
    # With several blocks, each row gets a key by which its findings meet.
    keyed = stage(rows.withColumn("row", F.expr("uuid()")))
    found = None
    for index in indexes:
        block = keyed.mapInArrow(_scan(index), f"doc_id {kind}, row string, {FOUND}")
        found = block if found is None else found.unionByName(block)
    return found.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
    ).drop("row")


def occurrences(docs: DataFrame, benchmark: DataFrame, block_chars: int = 1 << 25, width: int = WIDTH):
    """doc_id, n_words, spans (begin, end of each window found, in words) and items of every document."""
    return _found(*_prepared(docs, benchmark, block_chars, width))


def _summarise(batches):
    for batch in batches:
        out = []
        for n_words, spans, items in zip(
            batch.column("n_words").to_pylist(), batch.column("spans").to_pylist(),
            batch.column("items").to_pylist(),
        ):
            hit, reached = 0, 0
            for begin, end in sorted((s["begin"], s["end"]) for s in spans):
                hit += max(0, end - max(begin, reached))
                reached = max(reached, end)
            out.append(_summary(n_words, hit, items))
        columns = [list(c) for c in zip(*out)] or [[]] * 5
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
            ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        )


def contamination(docs: DataFrame, benchmark: DataFrame, block_chars: int = 1 << 25, width: int = WIDTH):
    """Per document: its words, those inside any window's occurrence, the items that occur, a verdict.

    A document is contaminated if at least a twentieth of its words, and at least one, is hit.
    """
    rows, indexes = _prepared(docs, benchmark, block_chars, width)
    kind = rows.schema["doc_id"].dataType.simpleString()
    if len(indexes) == 1:
        scan = _scan(indexes[0])
        return rows.mapInArrow(lambda batches: _summarise(scan(batches)), f"doc_id {kind}, {RESULT}")
    found = _found(rows, indexes).select("doc_id", "n_words", "spans", "items")
    return found.mapInArrow(_summarise, f"doc_id {kind}, {RESULT}")
