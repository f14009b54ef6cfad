"""Language of texts by multinomial naive Bayes over hashed character n-grams.

Counts of n-grams (one to three lower-cased characters, hashed into a table of fixed size) of all labelled
rows are summed by Spark per language. Languages count as equally likely beforehand (no class prior), so a
rare one is not held back. The matrix of log probabilities is broadcast, and a batch of texts is scored by
looking its n-grams up and summing over each text.

Defined cases: null text and text without a letter give `und` with score 0; rows without a language are
not learned from; without any labelled row every text is `und`; ties go to the language that sorts
first; repeated rows count each; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dnsight.llm import words as W

SIZES = (1, 2, 3)
BUCKETS = 1 << 16
#: More languages than this are an error: the broadcast matrix is BUCKETS times this at most.
LANGUAGES = 256
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each followed by a space, and where each text begins."""
    data = np.frombuffer("".join(t + " " for t in texts).encode("utf-32-le", "replace"), np.uint32)
    return data, np.cumsum([0, *[len(t) + 1 for t in texts]])


def _grams(data: np.ndarray, size: int) -> np.ndarray:
    """Bucket of the n-gram that begins at each place."""
    count = max(len(data) - size + 1, 0)
    key = np.full(count, size, np.uint32)
    for k in range(size):
        key = (key ^ data[k: k + count]) * np.uint32(0x9E3779B1)
        key ^= key >> np.uint32(15)
    return key & np.uint32(BUCKETS - 1)


def _texts(part: pa.RecordBatch) -> list[str]:
    return [(t or "").lower() for t in part.column("text").to_pylist()]


def fit(rows: DataFrame, smoothing: float = 0.5) -> tuple[list[str], np.ndarray]:
    """Languages and log probabilities (bucket by language) of the labelled rows (text, lang)."""
    rows = rows.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.filter("text is not null and lang is not null")

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in W.slices(batch, "text"):
                data, first = _codes(_texts(part))
                langs = part.column("lang").to_pylist()
                for lang in set(langs):
                    mine = np.repeat(np.array([x == lang for x in langs]), np.diff(first))
                    table = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                    for size in SIZES:
                        grams = _grams(data, size)
                        table += np.bincount(grams[mine[: len(grams)]], minlength=BUCKETS)
        for lang, table in sums.items():
            seen = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(seen), pa.string()), pa.array(seen, pa.int32()), pa.array(table[seen])],
                ["lang", "bucket", "n"],
            )

    counts = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket")
    languages = sorted(r["lang"] for r in rows.select("lang").distinct().limit(LANGUAGES + 1).collect())
    if len(languages) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    matrix = np.full((BUCKETS, len(languages)), smoothing)
    # One row for each language and bucket: the table has a fixed largest size.
    for row in counts.agg(F.sum("n").alias("n")).toLocalIterator():
        matrix[row["bucket"], languages.index(row["lang"])] += row["n"]
    return languages, np.log(matrix / matrix.sum(axis=0, keepdims=True)).astype(np.float32)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], columns: str, keep: list[str]) -> DataFrame:
    """The `keep` columns with lang_pred and score (the probability of the language, tempered by length).

    The score is the softmax of the mean log probability per n-gram, times 20: long texts don't saturate it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def label(batches):
        languages, matrix = shared.value
        for batch in batches:
            for part in W.slices(batch, "text", 1 << 20):
                texts = _texts(part)
                data, first = _codes(texts)
                sums = np.zeros((len(texts), len(languages)))
                for size in SIZES:
                    grams = _grams(data, size)
                    # An n-gram may reach into the space after its text, not further.
                    inside = np.append(grams, np.zeros(len(data) - len(grams), np.uint32))
                    for k in range(len(languages)):
                        value = matrix[:, k][inside].astype(np.float64)
                        for last in range(1, size):
                            ends = first[1:] - last
                            value[ends[ends >= 0]] = 0
                        sums[:, k] += np.add.reduceat(value, first[:-1]) if len(texts) else 0
                mean = sums / np.maximum(np.diff(first) * len(SIZES), 1)[:, None]
                names, scores = [], []
                for row, text in enumerate(texts):
                    if not languages or not _LETTER.search(text):
                        names.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    best = int(mean[row].argmax())
                    names.append(languages[best])
                    scores.append(float(1 / np.exp(20 * (mean[row] - mean[row, best])).sum()))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in keep], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    [*keep, "lang_pred", "score"],
                )

    return docs.select(*keep, F.col("text").cast("string").alias("text")).mapInArrow(
        label, f"{columns}, lang_pred string, score double"
    )
