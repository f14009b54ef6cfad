"""Document quality from a linear-chain conditional random field over lines.

Every line of a text is good or bad. The field scores a line's label by the features of the line and of
its two neighbours and by the label of the line before. Its marginals, by forward and backward passes,
are averaged over the text by line length, and a logistic curve turns the share of bad text into the
probability that the document's quality label is 1.

Labels are known for documents only. A first, independent model takes the label of the document for all
its lines; lines of bad documents that it finds good are then taken as good, but for the worst one, and
the field is trained on these. Training uses a bounded sample of labelled rows, whole texts only: SAMPLE
documents by a hash of their id, as long as they have no more than SAMPLE_LINES lines together; scoring
reads all text.

Defined cases: null counts as the empty text, which is one line without bytes; labels that are null or
of no document are ignored; of several labels of a document the lowest counts; without labelled rows,
or with labels of one kind, every score is the share of label 1 (0.5 without any); repeated rows are
scored each; other columns are ignored.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dnsight.llm import words as W
from dnsight.sources.storage import stage

#: Labelled documents of the training sample, at most, and lines of all of them together, at most.
SAMPLE, SAMPLE_LINES = 4000, 400_000
THRESHOLD = 0.3

_KINDS = {
    "upper": [*range(65, 91)],
    "lower": [*range(97, 123), *range(128, 256)],
    "digit": [*range(48, 58)],
    "space": [32, 9],
    "stop": [44, 46],
    "bang": [33, 63],
    "bar": [124, 60, 61, 62, 91, 93, 95, 123, 125, 126],
    "mark": [35, 36, 37, 38, 42, 43, 47, 64, 92, 94, 96],
    "control": [*range(9), *range(11, 32), 127],
}
_TABLES = np.zeros((len(_KINDS), 256), np.float32)
for _row, _bytes in enumerate(_KINDS.values()):
    _TABLES[_row, _bytes] = 1
#: Numbers per line.
WIDTH = len(_KINDS) + 6


def line_features(column: pa.Array):
    """Features of all lines, their bytes, and the first line of each row (one more at last)."""
    data, offsets = W.column_bytes(column)
    breaks = np.flatnonzero(data == 10)
    # A line begins at each row's start and after each break.
    begins = np.concatenate([offsets[:-1], breaks + 1])
    row = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, breaks, side="right") - 1])
    order = np.lexsort((begins, row))
    begins, row = begins[order], row[order]
    first = np.searchsorted(row, np.arange(len(offsets)))
    ends = np.append(begins[1:], len(data))
    last = np.append(row[1:] != row[:-1], True) if len(row) else np.zeros(0, bool)
    ends = np.where(last, offsets[1:][row], ends - 1)
    size = ends - begins
    least = np.maximum(size, 1).astype(np.float32)
    out = np.zeros((len(begins), WIDTH), np.float32)

    def summed(values):
        total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
        return (total[ends] - total[begins]).astype(np.float32)

    for k in range(len(_KINDS)):
        out[:, k] = np.sqrt(summed(_TABLES[k][data]) / least)
    starts, stops, _ = W.word_spans(data, offsets, W.NOT_SPACE)
    hashes = W.hash_spans(data, starts, stops)
    line = np.searchsorted(begins, starts, side="right") - 1
    words = np.bincount(line, minlength=len(begins)).astype(np.float32)
    many = np.maximum(words, 1)
    same = (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])
    again = np.bincount(line[1:][same], minlength=len(begins))
    keys = np.unique(W.mix(hashes ^ W.mix(line.astype(np.uint64))), return_index=True)[1]
    distinct = np.bincount(line[keys], minlength=len(begins))
    whole = W.mix(W.hash_spans(data, begins, ends) ^ W.mix(row.astype(np.uint64) + np.uint64(7)))
    _, place, copies = np.unique(whole, return_inverse=True, return_counts=True)
    k = len(_KINDS)
    out[:, k] = again / many
    out[:, k + 1] = distinct / many
    out[:, k + 2] = copies[place] > 1
    out[:, k + 3] = np.log1p(size) / 10
    out[:, k + 4] = np.minimum(size / many, 50) / 50
    out[:, k + 5] = size == 0
    return out, size, first


def with_neighbours(features: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Features of each line with those of the lines before and after it in its row, and a constant."""
    count = len(features)
    out = np.zeros((count, 3 * WIDTH + 1), np.float32)
    out[:, :WIDTH], out[:, -1] = features, 1
    if count > 1:
        out[1:, WIDTH: 2 * WIDTH] = features[:-1]
        out[:-1, 2 * WIDTH: 3 * WIDTH] = features[1:]
        starts = first[:-1][np.diff(first) > 0]
        out[starts, WIDTH: 2 * WIDTH] = 0
        out[starts[1:] - 1, 2 * WIDTH: 3 * WIDTH] = 0
    return out


def _by_place(lengths: np.ndarray):
    """Rows by falling length, and for each line number how many rows have it."""
    order = np.argsort(-lengths, kind="stable")
    steps = int(lengths.max()) if len(lengths) else 0
    return order, np.searchsorted(-lengths[order], -np.arange(steps), side="left")


def marginals(bad: np.ndarray, change: np.ndarray, first: np.ndarray):
    """Probability that each line is bad, and of each pair of labels (per line, with the line before).

    `bad` is a line's score for being bad over good; `change[i, j]` the score of label j after label i.
    """
    lengths = np.diff(first)
    order, active = _by_place(lengths)
    begin = first[:-1][order]
    local = np.exp(np.stack([np.zeros_like(bad), bad], axis=1) - np.maximum(bad, 0)[:, None])
    move = np.exp(change)
    forward, backward = np.ones((len(bad), 2)), np.ones((len(bad), 2))
    for step, n in enumerate(active):
        at = begin[:n] + step
        value = local[at] * (forward[at - 1] @ move if step else 1)
        forward[at] = value / value.sum(axis=1, keepdims=True)
    for step in range(len(active) - 2, -1, -1):
        at = begin[: active[step + 1]] + step
        value = (local[at + 1] * backward[at + 1]) @ move.T
        backward[at] = value / value.sum(axis=1, keepdims=True)
    single = forward * backward
    single /= single.sum(axis=1, keepdims=True)
    inner = np.ones(len(bad), bool)
    inner[first[:-1][lengths > 0]] = False
    at = np.flatnonzero(inner)
    pair = forward[at - 1][:, :, None] * move[None] * (local[at] * backward[at])[:, None, :]
    pair /= pair.sum(axis=(1, 2), keepdims=True)
    return single[:, 1], at, pair


def _climb(gradient, start: np.ndarray, steps: int, rate: float) -> np.ndarray:
    """Gradient ascent with running means of the gradient and its square."""
    x, mean, square = start.copy(), np.zeros_like(start), np.zeros_like(start)
    for step in range(1, steps + 1):
        g = gradient(x)
        mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
        x += rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return x


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def train(features: np.ndarray, size: np.ndarray, first: np.ndarray, label: np.ndarray) -> dict:
    """Parameters from the lines of the sample (rows begin at `first`) and the label of each row."""
    share = float(label.mean()) if len(label) else 0.5
    if share in (0.0, 1.0) or not len(label):
        return {"share": share}
    x, row = with_neighbours(features, first), np.repeat(np.arange(len(label)), np.diff(first))
    truth = (label[row] == 0).astype(float)
    # Both kinds of documents get half of the weight.
    weight = np.where(truth > 0, 0.5 / max(truth.sum(), 1), 0.5 / max((1 - truth).sum(), 1))

    def independent(target):
        def gradient(w):
            return x.T @ (weight * (target - _sigmoid(x @ w))) - 1e-4 * w

        return _climb(gradient, np.zeros(x.shape[1]), 200, 0.1)

    for _ in range(2):
        chance = _sigmoid(x @ independent(truth))
        worst = np.zeros(len(label))
        np.maximum.at(worst, row, chance)
        truth = ((label[row] == 0) & ((chance >= 0.5) | (chance == worst[row]))).astype(float)
    columns = x.shape[1]
    state = truth.astype(int)

    def gradient(w):
        change = w[columns:].reshape(2, 2)
        chance, at, pair = marginals(x @ w[:columns], change, first)
        seen = np.zeros((2, 2))
        np.add.at(seen, (state[at - 1], state[at]), weight[at])
        expected = (pair * weight[at][:, None, None]).sum(axis=0)
        return np.concatenate([x.T @ (weight * (truth - chance)), (seen - expected).ravel()]) - 1e-4 * w

    w = _climb(gradient, np.zeros(columns + 4), 200, 0.1)
    model = {"share": share, "weights": w[:columns], "change": w[columns:].reshape(2, 2)}
    bad = bad_share(model, features, size, first)
    z = np.stack([_spread(bad), np.ones(len(bad))], axis=1)
    model["curve"] = _climb(lambda c: z.T @ (label - _sigmoid(z @ c)) / len(label), np.zeros(2), 600, 0.05)
    return model


def _spread(share: np.ndarray) -> np.ndarray:
    return np.log((share + 1e-3) / (1 - share + 1e-3))


def bad_share(model: dict, features: np.ndarray, size: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Share of each row's text in bad lines: marginals weighted by length."""
    chance, _, _ = marginals(with_neighbours(features, first) @ model["weights"], model["change"], first)
    weight = np.maximum(size, 1)
    return np.add.reduceat(chance * weight, first[:-1]) / np.add.reduceat(weight, first[:-1])


def fold(doc_id: str = "doc_id"):
    """crc32 of the id as text, modulo 5; documents of fold 0 are held out (a null id counts as '')."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(5))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    """Train on labelled documents outside of fold 0, at most `sample`, chosen by a hash of the id.

    A document that would take the sample beyond SAMPLE_LINES lines is left out of it.
    """
    chosen = (
        labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
        .filter("quality is not null and doc_id is not null").filter(fold() != 0)
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    # The sample is bounded by its parameter.
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")

    def extract(batches):
        for batch in batches:
            for part in W.slices(batch, "text"):
                features, size, first = line_features(part.column("text"))
                own = [features[a:z] for a, z in zip(first, first[1:])]
                sizes = [size[a:z] for a, z in zip(first, first[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.string()), part.column("quality"),
                     pa.array([f.tobytes() for f in own], pa.binary()), pa.array([s.tolist() for s in sizes], pa.list_(pa.int64()))],
                    ["doc_id", "quality", "features", "sizes"],
                )

    found = rows.mapInArrow(extract, "doc_id string, quality int, features binary, sizes array<long>")
    # One text for each id: ids may be repeated in the documents.
    found = stage(found.dropDuplicates(["doc_id"]))
    lengths = {r["doc_id"]: r["n"] for r in found.select("doc_id", F.size("sizes").alias("n")).collect()}
    taken, left = [], SAMPLE_LINES
    for doc_id in sorted(lengths, key=lambda d: (blake2b(d.encode(), digest_size=8).digest(), d)):
        if lengths[doc_id] <= left:
            taken.append(doc_id)
            left -= lengths[doc_id]
    found = found.filter(F.col("doc_id").isin(taken)).collect()
    found.sort(key=lambda r: r["doc_id"])
    lines = [np.frombuffer(bytes(r["features"]), np.float32).reshape(-1, WIDTH) for r in found]
    first = np.cumsum([0, *[len(x) for x in lines]])
    size = np.array([s for r in found for s in r["sizes"]], np.int64)
    label = np.array([r["quality"] for r in found], float)
    return train(np.concatenate(lines) if lines else np.zeros((0, WIDTH), np.float32), size, first, label)


def score(docs: DataFrame, model: dict, keep: list[str]) -> DataFrame:
    """The `keep` columns with score (probability of label 1) and predicted (score >= THRESHOLD)."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        model = shared.value
        for batch in batches:
            for part in W.slices(batch, "__text"):
                if "curve" in model:
                    bad = bad_share(model, *line_features(part.column("__text")))
                    value = _sigmoid(_spread(bad) * model["curve"][0] + model["curve"][1])
                else:
                    value = np.full(part.num_rows, model["share"])
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in keep], pa.array(value, pa.float64()),
                     pa.array((value >= THRESHOLD).astype(np.int32))],
                    [*keep, "score", "predicted"],
                )

    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in keep], "score double, predicted int"])
    return docs.select(*keep, F.col("text").cast("string").alias("__text")).mapInArrow(work, schema)
