"""Best-fit packing of tokenized documents by a configuration linear program.

A configuration is a multiset of piece lengths that fits into a sequence. The program covers the
histogram of lengths by as few configurations as possible. It is solved by multiplicative weights:
every length has a price that falls as it is covered, a knapsack dynamic program finds configurations
of the highest total price, and these are added. The fractional solution is then rounded: whole
multiples of its configurations are used while all their pieces are left, and what remains is packed
largest first, each sequence filled with the largest length that still fits.

Only the histogram (one count for each length, at most `capacity` rows) and the configurations reach
the driver; the pieces are numbered within their length and find their place by a lookup.

Defined cases: null text counts as empty and is one piece of the final id 0; an empty table gives an
empty result; repeated rows are packed each; other columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dnsight.llm.tokens import Encoder
from dnsight.sources.storage import stage

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int) -> DataFrame:
    """Pieces of every document: its ids and a final 0, cut into `capacity` if longer.

    Only the first piece of a document may be shorter than `capacity`.
    """

    def cut(batches):
        encoder = Encoder(tokenizer)
        for batch in batches:
            out = [[], [], [], [], []]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = np.append(encoder.ids(text.as_py() or ""), np.uint32(0)).astype("<u4")
                first = (len(ids) - 1) % capacity + 1
                edges = [0, *range(first, len(ids) + 1, capacity)]
                for piece, (start, end) in enumerate(zip(edges, edges[1:])):
                    crc = zlib.crc32(ids[start:end].tobytes())
                    for column, value in zip(out, (doc_id, piece, start, end - start, crc)):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return rows.mapInArrow(cut, PIECES)


def price(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Knapsack with repetition: best value within each capacity, and the size taken there (0: none)."""
    best, taken = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    fits = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        if fits[room]:
            total = best[room - sizes[: fits[room]]] + values[: fits[room]]
            top = int(total.argmax())
            if total[top] > best[room]:
                best[room], taken[room] = total[top], sizes[top]
    return best, taken


def _traced(taken: np.ndarray, room: int, head: int = 0) -> tuple[int, ...]:
    """Lengths of the best configuration within a capacity, after `head`."""
    found = [head] if head else []
    while room:
        if taken[room]:
            found.append(int(taken[room]))
            room -= int(taken[room])
        else:
            room -= 1
    return tuple(sorted(found, reverse=True))


def fractional_cover(
    sizes: np.ndarray, counts: np.ndarray, capacity: int, rounds: int = 60, each: int = 48,
    rate: float = 0.1, power: float = 1.2,
) -> dict[tuple[int, ...], float]:
    """A fractional cover of the histogram by configurations, by multiplicative weights.

    In each round the `each` best configurations found by one pricing, at most one headed by each
    length, are used as often as their scarcest length allows; the prices of what they cover fall.
    Prices start a little above proportion (`power`), so that long pieces are placed early and short
    ones are left for the gaps.
    """
    at = {int(s): i for i, s in enumerate(sizes)}
    cover, used = np.zeros(len(sizes)), {}
    weights = (sizes / capacity) ** power

    def use(configuration):
        lengths, times = np.unique([at[s] for s in configuration], return_counts=True)
        share = (counts[lengths] / times).min()
        used[configuration] = used.get(configuration, 0.0) + share
        cover[lengths] += share * times / counts[lengths]

    for turn in range(rounds):
        values = weights * np.exp(-rate * (cover - cover.min()))
        best, taken = price(values, sizes, capacity)
        totals = values + best[capacity - sizes]
        # The last round covers what no round has covered.
        heads = (
            np.flatnonzero(cover == 0) if turn == rounds - 1 else np.argsort(-totals, kind="stable")[:each]
        )
        for head in heads:
            use(_traced(taken, capacity - int(sizes[head]), int(sizes[head])))
    # A configuration is scaled by its most covered length, so no count is exceeded.
    return {c: x / max(1.0, cover[[at[s] for s in c]].max()) for c, x in used.items()}


def pack_histogram(
    histogram: dict[int, int], capacity: int, passes: int = 2, **options
) -> list[tuple[tuple[int, ...], int]]:
    """Configurations and how often each is used, so that all pieces of the histogram are packed."""
    left = {s: int(n) for s, n in sorted(histogram.items()) if n > 0}
    if any(not 0 < s <= capacity for s in left):
        raise ValueError("lengths must be between 1 and the capacity")
    packed = []
    if left.get(capacity):
        packed.append(((capacity,), left.pop(capacity)))

    def take(configuration, most):
        need = {s: configuration.count(s) for s in set(configuration)}
        times = min(most, *(left[s] // n for s, n in need.items()))
        if times > 0:
            packed.append((configuration, times))
            for s, n in need.items():
                left[s] -= n * times
        return times

    # What rounding down leaves over is covered again, a few times.
    for _ in range(passes):
        sizes = np.array([s for s, n in left.items() if n], np.int64)
        if not len(sizes):
            break
        counts = np.array([left[s] for s in sizes.tolist()], float)
        cover = fractional_cover(sizes, counts, capacity, **options)
        before = len(packed)
        for configuration, x in sorted(cover.items(), key=lambda c: (-sum(c[0]), -c[1], c[0])):
            take(configuration, int(x))
        if len(packed) == before:
            break
    lengths = sorted(s for s, n in left.items() if n)
    while lengths:
        room, chosen, spent = capacity, [], {}
        place = len(lengths)
        while place:
            place = bisect_right(lengths, room, 0, place)
            if not place:
                break
            s = lengths[place - 1]
            times = min(left[s] - spent.get(s, 0), room // s)
            chosen += [s] * times
            spent[s] = spent.get(s, 0) + times
            room -= s * times
            place -= 1
        take(tuple(chosen), left[chosen[0]])
        lengths = [s for s in lengths if left[s]]
    return packed


def _places(packed: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """For each length: rows (first rank, copies per sequence, first sequence, offset of the first)."""
    ranks, rows, sequence = {}, {}, 0
    for configuration, times in packed:
        offset = 0
        for size in sorted(set(configuration), reverse=True):
            copies = configuration.count(size)
            rows.setdefault(size, []).append((ranks.get(size, 0), copies, sequence, offset))
            ranks[size] = ranks.get(size, 0) + copies * times
            offset += copies * size
        sequence += times
    return {size: np.array(r, np.int64) for size, r in rows.items()}


def ranked(pieces: DataFrame, salts: int) -> DataFrame:
    """Number the pieces of each length from 0. A length is numbered in `salts` parts, then shifted."""
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int"))
    parts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    shifts = parts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    return (
        salted.withColumn("number", F.row_number().over(within) - 1)
        .join(shifts, ["length", "salt"])
        .withColumn("rank", F.col("number") + F.col("shift")).drop("number", "shift", "salt")
    )


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, **options) -> DataFrame:
    """Every piece of every document with its sequence and its offset there."""
    spark = docs.sparkSession
    pieces = stage(cut_pieces(docs, tokenizer, capacity))
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    places = _places(pack_histogram(histogram, capacity, **options))
    salts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)

    def put(batches):
        for frame in batches:
            sequence, offset = np.zeros(len(frame), np.int64), np.zeros(len(frame), np.int64)
            lengths, ranks = frame["length"].to_numpy(), frame["rank"].to_numpy()
            for size in np.unique(lengths):
                mine, rows = lengths == size, places[int(size)]
                row = rows[np.searchsorted(rows[:, 0], ranks[mine], side="right") - 1]
                turn, copy = np.divmod(ranks[mine] - row[:, 0], row[:, 1])
                sequence[mine], offset[mine] = row[:, 2] + turn, row[:, 3] + copy * size
            yield pd.DataFrame(
                {**{c: frame[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")},
                 "sequence_id": sequence, "offset": offset}
            )

    return ranked(pieces, salts).mapInPandas(put, PIECES + ", sequence_id long, offset long")
