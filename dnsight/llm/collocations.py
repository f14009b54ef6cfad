"""Phrase collocations, counted level by level in HAT-tries.

Each task counts the word sequences of its texts in a trie: a few levels of nodes by the bytes of hashed
word ids, below them containers of sequences, which burst into a node once they are large. When a trie
holds CAPACITY sequences, whole subtrees leave it as sorted runs, the largest first. Runs are shuffled by
prefix (a sequence without its last word, and a bucket of that) and merged there.

Words are counted first, then pairs of frequent words, then triples of frequent pairs: a phrase is as
frequent as its parts at most, so nothing is lost. What is frequent is known to tasks by a bit filter of
fixed size, which may let more through; the merged counts decide. A word is known by a 64-bit hash of
the language and its bytes; equal hashes count as equal words. Counts and scores are exact.

Defined cases: null text is empty; null lang counts as `und`; repeated rows count each; texts and
languages without a frequent phrase give no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dnsight.llm import words as W
from dnsight.sources.storage import stage

#: Words of a phrase, at most, and occurrences, at least.
LONGEST, LEAST = 3, 10
#: Phrases per language that are returned; a phrase is dropped if a longer one has this share of its occurrences.
TOP, COVERED = 2000, 0.5
SCALE = 1_000_000
#: Sequences of a task's trie, those of a container before it bursts, and rows of an Arrow batch.
CAPACITY, BURST, ROWS = 1 << 21, 1 << 15, 1 << 16
#: Buckets of a prefix's last words in the shuffle, and parts of a language in the first ranking.
BUCKETS, PARTS = 64, 64
#: Bits of the filters that tell which words or pairs are frequent (4 MB).
FILTER_BITS = 1 << 25

#: The bytes that separate pieces, and the white space between words.
SEPARATORS = b".,;:!?\n\x0b\x0c\r"
SPACES = b" \t"
_CUT = np.zeros(256, bool)
_CUT[list(SEPARATORS)] = True
_WORD = ~_CUT
_WORD[list(SPACES)] = False


def _merged(block: list[np.ndarray], width: int) -> list[np.ndarray]:
    """The block's distinct sequences in order, their counts added up; of what follows the first of each."""
    order = np.lexsort(block[width - 1:: -1])
    keys = [k[order] for k in block[:width]]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    starts = np.flatnonzero(new)
    if not len(starts):
        return block
    counts = np.add.reduceat(block[width][order], starts)
    return [*[k[starts] for k in keys], counts, *[c[order][starts] for c in block[width + 1:]]]


class Container:
    """Sequences below one trie edge: blocks of columns, merged when as much is new as is merged."""

    def __init__(self, width: int):
        self.width, self.blocks, self.size, self.merged = width, [], 0, 0

    def add(self, block: list[np.ndarray]) -> None:
        self.blocks.append(block)
        self.size += len(block[0])

    def merge(self) -> list[np.ndarray]:
        block = _merged([np.concatenate(c) for c in zip(*self.blocks)], self.width) if len(self.blocks) > 1 else self.blocks[0]
        self.blocks, self.size, self.merged = [block], len(block[0]), len(block[0])
        return block


class HatTrie:
    """Counts of sequences of `width` word ids: a shallow trie of the ids' bytes over burstable containers.

    A node is a dict from a byte to a node or container, from the first byte of the first id on.
    Blocks are columns: the ids, a count, and anything else of which the first value is kept.
    """

    def __init__(self, width: int, burst: int | None = None):
        self.width, self.burst = width, burst or BURST
        self.root, self.size = {}, 0

    def add(self, block: list[np.ndarray]) -> None:
        if len(block[0]):
            self._add(self.root, 0, _merged(block, self.width))

    def _add(self, node: dict, level: int, block: list[np.ndarray]) -> None:
        word, place = divmod(level, 8)
        byte = (block[word] >> np.uint64(56 - 8 * place)) & np.uint64(255)
        edges = np.flatnonzero(byte[1:] != byte[:-1]) + 1
        for low, high in zip([0, *edges.tolist()], [*edges.tolist(), len(byte)]):
            key, part = int(byte[low]), [c[low:high] for c in block]
            child = node.get(key)
            if child is None:
                child = node[key] = Container(self.width)
            if type(child) is dict:
                self._add(child, level + 1, part)
                continue
            child.add(part)
            self.size += high - low
            if child.size > 2 * child.merged + self.burst // 8:
                self.size -= child.size
                whole = child.merge()
                if child.size > self.burst and level + 1 < 8 * self.width:
                    node[key] = {}
                    self._add(node[key], level + 1, whole)
                else:
                    self.size += child.size

    def _taken(self, child) -> Iterator[list[np.ndarray]]:
        """The blocks of a subtree in order; the trie forgets them."""
        if type(child) is dict:
            for key in sorted(child):
                yield from self._taken(child[key])
        else:
            self.size -= child.size
            yield child.merge()

    @staticmethod
    def _held(child) -> int:
        return sum(map(HatTrie._held, child.values())) if type(child) is dict else child.size

    def run(self, least_left: int) -> list[np.ndarray]:
        """Whole subtrees, the largest first, taken out until `least_left` sequences stay: columns in order."""
        sizes, left, keys = {k: self._held(c) for k, c in self.root.items()}, self.size, []
        for key in sorted(sizes, key=sizes.get, reverse=True):
            if left <= least_left:
                break
            left -= sizes[key]
            keys.append(key)
        blocks = [block for key in sorted(keys) for block in self._taken(self.root.pop(key))]
        return [np.concatenate(c) for c in zip(*blocks)]


def _languages(column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The languages, which is each row's, and their hashes."""
    encoded = pc.fill_null(column, "und").dictionary_encode()
    names = encoded.dictionary.to_pylist()
    hashes = W.mix(W.hash_words(names) + np.uint64(11)) if names else np.zeros(0, np.uint64)
    return names, encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), hashes


def _words(part: pa.RecordBatch):
    """Ids of the words of a batch, whether each goes on to the next one, and where they stand."""
    data, offsets = W.column_bytes(part.column("text"))
    starts, ends, first = W.word_spans(data, offsets, _WORD)
    names, language, hashes = _languages(part.column("lang"))
    row = np.repeat(np.arange(part.num_rows), np.diff(first))
    ids = W.mix(W.hash_spans(data, starts, ends) ^ (hashes[language[row]] if len(row) else np.zeros(0, np.uint64)))
    cuts = np.append(0, np.cumsum(_CUT[data]))
    joined = np.zeros(len(ids), bool)
    joined[:-1] = (row[1:] == row[:-1]) & (cuts[starts[1:]] == cuts[ends[:-1]])
    return ids, joined, data, starts, ends, names, language, row


def _known(bits: np.ndarray | None, ids: np.ndarray) -> np.ndarray:
    """Which ids may be in the filter."""
    if bits is None:
        return np.ones(len(ids), bool)
    place = ids % np.uint64(FILTER_BITS)
    return (bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return W.mix(W.mix(left + np.uint64(3)) + right)


def _run_batches(columns: list[np.ndarray], width: int) -> Iterator[pa.RecordBatch]:
    names = [*[f"w{k}" for k in range(1, width + 1)], "n"]
    for at in range(0, len(columns[0]) if columns else 0, ROWS):
        some = [pa.array(c[at: at + ROWS].view(np.int64)) for c in columns]
        yield pa.RecordBatch.from_arrays(some, names)


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word, id, n of every word of every language."""

    def count(batches):
        trie, pool, pooled = HatTrie(1), [], 0

        def spilled():
            columns = trie.run(0)
            if columns:
                # The last column says where in the pool a word's language and text are.
                known = pa.Table.from_batches(pool).take(pa.array(columns.pop()))
                table = known.append_column("id", pa.array(columns[0].view(np.int64))).append_column("n", pa.array(columns[1]))
                yield from table.to_batches(max_chunksize=ROWS)

        for batch in batches:
            for part in W.slices(batch, "text"):
                ids, _, data, starts, ends, names, language, row = _words(part)
                _, place, n = np.unique(ids, return_index=True, return_counts=True)
                # Words and what is between them take turns.
                bounds = np.append(np.stack([starts, ends], axis=1).ravel(), len(data)).astype(np.int64)
                text = pa.LargeStringArray.from_buffers(2 * len(ids), pa.py_buffer(bounds), pa.py_buffer(W._LOWER[data]))
                found = [pa.array(names, pa.string()).take(pa.array(language[row[place]])), text.take(pa.array(2 * place)).cast(pa.string())]
                pool.append(pa.RecordBatch.from_arrays(found, ["lang", "word"]))
                trie.add([ids[place], n, pooled + np.arange(len(place))])
                pooled += len(place)
                if pooled > CAPACITY:
                    yield from spilled()
                    pool, pooled = [], 0
        yield from spilled()

    runs = docs.mapInArrow(count, "lang string, word string, id long, n long")
    return runs.groupBy("lang", "word", "id").agg(F.sum("n").alias("n"))


def sequence_counts(docs: DataFrame, width: int, frequent) -> DataFrame:
    """w1, ..., n of the sequences of `width` words whose parts of one word less may be `frequent` (a broadcast filter)."""

    def count(batches):
        bits = frequent.value
        trie = HatTrie(width)
        for batch in batches:
            for part in W.slices(batch, "text"):
                ids, joined, *_ = _words(part)
                last = len(ids) - width + 1
                if last <= 0:
                    continue
                inside = np.ones(last, bool)
                for k in range(width - 1):
                    inside &= joined[k: k + last]
                parts = ids if width == 2 else np.append(_pair(ids[:-1], ids[1:]), np.zeros(1, np.uint64))
                known = _known(bits, parts)
                at = np.flatnonzero(inside & known[:last] & known[1: last + 1])
                trie.add([*[ids[at + k] for k in range(width)], np.ones(len(at), np.int64)])
                if trie.size > CAPACITY:
                    yield from _run_batches(trie.run(CAPACITY // 2), width)
        yield from _run_batches(trie.run(0), width)

    keys = [f"w{k}" for k in range(1, width + 1)]
    runs = docs.mapInArrow(count, ", ".join(f"{k} long" for k in [*keys, "n"]))
    prefix = [*keys[:-1], "bucket"]
    merged = runs.withColumn("bucket", F.pmod(keys[-1], F.lit(BUCKETS))).repartition(*prefix).groupBy(*prefix, keys[-1])
    return merged.agg(F.sum("n").alias("n")).drop("bucket")


def bit_filter(keys: DataFrame, column: Column) -> np.ndarray:
    """Bits of the keys' places; FILTER_BITS of them, however many keys there are."""
    place = F.pmod(column, F.lit(FILTER_BITS)) + 1
    rows = keys.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in rows.toLocalIterator():
        bits = np.frombuffer(bytes(row["bits"]), np.uint8)
        at = (row["bucket"] - 1) * len(bits)
        out[at: at + len(bits)] = bits
    return out


def _pair_hashes(pairs: DataFrame) -> DataFrame:
    """pair: the hash that `_pair` gives, for frequent pairs."""

    def hashed(batches):
        for batch in batches:
            left, right = (batch.column(c).to_numpy().view(np.uint64) for c in ("w1", "w2"))
            yield pa.RecordBatch.from_arrays([pa.array(_pair(left, right).view(np.int64))], ["pair"])

    return pairs.select("w1", "w2").mapInArrow(hashed, "pair long")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(SCALE * a * a / (left * right)), exactly; it is SCALE at most."""
    wide = lambda c: c.cast("decimal(15,0)")
    return F.call_function("div", F.lit(SCALE).cast("decimal(7,0)") * wide(a) * wide(a), wide(left) * wide(right))


def _lowest(a: Column, cuts: list[tuple[Column, Column]]) -> Column:
    """score, cut, l, r of the cut with the lowest score, the first of equal ones."""
    return F.least(*[
        F.struct(_score(a, left, right).alias("score"), F.lit(k).alias("cut"), left.alias("l"), right.alias("r"))
        for k, (left, right) in enumerate(cuts, 1)
    ]) if len(cuts) > 1 else F.struct(
        _score(a, *cuts[0]).alias("score"), F.lit(1).alias("cut"), cuts[0][0].alias("l"), cuts[0][1].alias("r")
    )


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, cut of each language's best phrases of two and three words."""
    docs = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    context = docs.sparkSession.sparkContext
    words = stage(word_counts(docs))
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    common = stage(words.filter(F.col("n") >= least))
    pairs = stage(
        sequence_counts(docs, 2, context.broadcast(bit_filter(common, F.col("id")))).filter(F.col("n") >= least)
    )
    triples = stage(
        sequence_counts(docs, 3, context.broadcast(bit_filter(_pair_hashes(pairs), F.col("pair")))).filter(F.col("n") >= least)
    )
    word = lambda k: common.select(F.col("id").alias(f"w{k}"), F.col("n").alias(f"n{k}"), F.col("word").alias(f"t{k}"))
    language = common.select(F.col("id").alias("w1"), "lang")
    a = F.col("n")
    found3 = (
        triples.join(pairs.select("w1", "w2", F.col("n").alias("n12")), ["w1", "w2"])
        .join(pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("n").alias("n23")), ["w2", "w3"])
    )
    covering = found3.filter(100 * F.col("n") >= int(100 * COVERED) * F.least("n12", "n23"))
    inner = (
        covering.filter(100 * F.col("n") >= int(100 * COVERED) * F.col("n12")).select("w1", "w2")
        .union(covering.filter(100 * F.col("n") >= int(100 * COVERED) * F.col("n23")).select("w2", "w3")).distinct()
    )
    best3 = found3.join(word(1), "w1").join(word(3), "w3").join(word(2).drop("n2"), "w2").join(language, "w1").select(
        "lang", F.concat_ws(" ", "t1", "t2", "t3").alias("phrase"), a.alias("a"),
        _lowest(a, [(F.col("n1"), F.col("n23")), (F.col("n12"), F.col("n3"))]).alias("best"),
    )
    best2 = (
        pairs.join(inner, ["w1", "w2"], "left_anti").join(word(1), "w1").join(word(2), "w2").join(language, "w1")
        .select(
            "lang", F.concat_ws(" ", "t1", "t2").alias("phrase"), a.alias("a"),
            _lowest(a, [(F.col("n1"), F.col("n2"))]).alias("best"),
        )
    )
    scored = best2.unionByName(best3).select("lang", "phrase", "a", "best.*")
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # A language may hold most phrases, so the best of its parts are found first.
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*order)
    heads = scored.withColumn("place", F.row_number().over(part)).filter(F.col("place") <= top)
    ranked = heads.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("rank") <= top).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score", F.col("cut").cast("long").alias("cut")
    )
