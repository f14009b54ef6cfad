"""Operators for training data against brute force, on small tables and on odd input."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dnsight.llm import (
    decontamination, jaccard, language, licenses, line_dedup, packing, quality, sharding, syncmers,
    token_counts,
)
from dnsight.llm import words as W
from dnsight.llm.components import components
from dnsight.llm.tokens import Encoder, default_tokenizer
from dnsight.sources import storage
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Null in every column, empty and odd texts, repeated rows, repeated ids, one very long word and text.
ODD = [
    (1, "The first text of a small table, with some words in it.\nAnd a line.", "en", "a", 3),
    (1, "The first text of a small table, with some words in it.\nAnd a line.", "en", "a", 3),
    (1, "Another text under the same id.", "en", None, 3),
    (None, "A text without an id. Released under the MIT License.", None, "b", None),
    (None, None, None, None, None),
    (2, "", "en", "b", 0),
    (3, None, "de", "b", None),
    (4, " \n\n \t", "de", "b", 5),
    (5, "x" * 30_000, "de", "b", 30_000),
    (6, "word " * 20_000, "fr", "b", 100_000),
    (7, "ein zwei drei", "de", "b", 13),
    (8, "ein zwei drei", "de", "c", 13),
    (9, "é ñ ü \U0001f600 <|endoftext|> 漢字かな", "es", "c", 9),
    (10, "12345 !!! ???", "es", "c", 13),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).selectExpr(
        # Extra columns with names that the operators use themselves.
        "*", "1 as piece", "2 as score", "3 as slot", "'x' as shard", "4 as place", "5 as class",
        "6 as n_words", "7 as removed", "8 as rank", "9 as hash", "10 as key",
    )


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lowered(text))


def alphanumeric(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


class Union:
    def __init__(self):
        self.parent = {}

    def root(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def test_word_hashes():
    texts = ["Hello, World foo\nbar", "", None, "é à X", "a" * 1300 + " b", "next"]
    for table, words in ((W.NOT_SPACE, spaced), (W.ALPHANUMERIC, alphanumeric)):
        hashes, first = W.word_hashes(pa.array(texts), table)
        expected = [w for t in texts for w in words(t)]
        assert np.diff(first).tolist() == [len(words(t)) for t in texts]
        assert (W.hash_words(expected) == hashes).all()
        assert len(set(hashes.tolist())) == len(set(expected))
    sliced = pa.array(texts).slice(3, 2)
    assert W.word_hashes(sliced, W.NOT_SPACE)[1].tolist() == [0, 3, 5]


@pytest.mark.parametrize("nodes, count", [(60, 50), (200, 190)])
def test_components(spark, nodes, count):
    random.seed(nodes)
    links = [(random.randrange(nodes), random.randrange(nodes)) for _ in range(count)]
    links += [(i, i + 1) for i in range(nodes + 1, nodes + 30)] + [(None, 1), (3, 3)]
    union = Union()
    for a, b in links:
        if a is not None and a != b:
            union.join(a, b)
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len(rows) == len(union.parent)
    assert {r.node: r.root for r in rows} == {x: union.root(x) for x in union.parent}


def test_components_without_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# 1: token counts


def test_encoder_is_the_plain_encoder(documents):
    encoder = Encoder(default_tokenizer())
    texts = [r.text for r in documents.limit(60).collect()] + [t for _, t, *_ in ODD if t]
    for text in texts + ["", " ", "  a", "don't  stop", "a\x1c b", "<|endoftext|> x"]:
        plain = encoder.plain.encode(text, add_special_tokens=False).ids
        assert encoder.ids(text).tolist() == plain


def test_tree_follows_edits():
    encoder = Encoder(default_tokenizer())
    count = lambda text: len(encoder.ids(text))
    random.seed(5)
    for text in ["", " ", "a b", "ab " * 400, "x  y " * 300, "q" * 900, "some words, here\n" * 90]:
        parts = token_counts.leaves(text)
        assert "".join(parts) == text
        tree = token_counts.Tree(parts, [count(p) for p in parts])
        for _ in range(12):
            start, removed = random.randint(0, len(text) + 2), random.choice([0, 1, 3, 40, 400])
            inserted = random.choice(["", " ", "  ", "foo", " bar baz", "\n", " w w" * 90])
            tree.edit(start, removed, inserted, count)
            start = min(start, len(text))
            text = text[:start] + inserted + text[start + removed:]
            assert "".join(tree.texts) == text
            assert (tree.chars, tree.tokens) == (len(text), count(text))


def test_token_counts(spark, odd):
    encoder = Encoder(default_tokenizer())
    edits = "array(struct(2L as start, 3L as removed, ' new' as inserted), null, struct(cast(null as bigint) as start, cast(null as bigint) as removed, cast(null as string) as inserted))"
    docs = odd.selectExpr("doc_id", "text", "score", f"cast({edits} as {token_counts.EDITS}) as edits")
    rows = token_counts.update_counts(docs, default_tokenizer()).collect()
    assert len(rows) == len(ODD) and all(r.score == 2 for r in rows)
    edited = lambda t: t[:2] + " new" + t[5:]
    expected = sorted(
        (len(t or ""), len(encoder.ids(t or "")), len(edited(t or "")), len(encoder.ids(edited(t or ""))))
        for _, t, *_ in ODD
    )
    assert sorted((r.n_chars, r.n_tokens, r.edited_n_chars, r.edited_n_tokens) for r in rows) == expected
    assert all(sum(r.leaf_tokens) == r.n_tokens and sum(r.leaf_chars) == r.n_chars for r in rows)
    assert token_counts.token_counts(empty(spark), default_tokenizer()).count() == 0


def test_stored_trees_follow_edits(spark, odd):
    """Edits in turn, each by the trees that the one before stored; only what they touch is encoded."""
    encoder = Encoder(default_tokenizer())
    docs = odd.select("doc_id", "text", "score").unionByName(spark.createDataFrame([(50, "some words " * 5000, 2)], "doc_id long, text string, score int"))
    expected = [t or "" for t in [*(t for _, t, *_ in ODD), "some words " * 5000]]
    trees = storage.stage(token_counts.apply_edits(docs, default_tokenizer()))
    for start, removed, inserted in ((3, 2, " new words"), (0, 1, ""), (10**9, 0, " at the end"), (40, 4000, "x")):
        edits = f"array(struct({start}L as start, {removed}L as removed, '{inserted}' as inserted))"
        # Counts of the row before do not matter, its leaves do.
        edited = token_counts.apply_edits(trees.selectExpr("*", f"cast({edits} as {token_counts.EDITS}) as edits"), default_tokenizer())
        trees = storage.stage(edited)
        expected = [t[:start] + inserted + t[start + removed:] for t in expected]
        rows = trees.collect()
        assert sorted((r.text, r.n_chars, r.n_tokens) for r in rows) == sorted((t, len(t), len(encoder.ids(t))) for t in expected)
        assert all(sum(r.leaf_chars) == r.n_chars and sum(r.leaf_tokens) == r.n_tokens and r.score == 2 for r in rows)
        assert max(r.reencoded_chars for r in rows if r.doc_id == 50) < 6000
    stale = trees.withColumn("text", F.concat("text", F.lit(" more"))).drop("edits")
    again = token_counts.apply_edits(stale, default_tokenizer()).collect()
    assert sorted((r.text, r.n_tokens) for r in again) == sorted((t + " more", len(encoder.ids(t + " more"))) for t in expected)


# 2: fingerprints


def test_edited_texts_and_likeness(documents):
    rows = {r.doc_id: r for r in syncmers.compare_edits(documents).collect()}
    texts = sorted((r.doc_id, r.text) for r in documents.collect())
    assert len(rows) == len(texts)
    prints = {}
    for (doc_id, text), (next_id, following) in zip(texts, texts[1:] + texts[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        row = rows[doc_id]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
        assert prints.setdefault(text, row.fingerprint) == row.fingerprint
        if len(text) > 1500 and len(following) > 800 and text != following:
            assert row.near_edited > row.near_next
    assert len(set(prints.values())) == len(prints)


def test_anchors_are_context_free(spark):
    random.seed(2)
    passage = " ".join(f"w{random.randrange(900)}" for _ in range(60))
    rows = spark.createDataFrame([(1, f"{passage} end"), (2, f"some other words go first {passage}")], "doc_id long, text string")
    found = syncmers.matches(rows.filter("doc_id = 1"), rows.filter("doc_id = 2")).orderBy("n_anchors", ascending=False).first()
    assert found.shift == 5 and found.n_anchors >= 20


def test_anchors_of_text_without_spaces(spark):
    rng = random.Random(6)
    for count in (60, 600, 6000):
        text = "".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(count))
        rows = spark.createDataFrame([(1, text), (2, "一" + text)], "doc_id long, text string")
        own, shifted = rows.filter("doc_id = 1"), rows.filter("doc_id = 2")
        n = own.select(F.size(syncmers.anchors(F.col("text")))).first()[0]
        found = syncmers.matches(own, shifted).filter("shift = 1").first()
        assert n >= count / 4 and found.n_anchors == n
        assert syncmers.compare_edits(rows).filter("near_next < 0.85").count() == 0


def test_short_different_texts_differ(spark):
    rng = random.Random(7)
    texts = [" ".join(f"w{rng.randrange(9**6)}" for _ in range(5 + k % 2)) for k in range(60)]
    rows = syncmers.compare_edits(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")).collect()
    assert all(r.fingerprint and r.near_next == 0 for r in rows)
    assert len({r.fingerprint for r in rows}) == len(texts)


def test_long_texts(spark):
    """A changed end gives another fingerprint, and a shared passage some likeness; each against all anchors."""
    rng = random.Random(8)
    words = lambda count: [f"w{rng.randrange(50_000)}" for _ in range(count)]
    one, passage = words(20_000), words(1500)
    texts = [one, one[:-12] + words(12), words(9000) + passage + words(9000), passage + words(18_000), one[:10_000] + words(10_000)]
    rows = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    anchors = syncmers.anchors(F.col("text"))
    found = rows.select("doc_id", syncmers.sketch(anchors).alias("s"), syncmers.fingerprint(syncmers.sketch(anchors), F.col("text")).alias("f"), anchors["hash"].alias("a"))
    found = found.orderBy("doc_id").collect()
    assert len({r.f for r in found}) == len(texts) and min(len(r.s) for r in found) > 200
    pairs = spark.createDataFrame([(a, b, found[a].s, found[b].s) for a, b in ((0, 1), (2, 3), (0, 4), (0, 2), (0, 0))], "a int, b int, x array<long>, y array<long>")
    near = {(r.a, r.b): r.n for r in pairs.select("a", "b", syncmers.likeness(F.col("x"), F.col("y")).alias("n")).collect()}
    for (a, b), value in near.items():
        x, y = set(found[a].a), set(found[b].a)
        assert abs(value - len(x & y) / len(x | y)) < 0.06
    assert near[0, 1] > 0.97 and near[2, 3] > 0 and near[0, 2] < 0.01 and near[0, 0] == 1.0


def test_fingerprints_of_odd_rows(spark, odd):
    rows = syncmers.compare_edits(odd).collect()
    assert len(rows) == len(ODD)
    assert all(r.fingerprint == "" for r in rows if r.n_chars == 0)
    single = syncmers.compare_edits(spark.createDataFrame([(5, "a b c d e f g")], "doc_id long, text string")).first()
    assert single.near_next == 1.0
    assert syncmers.compare_edits(empty(spark)).count() == 0


# 3: sharding


def test_filled_table():
    names = [f"s{k}" for k in range(7)]
    owner = sharding.fill(names, 1009)
    counts = np.bincount(owner)
    assert counts.max() - counts.min() <= 1
    # Taking turns by hand: nobody holds a slot that another shard reached earlier in its turn.
    start = [sharding._number(f"start {n}") % 1009 for n in names]
    assert all(owner[s] >= 0 for s in start) and owner[start[0]] == 0
    fewer = sharding.fill(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(owner, fewer) if a != 6)
    assert moved < 0.25 * 1009
    with pytest.raises(ValueError):
        sharding.fill(names, 1000)


def test_placement_keeps_all_rows(spark, odd):
    names = ["a", "b", "c"]
    placed = sharding.place(odd, ["doc_id"], names, 101)
    rows = placed.collect()
    assert len(rows) == len(ODD) and {r.shard for r in rows} <= set(names)
    owner = sharding.fill(names, 101)
    assert all(r.shard == names[owner[r.slot]] for r in rows)
    assert len({r.slot for r in rows if r.doc_id == 1}) == 1
    assert sharding.place(empty(spark), ["doc_id"], names, 101).count() == 0


def test_written_shards(spark, odd, folder):
    placed = sharding.place(odd, ["doc_id"], ["a", "b"], 101)
    sharding.write_shards(placed, f"{folder}/shards", splits=3)
    assert spark.read.parquet(f"{folder}/shards").count() == len(ODD)
    back = sharding.read_shards(placed, f"{folder}/shards")
    assert back.columns == placed.columns
    assert sorted(map(str, back.collect())) == sorted(map(str, placed.collect()))
    nothing = sharding.place(empty(spark), ["doc_id"], ["a", "b"], 101)
    sharding.write_shards(nothing, f"{folder}/none")
    assert sharding.read_shards(nothing, f"{folder}/none").count() == 0


# 4: line dedup


def shingled(line):
    return {line[i: i + 5] for i in range(len(line) - 4)} if len(line) >= 5 else {line}


def test_line_dedup(documents):
    places, lines = {}, []
    for row in documents.collect():
        for place, line in enumerate(row.text.split("\n")):
            line = line.strip(" ").lower()
            if line.strip():
                places.setdefault(line, []).append((row.doc_id, place))
    lines, union = [*places], Union()
    sets = [shingled(line) for line in lines]
    for i, a in enumerate(sets):
        union.root(i)
        for j in range(i):
            if 3 * len(a) <= 4 * len(sets[j]) and 3 * len(sets[j]) <= 4 * len(a):
                shared = len(a & sets[j])
                if shared >= 0.75 * (len(a) + len(sets[j]) - shared):
                    union.join(i, j)
    groups = {}
    for i, line in enumerate(lines):
        groups.setdefault(union.root(i), []).extend(places[line])
    expected = {p for g in groups.values() for p in sorted(g)[1:]}
    found = {(r.doc_id, r.place) for r in line_dedup.removed_lines(documents).collect()}
    assert not found - expected
    assert len(found) >= 0.97 * len(expected)


def test_line_links_of_a_large_bucket(spark):
    """Lines that share a band and are similar are connected, and no others, in a large group of copies."""
    rng = random.Random(5)
    words = lambda n: ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(n)]
    lines = set()
    for _ in range(2):
        base = words(60)
        for k in range(120):
            copy = [w if rng.random() > k / 400 else words(1)[0] for w in base]
            lines.add(" ".join(copy[: rng.choice([60, 60, 60, 45, 20])]))
    lines = sorted(lines)
    table = spark.createDataFrame([(line,) for line in lines], "line string").withColumn("hash", F.xxhash64("line"))
    keys = F.array(*[f"k{j}" for j in range(line_dedup.BANDS)]).alias("keys")
    rows = table.join(line_dedup.bands(table).select("hash", keys), "hash").collect()
    union, sets = Union(), {r.hash: shingled(r.line) for r in rows}
    for i, r in enumerate(rows):
        for o in rows[:i]:
            a, b = sets[r.hash], sets[o.hash]
            if set(r.keys) & set(o.keys) and len(a & b) >= 0.75 * len(a | b):
                union.join(r.hash, o.hash)
    links = line_dedup.line_links(table).collect()
    found = Union()
    for a, b in links:
        assert len(sets[a] & sets[b]) >= 0.75 * len(sets[a] | sets[b])
        found.join(a, b)
    groups = lambda u: sorted(sorted(h for h in sets if u.root(h) == r) for r in {u.root(h) for h in sets})
    assert groups(found) == groups(union)
    assert 4 < len(groups(union)) < len(lines)


def test_pairs_compared_in_parts(spark, monkeypatch):
    """Parts of the pairs give the rows of all pairs together, and each part is a table of its own."""
    lines = [f"the quick brown fox jumps over {k % 7} lazy dogs and {k} cats" for k in range(40)]
    table = spark.createDataFrame([(k - 20, line) for k, line in enumerate(lines)], "hash long, line string")
    pairs = spark.createDataFrame([(k - 20, o - 20) for k in range(40) for o in range(0, k, 3)], "a long, b long")
    written = []
    monkeypatch.setattr(line_dedup, "stage", lambda df: written.append(storage.stage(df)) or written[-1])
    whole = line_dedup._compared(pairs, table).collect()
    assert len(written) == 1
    monkeypatch.setattr(line_dedup, "PAIRS", 10)
    parts = line_dedup._compared(pairs, table).collect()
    assert len(written) == 1 + line_dedup.PARTS
    assert sorted(parts) == sorted(whole) and len(whole) == pairs.count()


def test_band_keys_packed(spark):
    """Rows that share a packed key are those that share a band, and equal lines of several batches are one line."""
    rng = random.Random(8)
    base = ["".join(rng.choices("abcdef ", k=60)) for _ in range(12)]
    lines = base + [b[:40] + "".join(rng.choices("abcdef ", k=20)) for b in base] + ["x" * 50] * 3
    table = spark.createDataFrame([(line,) for line in lines], "line string").repartition(5).withColumn("hash", F.xxhash64("line"))
    rows = {(r.hash, j, r[f"k{j}"]) for r in line_dedup.bands(table).collect() for j in range(line_dedup.BANDS)}
    buckets = {}
    for line, j, key in rows:
        buckets.setdefault((j, key), set()).add(line)
    expected = sorted(sorted(b) for b in buckets.values() if len(b) > 1)
    found = {}
    for r in line_dedup._all_shared(table).collect():
        found.setdefault(r.key, set()).add(r.hash)
    assert sorted(sorted(b) for b in found.values()) == expected and expected


def test_line_dedup_of_odd_rows(spark, odd):
    rows = line_dedup.dedup_lines(odd).collect()
    assert len(rows) == len(ODD) and rows[0].score == 2
    texts = sorted(r.text for r in rows if r.doc_id in (7, 8))
    assert texts == ["", "ein zwei drei"]
    assert [r.text for r in rows if r.doc_id == 4] == [" \n\n \t"]
    assert {r.text for r in rows if r.doc_id == 3} == {None}
    assert line_dedup.summary(odd).count() == len(ODD)
    assert line_dedup.dedup_lines(empty(spark)).count() == 0


LINE_PAIRS = [
    ("the quick brown fox", "the quick brown fix"), ("abc", "abcd"), ("abc", "abc"), ("abcde", "abcdef"),
    ("é ñ ü \U0001f600 漢字かな", "é ñ ü \U0001f600 漢字か"), ("aaaaaaaaaaaa", "aaaaaa"), ("x" * 70_000, "x" * 69_999 + "y"),
]


def test_shingles_and_similarity():
    left, right = (pa.array(column) for column in zip(*LINE_PAIRS))
    number = {line: k for k, line in enumerate({line for pair in LINE_PAIRS for line in pair})}
    a, b = (np.array([number[line] for line in column]) for column in zip(*LINE_PAIRS))
    sizes, alike = line_dedup.likeness(left, right, a, b)
    for (x, y), size, found in zip(LINE_PAIRS, sizes, alike):
        p, q = shingled(x), shingled(y)
        assert size == len(q) and found == len(p & q) / len(p | q)


def test_odd_sketches_bound_the_difference():
    lines = [line for pair in LINE_PAIRS for line in pair]
    rows = np.unpackbits(line_dedup.sketches(pa.array(lines)).view(np.uint8), axis=1)
    for x, p in zip(lines, rows):
        for y, q in zip(lines, rows):
            assert np.count_nonzero(p != q) <= len(shingled(x) ^ shingled(y))


def test_signatures_do_not_depend_on_the_batch():
    lines = [line for pair in LINE_PAIRS for line in pair] + ["\t a\tb", "\t"]
    keys, found = line_dedup.signatures(pa.array(lines))
    assert list(found) == [True] * (len(lines) - 1) + [False]
    for line, key in zip(lines, keys):
        alone, _ = line_dedup.signatures(pa.array(["before", line, "after"]).slice(1, 1))
        assert (alone[0] == key).all()


def planted_pairs(kind, low, high, count=400):
    """Lines and changed copies of a similarity from `low` to below `high`."""
    rng, pairs = random.Random(f"{kind} {low}"), []
    letters = "天地玄黃宇宙洪荒日月盈昃辰宿列張寒來暑往" if kind == "spaceless" else "abcdefghijklmnop"
    sizes = {"short": (20, 60), "middle": (60, 150), "long": (150, 500), "spaceless": (30, 300)}[kind]
    while len(pairs) < count:
        line = "".join(rng.choices(letters, k=rng.randint(*sizes)))
        if kind != "spaceless":
            line = "".join(" " if rng.random() < 0.18 else c for c in line).strip()
        copy = list(line)
        for _ in range(rng.randint(1, max(1, len(line) // 25))):
            place = rng.randrange(len(copy))
            copy[place: place + rng.randint(0, 1)] = rng.choice(letters)
        a, b = shingled(line), shingled("".join(copy))
        if low <= len(a & b) / len(a | b) < high:
            pairs.append((line, "".join(copy)))
    return pairs


@pytest.mark.parametrize("kind", ["short", "middle", "long", "spaceless"])
@pytest.mark.parametrize("low, high, least", [(0.75, 0.8, 0.97), (0.8, 0.9, 0.985)])
def test_similar_lines_share_a_band(kind, low, high, least):
    left, right = zip(*planted_pairs(kind, low, high))
    a, b = (line_dedup.signatures(pa.array(lines))[0] for lines in (left, right))
    assert (a == b).any(axis=1).mean() >= least


# 5: packing


def test_packing_is_whole_and_dense(documents, odd, spark):
    encoder, capacity = Encoder(default_tokenizer()), 2048
    for docs in (documents, odd):
        ids = {}
        for row in docs.collect():
            ids.setdefault(row.doc_id, []).append([*encoder.plain.encode(row.text or "", add_special_tokens=False).ids, 0])
        rows = packing.pack(docs, default_tokenizer(), capacity).collect()
        expected = []
        for doc_id, texts in ids.items():
            for own in texts:
                first = (len(own) - 1) % capacity + 1
                edges = [0, *range(first, len(own) + 1, capacity)]
                for k, (a, z) in enumerate(zip(edges, edges[1:])):
                    crc = zlib.crc32(np.array(own[a:z], "<u4").tobytes())
                    expected.append((doc_id, k, a, z - a, crc))
        key = lambda r: (r[0] is None, r[0] or 0, *r[1:5])
        assert sorted(map(key, rows)) == sorted(map(key, expected))
        sequences = {}
        for r in rows:
            sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for parts in sequences.values():
            end = 0
            for offset, length in sorted(parts):
                assert offset == end
                end += length
            assert end <= capacity
        total = sum(r.length for r in rows)
        assert len(sequences) <= -(-total // capacity) * 1.02 + 1
    assert packing.pack(empty(spark), default_tokenizer()).count() == 0


def test_packed_histogram_against_the_optimum():
    # Pairs that fill a sequence exactly: the optimum is known.
    random.seed(1)
    histogram = {}
    for _ in range(400):
        a = random.randint(1, 99)
        for s in (a, 100 - a):
            histogram[s] = histogram.get(s, 0) + 1
    packed = packing.pack_histogram(histogram, 100)
    assert sum(n for _, n in packed) <= 404
    used = {}
    for configuration, n in packed:
        assert sum(configuration) <= 100
        for s in configuration:
            used[s] = used.get(s, 0) + n
    assert used == histogram
    assert packing.pack_histogram({}, 100) == []


def test_knapsack_pricing():
    values, sizes = np.array([1.0, 2.5, 4.0]), np.array([2, 3, 5])
    best, _ = packing.price(values, sizes, 11)
    brute = max(
        a * 1.0 + b * 2.5 + c * 4.0
        for a in range(6) for b in range(4) for c in range(3) if 2 * a + 3 * b + 5 * c <= 11
    )
    assert best[11] == pytest.approx(brute)


# 6: language


def test_language_of_held_out_documents(documents):
    learned = documents.withColumn("held_out", quality.fold() == 0)
    model = language.fit(learned.filter("not held_out"))
    rows = language.predict(learned, model, "doc_id long, lang string, held_out boolean", ["doc_id", "lang", "held_out"])
    held = [r for r in rows.collect() if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in held)


def test_rare_languages_among_many_rows(spark):
    many = spark.range(100_000).selectExpr("concat('the word ', id, ' and the next') as text", "'en' as lang")
    words = {f"x{k:02d}": "".join(chr(0x4E00 + 40 * k + c) for c in range(30)) for k in range(20)}
    rare = spark.createDataFrame([(text, lang) for lang, text in words.items()], "text string, lang string")
    model = language.fit(many.unionByName(rare))
    assert model[0] == ["en", *sorted(words)]
    docs = spark.createDataFrame([(lang, text[5:20]) for lang, text in words.items()], "doc_id string, text string")
    found = language.predict(docs, model, "doc_id string", ["doc_id"]).collect()
    assert all(r.lang_pred == r.doc_id for r in found)


def test_language_of_odd_rows(spark, odd):
    model = language.fit(odd)
    rows = language.predict(odd, model, "doc_id long", ["doc_id"]).collect()
    assert len(rows) == len(ODD)
    without = [r for r in rows if r.doc_id in (2, 3, 4, 10)]
    assert {(r.lang_pred, r.score) for r in without} == {("und", 0.0)}
    nothing = language.fit(empty(spark))
    assert {r.lang_pred for r in language.predict(odd, nothing, "doc_id long", ["doc_id"]).collect()} == {"und"}
    assert language.predict(empty(spark), model, "doc_id long", ["doc_id"]).count() == 0


# 7: decontamination


def contamination_by_hand(docs, items, width=13):
    windows = {}
    for item, text in items:
        words = alphanumeric(text)
        for start in range(max(len(words) - width, 0) + 1) if words else []:
            windows.setdefault(tuple(words[start: start + width]), set()).add(str(item))
    rows = []
    for doc_id, text in docs:
        words, hit, found = alphanumeric(text), set(), set()
        for size in {len(w) for w in windows}:
            for start in range(len(words) - size + 1):
                window = tuple(words[start: start + size])
                if window in windows:
                    hit |= set(range(start, start + size))
                    found |= windows[window]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        rows.append((doc_id, len(words), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(words)))
    return sorted(rows, key=str)


@pytest.mark.parametrize("block_chars", [1 << 25, 8000])
def test_contamination(spark, documents, block_chars):
    benchmark = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    found = decontamination.contamination(documents, benchmark, block_chars).collect()
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    assert sorted(map(tuple, found), key=str) == contamination_by_hand(docs, items)


def test_contamination_of_odd_rows(spark, odd):
    items = [(1, "ein zwei drei"), (2, None), (None, "a text without"), (3, "!!"), (3, "same id"), (4, "word " * 20), (5, "ein zwei")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.contamination(odd, benchmark).collect()
    docs = [(r[0], r[1]) for r in ODD]
    expected = contamination_by_hand(docs, [i for i in items if i[0] is not None])
    assert sorted(map(tuple, found), key=str) == expected
    none = decontamination.contamination(odd, benchmark.limit(0)).collect()
    assert len(none) == len(ODD) and not any(r.contaminated for r in none)
    assert decontamination.contamination(empty(spark), benchmark).count() == 0


# 8: n-gram Jaccard join


def joined_by_hand(docs):
    sets = []
    for _, text in docs:
        words = spaced(text)
        sets.append({tuple(words[k: k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set()))
    union = Union()
    for i, a in enumerate(sets):
        union.root(i)
        for j in range(i):
            shared = len(a & sets[j])
            if shared and 100 * shared >= 75 * (len(a) + len(sets[j]) - shared):
                union.join(i, j)
    smallest = {}
    for i, (doc_id, _) in enumerate(docs):
        root = union.root(i)
        smallest[root] = min((x for x in (doc_id, smallest.get(root)) if x is not None), default=None)
    return sorted(((d, len(sets[i]), smallest[union.root(i)]) for i, (d, _) in enumerate(docs)), key=str)


@pytest.mark.parametrize("frequent, paired, block", [(64, 256, 1 << 20), (2, 3, 2000)])
def test_near_duplicates(spark, documents, monkeypatch, frequent, paired, block):
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard, "PAIRED", paired)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    random.seed(8)
    base = " ".join(f"w{random.randrange(500)}" for _ in range(120)).split()
    copies = []
    for k in range(25):
        own = base.copy()
        for _ in range(k % 5):
            own[random.randrange(len(own))] = f"x{random.randrange(99)}"
        copies.append((10_000 + k, " ".join(own)))
    docs = [(r.doc_id, r.text) for r in documents.collect()] + copies
    found = jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted(map(tuple, found), key=str) == joined_by_hand(docs)


def test_near_duplicates_of_odd_rows(spark, odd):
    found = jaccard.near_duplicates(odd).collect()
    assert len(found) == len(ODD)
    component = {r.doc_id: r.component_id for r in found}
    assert component[7] == component[8] == 7 and component[2] == 2 and component[4] == 4
    assert jaccard.near_duplicates(empty(spark)).count() == 0


def test_overlaps():
    random.seed(3)
    sets = [np.unique(np.array([random.randrange(60) for _ in range(30)], np.uint64)) for _ in range(40)]
    found = jaccard.overlaps(sets, rows=7, columns=9)
    assert all(found[i, j] == len(np.intersect1d(a, b)) for i, a in enumerate(sets) for j, b in enumerate(sets) if i != j)


# 9: licenses


def test_base_phrases(spark, documents):
    docs = [(r.doc_id, r.text) for r in documents.collect()] + [r[:2] for r in ODD] + [
        (900, "Apache\nLicense, apache license. CC-BY cc by"), (901, "gnu general public"), (902, "MIT"),
    ]
    found = licenses.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    expected = []
    for doc_id, text in docs:
        words, places, names = alphanumeric(text), [], set()
        for phrase, label in licenses.BASE.items():
            own = phrase.split()
            at = [k for k in range(len(words)) if words[k: k + len(own)] == own]
            places += at
            names |= {label} if at else set()
        expected.append((doc_id, len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(names))))
    assert sorted((tuple(r)[:6] for r in found), key=str) == sorted(expected, key=str)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in found)
    assert all(0 <= r.score <= 1 for r in found)


def test_template_labels(spark):
    texts = [
        "words before. Licensed under CC BY-NC 4.0. words after", "All rights reserved.", "rights of all, reserved",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    ]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    labels = {r.doc_id: r.labels for r in licenses.scan(docs).collect()}
    assert labels == {0: "cc-by,cc-by-nc", 1: "proprietary", 2: "", 3: "mit"}
    assert licenses.scan(empty(spark)).count() == 0


# 10: quality


def test_marginals_against_enumeration():
    random.seed(4)
    bad, change = np.array([random.uniform(-2, 2) for _ in range(7)]), np.array([[0.5, -1.0], [0.3, 0.8]])
    first = np.array([0, 4, 4, 7])
    found, _, _ = quality.marginals(bad, change, first)
    for a, z in ((0, 4), (4, 7)):
        weights = {}
        for code in range(2 ** (z - a)):
            labels = [code >> k & 1 for k in range(z - a)]
            score = sum(bad[a + k] * y for k, y in enumerate(labels))
            weights[tuple(labels)] = np.exp(score + sum(change[x, y] for x, y in zip(labels, labels[1:])))
        for k in range(z - a):
            exact = sum(w for labels, w in weights.items() if labels[k]) / sum(weights.values())
            assert found[a + k] == pytest.approx(exact)


def test_line_features_follow_rows():
    texts = ["a\nb b b\n", None, "", "A!! B!!\na"]
    features, size, first = quality.line_features(pa.array(texts))
    assert first.tolist() == [0, 3, 4, 5, 7] and size.tolist() == [1, 5, 0, 0, 0, 7, 1]
    alone, _, _ = quality.line_features(pa.array(["A!! B!!\na"]))
    assert np.allclose(alone, features[5:], atol=1e-5)


def test_quality_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.fit(docs, labels)
    scored = quality.score(docs.withColumn("held_out", quality.fold() == 0), model, ["doc_id", "held_out"])
    held = scored.filter("held_out").join(labels, "doc_id").collect()
    assert sum(r.predicted == r.quality for r in held) >= 0.93 * len(held)
    assert all(0 <= r.score <= 1 for r in held)


def test_bad_lines_after_many_good_ones(spark, monkeypatch):
    """Documents are learned from as a whole, also those that turn bad late."""
    rng = random.Random(10)
    clean = lambda: " ".join(rng.choice(["the", "cat", "sat", "on", "a", "mat", "today"]) for _ in range(9)) + "."
    junk = lambda: "BUY NOW!!! $$$ http://x.y/%d CLICK 100%% FREE ###" % rng.randrange(10**6)
    rows, labels = [], []
    for k in range(120):
        lines = [clean() for _ in range(300)] + [junk() if k % 2 else clean() for _ in range(100)]
        rows.append((k, "\n".join(lines)))
        labels.append((k, 1 - k % 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    found = {r.doc_id: r.score for r in quality.score(docs, quality.fit(docs, table), ["doc_id"]).collect()}
    assert all((found[k] >= 0.5) == bool(y) for k, y in labels)
    # The sample stays within its lines, in whole documents.
    trained = []
    monkeypatch.setattr(quality, "train", lambda features, size, first, label: trained.append(np.diff(first)))
    monkeypatch.setattr(quality, "SAMPLE_LINES", 1000)
    quality.fit(docs, table)
    assert trained[0].tolist() == [400, 400]


def test_quality_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1), (6, 0), (5, None), (None, 0), (7, 1), (6, 0), (8, 1)], "doc_id long, quality int")
    model = quality.fit(odd, labels)
    rows = quality.score(odd.drop("score"), model, ["doc_id", "class"]).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    nothing = quality.fit(odd, labels.limit(0))
    assert {r.score for r in quality.score(odd, nothing, ["doc_id"]).collect()} == {0.5}
    assert quality.score(empty(spark), model, ["doc_id"]).count() == 0
