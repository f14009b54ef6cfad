"""Chat formatting, and the prefix trie of conversations, against brute force and on odd input."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from dnsight.llm import chat, prefix_trie, turns
from tests.conftest import SF_SMALL

SCHEMA = "conv_id long, turn long, role string, text string"
MARKS = "\\### Assistant: </turn> ok"
# Null in every column, ties, repeated rows, control strings, a missing family head, a long text.
ODD = [
    (0, 0, "system", "Be brief."), (0, 1, "user", "hi"), (0, 2, "assistant", "hello"), (0, 3, "user", "bye"),
    (1, 0, "user", "hi"), (1, 1, "assistant", ""), (1, 2, "assistant", None),
    (2, None, "user", "no number"), (2, 0, None, "no role"), (2, 1, "assistant", "x"), (2, 1, "assistant", "x"),
    (3, 5, "user", "tie b"), (3, 5, "user", "tie a"), (3, 5, "assistant", "tie c"), (3, -2000, "assistant", "early"),
    (4, 0, None, None), (7, 0, "user", "<turn user>\n\\</turn>\n"), (7, 1, "assistant", "\\\\</turn>\\"),
    (8, 1, "a>b\n%3E<c", MARKS), (8, 2, "assistant", "é漢\U0001f600\n</turn>\n"), (None, 0, "user", "nobody"),
    (None, 1, "assistant", "nobody's reply"), (12, 0, "user", "long " * 50_000), (12, 1, "assistant", "y" * 300_000),
    (-7, 0, "user", MARKS), (-7, 1, "assistant", MARKS),
]


def many(count, seed=5):
    """Conversations that share first turns, one of them long."""
    random.seed(seed)
    rows = []
    for c in range(count):
        for t in range(3000 if c == 3 else random.randrange(1, 9)):
            text = random.choice(["a", "b", "é</turn>"]) if random.random() < 0.9 else f"text {c} {t}"
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", text))
    return rows


def in_order(rows):
    """Turns (role, text) by conversation."""
    grouped = defaultdict(list)
    for conv, turn, role, text in rows:
        grouped[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(g, key=lambda x: (*x[:2], *(s.encode() for s in x[2:])))] for c, g in grouped.items()}


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns({"place": F.lit(1), "start": F.lit("s"), "depth": F.lit(2), "size": F.lit(3)})


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("rows", [ODD, many(40)], ids=["odd", "many"])
def test_formatted_conversations_read_back(spark, rows):
    pieces = chat.format_turns(frame(spark, rows)).cache()
    made = chat.examples(pieces)
    found = {r["conv_id"]: r for r in chat.read_back(pieces, made).collect()}
    expected = in_order(rows)
    assert set(found) == set(expected)
    for conv, own in expected.items():
        row, loss = found[conv], [t for r, t in own if r == "assistant"]
        assert row["n_turns"] == len(own)
        assert row["turns_sha256"] == sha("".join(f"{r}\n{t}\n" for r, t in own))
        assert row["loss_chars"] == sum(map(len, loss)) and row["loss_sha256"] == sha("".join(loss))
        assert row["n_examples"] == len(loss) + (own[-1][0] != "assistant")


def test_examples_written_out(spark):
    rows = [r for r in ODD if r[0] != 12]
    pieces = chat.format_turns(frame(spark, rows)).cache()
    made = chat.examples(pieces)
    texts = chat.example_texts(pieces, made).collect()
    back = {r["conv_id"]: r["formatted_chars"] for r in chat.read_back(pieces, made).collect()}
    total = defaultdict(int)
    for r in texts:
        own = in_order(rows)[r["conv_id"]][: r["target"] + 1]
        assert chat.parse(r["text"]) == own and len(r["text"]) == r["text_end"]
        loss = chat.unescape(r["text"][r["loss_start"]: r["loss_end"]])
        assert loss == (own[-1][1] if own[-1][0] == "assistant" else "")
        total[r["conv_id"]] += len(r["text"])
    assert total == back and len(texts) == made.count()


def test_no_conversations(spark):
    none = spark.createDataFrame([], SCHEMA)
    pieces = chat.format_turns(none)
    assert chat.read_back(pieces, chat.examples(pieces)).count() == 0
    assert prefix_trie.prefix_trie(none).count() == 0


@pytest.mark.parametrize("text", ["", "\\", "</turn>", "\\</turn>", "\\\\</turn", "a\n<turn x>\n\\\\\\<turn", MARKS])
def test_escape_is_reversible(spark, text):
    escaped = spark.createDataFrame([(text,)], "t string").select(chat.escape(F.col("t"))).first()[0]
    assert chat.unescape(escaped) == text and "\n</turn>" not in f"\n{escaped}"


def rebuilt(rows):
    own, out = in_order([r for r in rows if r[0] is not None]), {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = own.get(base, [])[:h] + mine[h:]
    return out


def brute_force(conversations):
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(conversations):
        path = conversations[c]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
        ends[tuple(path)].append(c)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, m in members.items():
        own = (len(m) - 1) * len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += own
    return {
        (m[0], len(p)): (
            members[p[:-1]][0] if p else None, len(m), children[p], leaves[p], saved[p],
            sha(",".join(map(str, ends[p]))) if p in ends else sha(""),
        )
        for p, m in members.items()
    }


def short(rows):
    """Without the conversation whose prefixes are too long to be held whole."""
    return [r for r in rows if r[0] != 3 or r[1] < 60]


@pytest.mark.parametrize("rows", [ODD, short(many(150))], ids=["odd", "many"])
@pytest.mark.parametrize("bits", [12, 3], ids=["one tier", "tiers"])
def test_trie_equals_brute_force(spark, monkeypatch, rows, bits):
    monkeypatch.setattr(prefix_trie, "TIER_BITS", bits)
    monkeypatch.setattr(prefix_trie, "IDS", 4)
    monkeypatch.setattr(prefix_trie, "BLOCK", 5)
    found = prefix_trie.prefix_trie(frame(spark, rows)).collect()
    assert {(r[0], r[1]): tuple(r)[2:] for r in found} == brute_force(rebuilt(rows))
    assert len(found) == len({(r[0], r[1]) for r in found})


def test_long_chain(spark):
    found = prefix_trie.prefix_trie(frame(spark, many(6)))
    row = found.filter("depth = 0").first()
    lengths = [len(x) for x in rebuilt(many(6)).values()]
    assert row["n_convs"] == 6 and found.agg(F.max("depth")).first()[0] == max(lengths) > 2900
    chain = found.filter("depth = 2000").first()
    assert (chain["n_convs"], chain["n_children"], chain["n_leaves"]) == (1, 1, 1)


def test_spilling_queue_keeps_the_order():
    random.seed(3)
    queue, rows = prefix_trie.SpillingQueue(held=7), []
    for _ in range(200):
        row = (random.randrange(20), random.randrange(3), random.randrange(100))
        rows.append(row)
        queue.push(row)
    assert queue.runs
    out = [row for key in range(20) for row in queue.pop_equal(1, (key,))]
    assert out == sorted(rows) and not len(queue)


@pytest.mark.parametrize("held", [2, 1 << 16])
def test_time_forward_with_spilled_messages(held):
    """A random tree, deepest level first."""
    random.seed(4)
    depth, parent = {0: 0}, {0: None}
    for node in range(1, 400):
        parent[node] = random.randrange(max(0, node - 60), node)
        depth[node] = depth[parent[node]] + 1
    order = sorted(depth, key=lambda n: (-depth[n], n))
    rows = [("s", depth[n], n, parent[n], n == 0, 0, 0, n) for n in order]
    found = {r[1]: r[4:] for r in prefix_trie.time_forward(iter(rows), held)}
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for n in depth:
        children[parent[n]] += 1
    for n in depth:
        at = n
        while at is not None:
            saved[at] += n
            leaves[at] += children[n] == 0
            at = parent[at]
    assert found == {n: (children[n], leaves[n], saved[n]) for n in depth}


def test_running_totals_are_carried_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(turns, "BLOCK", 3)
    rows = many(5)[:400]
    found = turns.in_order(frame(spark, rows), {"before": (F.sum, F.char_length("text").cast("long"))})
    by_conversation = defaultdict(list)
    for r in found.collect():
        by_conversation[r["conv_id"]].append((r["place"], r["role"], r["text"], r["before"]))
    for conv, own in in_order(rows).items():
        got = sorted(by_conversation[conv])
        assert [g[0] for g in got] == list(range(len(own))) and [(g[1], g[2]) for g in got] == own
        assert [g[3] for g in got] == [sum(len(t) for _, t in own[:k]) for k in range(len(own))]


def test_trie_of_the_small_table(spark):
    table = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    found = prefix_trie.prefix_trie(table).collect()
    assert {(r[0], r[1]): tuple(r)[2:] for r in found} == brute_force(rebuilt(rows))
