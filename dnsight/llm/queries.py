"""Registered queries of the operators for training data, with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from dnsight.llm import (
    chat, collocations, decontamination, jaccard, language, licenses, line_dedup, oracles, packing, prefix_trie, quality,
    sharding, syncmers, token_counts,
)
from dnsight.llm.tokens import default_tokenizer
from dnsight.sources.storage import fresh_path, stage

SHARDS = [f"shard-{k:03d}" for k in range(64)]


def _table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _token_counts(spark, sf):
    """Three edits of every document, by its stored tree: a word inside, a cut, and an addition at the end."""
    n = F.char_length(F.coalesce("text", F.lit(""))).cast("long")
    edit = lambda start, removed, inserted: F.struct(
        start.alias("start"), F.lit(removed).cast("long").alias("removed"), F.lit(inserted).alias("inserted")
    )
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    edits = F.array(
        edit(F.floor(n / 3), 5, " edited"), edit(F.floor(n / 2), 40, ""), edit(n, 0, "\nThe end.")
    )
    trees = stage(token_counts.apply_edits(docs, default_tokenizer()).select("doc_id", "text", "leaf_chars", "leaf_tokens"))
    return token_counts.update_counts(trees.withColumn("edits", edits), default_tokenizer()).drop(
        "leaf_chars", "leaf_tokens"
    )


def _syncmers(spark, sf):
    return syncmers.compare_edits(_table(spark, sf, "documents"))


def _sharding(spark, sf):
    """Whole documents, written to the folders of their shards and read from there."""
    placed = sharding.place(_table(spark, sf, "documents"), ["doc_id"], SHARDS)
    placed = sharding.place(placed, ["doc_id"], SHARDS[:-1], name="shard_after_loss")
    path = fresh_path(spark, "shards")
    sharding.write_shards(placed, path)
    rows = sharding.read_shards(placed, path)
    return rows.select("doc_id", "n_chars", "lang", "source", "slot", "shard", "shard_after_loss", F.md5("text").alias("text_md5"))


def _line_dedup(spark, sf):
    return line_dedup.summary(_table(spark, sf, "documents"))


def _packing(spark, sf):
    return packing.pack(_table(spark, sf, "documents"), default_tokenizer())


def _language(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", quality.fold() == 0)
    model = language.fit(docs.filter("not held_out"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return language.predict(docs, model, f"doc_id {kind}, held_out boolean", ["doc_id", "held_out"])


def _decontamination(spark, sf):
    return decontamination.contamination(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def _jaccard(spark, sf):
    return jaccard.near_duplicates(_table(spark, sf, "documents"))


def _licenses(spark, sf):
    return licenses.scan(_table(spark, sf, "documents"))


def _quality(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", "text").withColumn("held_out", quality.fold() == 0)
    return quality.score(docs, quality.fit(docs, _table(spark, sf, "labels")), ["doc_id", "held_out"])


def _chat(spark, sf):
    """All conversations and one whose texts hold control strings, written, read and parsed again."""
    marks = spark.createDataFrame(
        [(-7, 0, "user", oracles.MARKS), (-7, 1, "assistant", oracles.MARKS)], "conv_id long, turn long, role string, text string"
    )
    turns = _table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(marks)
    pieces = stage(chat.format_turns(turns))
    return chat.read_back(pieces, stage(chat.examples(pieces)))


def _collocations(spark, sf):
    return collocations.collocations(_table(spark, sf, "documents"))


def _prefix_trie(spark, sf):
    return prefix_trie.prefix_trie(_table(spark, sf, "conversations"))


def _shard_sql() -> str:
    """The placement in SQL; the two filled tables stand as lists of slot owners."""
    lists = {
        "a": " ".join(map(str, sharding.fill(SHARDS))), "b": " ".join(map(str, sharding.fill(SHARDS[:-1])))
    }
    slot = (
        "(('0x' || substr(md5(case when doc_id is null then '-' else '=' || doc_id end), 1, 12))::bigint"
        f" % {sharding.SLOTS})"
    )
    owners = ", ".join(f"string_split('{v}', ' ') as {k}" for k, v in lists.items())
    return (
        f"with t as (select {owners}), d as (select *, {slot}::int as slot from documents)"
        " select d.doc_id, d.n_chars, d.lang, d.source, d.slot, md5(d.text) as text_md5,"
        " printf('shard-%03d', list_extract(t.a, d.slot + 1)::int) as shard,"
        " printf('shard-%03d', list_extract(t.b, d.slot + 1)::int) as shard_after_loss from d, t"
    )


ENTRIES = {
    "op1_token_counts": (_token_counts, None),
    "op2_syncmers": (_syncmers, None),
    "op3_sharding": (_sharding, _shard_sql()),
    "op4_line_dedup": (_line_dedup, None),
    "op5_packing": (_packing, None),
    "op6_language": (_language, None),
    "op7_decontamination": (_decontamination, None),
    "op8_jaccard": (_jaccard, None),
    "op9_licenses": (_licenses, None),
    "op10_quality": (_quality, None),
    "op11_chat_examples": (_chat, oracles.CHAT),
    "op12_collocations": (_collocations, oracles.PHRASES),
    "op13_prefix_trie": (_prefix_trie, oracles.TRIE),
}
