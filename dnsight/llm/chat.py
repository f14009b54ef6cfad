"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, and only its reply
is trainable. The texts of a conversation's examples are prefixes of one formatted text, so that text is
kept once, a piece per turn, and an example is where its context ends and which characters are under
its loss mask. This holds every example whole and grows with the turns; written out, the examples of a
conversation would grow with the square of its turns. `example_texts` writes out those that are asked for.

A turn is formatted as `<turn ROLE>`, line break, text, line break, `</turn>`, line break. In texts,
control strings (`<turn`, `</turn`) get a backslash, and the backslashes before them are doubled; in
roles, `%`, `<`, `>` and line breaks are written as `%` and two hexadecimal digits. Both are reversible.

Defined cases: as in `turns`; only the role `assistant` is trainable; what follows the last reply, or a
conversation without one, is an example with nothing under its mask; an empty reply is an example whose
mask is empty; repeated rows are turns each; other columns are ignored; no conversations, no rows.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dnsight.llm.turns import in_order

TRAINABLE = "assistant"
ROLE_CODES = {"%": "%25", "<": "%3C", ">": "%3E", "\n": "%0A"}
TAIL = "\n</turn>\n"
CONTROL = r"(\\*)(</?turn)"
#: What read_back returns besides conv_id; formatted_chars counts all examples, stored_chars the pieces.
DIGEST = (
    "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long,"
    " n_examples long, stored_chars long"
)
_TURN = re.compile(r"<turn ([^>]*)>\n(.*?)\n</turn>\n", re.DOTALL)
_ESCAPED = re.compile(r"(\\+)(</?turn)")


def _head(role: Column) -> Column:
    for plain, code in ROLE_CODES.items():
        role = F.replace(role, F.lit(plain), F.lit(code))
    return F.concat(F.lit("<turn "), role, F.lit(">\n"))


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1$1\\$2")


def unescape(text: str) -> str:
    """The text that `escape` was given."""
    return _ESCAPED.sub(lambda m: m[1][: len(m[1]) // 2] + m[2], text)


def parse(formatted: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a formatted text."""
    turns, end = [], 0
    for found in _TURN.finditer(formatted):
        if found.start() != end:
            break
        role = re.sub("%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), found[1])
        turns.append((role, unescape(found[2])))
        end = found.end()
    if end != len(formatted):
        raise ValueError("not a formatted text")
    return turns


def format_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place, start, piece, loss_start, loss_end: the formatted text of each conversation in pieces.

    Positions are characters of the conversation's formatted text; the last two are null where nothing is trainable.
    """
    rows = conversations.select(
        "conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    )
    size = F.char_length(_head(F.col("role"))) + F.char_length(escape(F.col("text"))) + len(TAIL)
    placed = in_order(rows, {"start": (F.sum, size.cast("long"))})
    body = placed.withColumn("head", _head(F.col("role"))).withColumn("body", escape(F.col("text")))
    loss = F.when(F.col("role") == TRAINABLE, F.col("start") + F.char_length("head"))
    return body.select(
        "conv_id", "place", "start", F.concat("head", "body", F.lit(TAIL)).alias("piece"),
        loss.alias("loss_start"), (loss + F.char_length("body")).alias("loss_end"),
    )


def examples(pieces: DataFrame) -> DataFrame:
    """conv_id, target (place of its last turn), text_end, loss_start, loss_end of every example.

    An example's text is its conversation's formatted text up to `text_end`.
    """
    end = F.col("start") + F.char_length("piece")
    replies = pieces.filter("loss_start is not null").select(
        "conv_id", F.col("place").alias("target"), end.alias("text_end"), "loss_start", "loss_end"
    )
    last = F.max(F.struct("place", end.alias("end"), "loss_start")).alias("last")
    rests = pieces.groupBy("conv_id").agg(last).filter("last.loss_start is null").select(
        "conv_id", F.col("last.place").alias("target"), F.col("last.end").alias("text_end"),
        F.col("last.end").alias("loss_start"), F.col("last.end").alias("loss_end"),
    )
    return replies.unionByName(rests)


def example_texts(pieces: DataFrame, wanted: DataFrame) -> DataFrame:
    """The wanted examples with `text`, whole; it grows with their number times their length."""
    before = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    texts = pieces.select("conv_id", "place", F.array_join(F.collect_list("piece").over(before), "").alias("text"))
    named = texts.toDF("__conv", "__place", "text")
    return wanted.join(
        named, F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("target") == F.col("__place"))
    ).select(*wanted.columns, "text")


def read_back(pieces: DataFrame, made: DataFrame) -> DataFrame:
    """What the formatted text and the examples of each conversation hold, parsed from them.

    A conversation's turns are digested one after the other in one task, which holds one turn at a time.
    """
    spans = made.toDF("__conv", *[f"__{c}" for c in made.columns[1:]])
    rows = pieces.join(
        spans, F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("place") == F.col("__target")), "left"
    ).select(
        "conv_id", "place", "piece", "start", F.col("__text_end").alias("text_end"),
        (F.col("__loss_start") - F.col("start")).alias("loss_start"), (F.col("__loss_end") - F.col("start")).alias("loss_end"),
    )
    kind = pieces.schema["conv_id"].dataType.simpleString()

    def digest(batches):
        names = [c.split()[0] for c in DIGEST.split(", ")]
        conversation, state, done = None, None, []

        def typed(done, key_type):
            columns = [pa.array(c, None if k else key_type) for k, c in enumerate(zip(*done))]
            return pa.RecordBatch.from_arrays(columns, ["conv_id", *names])

        def finished():
            key, turns, whole, loss, chars, total, made, stored = state
            return (key, turns, whole.hexdigest(), chars, loss.hexdigest(), total, made, stored)

        for batch in batches:
            key_type = batch.schema.field("conv_id").type
            for row in batch.to_pylist():
                if state is None or row["conv_id"] != conversation:
                    if state is not None:
                        done.append(finished())
                    conversation = row["conv_id"]
                    state = [conversation, 0, hashlib.sha256(), hashlib.sha256(), 0, 0, 0, 0]
                for role, text in parse(row["piece"]):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                if row["text_end"] is not None:
                    masked = unescape(row["piece"][row["loss_start"]: row["loss_end"]])
                    state[3].update(masked.encode())
                    state[4] += len(masked)
                    state[5] += row["text_end"]
                    state[6] += 1
                state[7] += len(row["piece"])
            if done:
                yield typed(done, key_type)
                done = []
        if state is not None:
            yield typed([finished()], key_type)

    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(
        digest, f"conv_id {kind}, {DIGEST}"
    )

