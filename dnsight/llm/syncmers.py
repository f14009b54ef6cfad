"""Document fingerprints from closed syncmers, in built-in column functions only.

The alphabet is a text's units: runs of up to 16 non-space characters, and each single character of
longer runs (scripts without spaces, encoded data). A k-mer of units is an anchor if the smallest of its inner s-mers stands at its first or last place. Whether a k-mer is an anchor
depends on nothing outside of it, so texts that share a passage share the anchors inside it, whatever
surrounds the passage, at positions that differ by one constant. The fingerprint is the sorted list
of the anchor hashes in the lowest sixteenth of their range, of SKETCH hashes at least, so it grows with the
text; and a hash of the whole text, so different texts have different fingerprints.

Defined cases: null text counts as empty; an empty text has no anchor, an empty fingerprint and
likeness 1 to another empty one, else 0; a text of fewer than k units, or without a k-mer that is an
anchor, has one anchor, its whole sequence of units. Other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A whole run, or a character of a longer one: never a piece whose place counts from the start of its run.
UNIT = r"((?<!\S)\S{1,16}(?!\S)|\S)"
#: Units per k-mer; an inner s-mer has two units.
K = 5
#: Anchor hashes (of 32 bits) kept in a fingerprint: all below BELOW, and SKETCH if there are so many.
SKETCH, BELOW = 64, 1 << 28

_LOWEST = -(2**63)


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def anchors(text: Column) -> Column:
    """Closed syncmers of a text: array<struct<position int, hash bigint>>, by position."""
    units = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(UNIT), F.lit(1))
    hashes = F.transform(units, lambda unit: F.xxhash64(unit))

    def chosen(unit: Column) -> Column:
        count = F.size(unit)
        inner = F.zip_with(
            F.slice(unit, 1, count - 1), F.slice(unit, 2, count - 1), lambda a, b: F.xxhash64(a, b)
        )
        places = _let(
            inner,
            lambda s: F.filter(
                F.sequence(F.lit(0), count - K),
                lambda i: F.least(F.get(s, i), F.get(s, i + K - 2))
                <= F.least(*[F.get(s, i + j) for j in range(1, K - 2)]),
            ),
        )
        found = F.transform(
            places,
            lambda i: F.struct(
                i.alias("position"),
                F.xxhash64(*[F.get(unit, i + j) for j in range(K)]).alias("hash"),
            ),
        )
        return _let(found, lambda a: F.when(F.size(a) == 0, short(unit)).otherwise(a))

    def short(unit: Column) -> Column:
        return F.array(F.struct(F.lit(0).alias("position"), F.xxhash64(unit).alias("hash")))

    none = F.expr("cast(array() as array<struct<position:int,hash:bigint>>)")
    return _let(
        hashes,
        lambda unit: F.when(F.size(unit) == 0, none)
        .when(F.size(unit) < K, short(unit))
        .otherwise(F.when(F.size(unit) >= K, chosen(unit))),
    )


def sketch(anchor: Column) -> Column:
    """The distinct anchor hashes (32 bits each) that a fingerprint keeps, ascending."""
    hashes = F.transform(anchor, lambda a: F.shiftrightunsigned(a["hash"], 32))
    return _let(
        F.array_sort(F.array_distinct(hashes)),
        lambda h: F.slice(h, F.lit(1), F.greatest(F.lit(SKETCH), F.size(F.filter(h, lambda x: x < BELOW)))),
    )


def fingerprint(sketched: Column, text: Column) -> Column:
    """A sketch as text: eight hexadecimal digits for each hash, then sixteen of the whole text's."""
    digits = F.transform(sketched, lambda h: F.lpad(F.lower(F.hex(h)), 8, "0"))
    whole = F.lpad(F.lower(F.hex(F.xxhash64(text))), 16, "0")
    return F.when(F.length(text) == 0, "").otherwise(F.concat(F.array_join(digits, ""), whole))


def likeness(left: Column, right: Column) -> Column:
    """Jaccard likeness of two anchor sets, from their sketches; exact for sets smaller than SKETCH.

    A sketch holds all anchors up to its largest one, so both are compared up to the smaller of these.
    """
    known = lambda s: F.when(F.size(s) < SKETCH, F.lit(2**62)).otherwise(F.get(s, F.size(s) - 1))
    upto = lambda s, end: F.filter(s, lambda h: h <= end)
    return F.when((F.size(left) == 0) & (F.size(right) == 0), 1.0).otherwise(
        _let(
            F.least(known(left), known(right)),
            lambda end: F.size(F.array_intersect(upto(left, end), upto(right, end)))
            / F.greatest(F.size(F.array_union(upto(left, end), upto(right, end))), F.lit(1)),
        )
    )


def matches(left: DataFrame, right: DataFrame) -> DataFrame:
    """Passages that two sets of documents share: anchors per pair of documents and shift.

    Takes (doc_id, text) tables; returns left_id, right_id, shift (right minus left position),
    n_anchors, first_position (in the left text). Anchors are joined by hash.
    """
    sides = [
        docs.select("doc_id", F.explode(anchors(F.col("text"))).alias("a")).select(
            F.col("doc_id").alias(f"{side}_id"), F.col("a.position").alias(f"{side}_position"),
            F.col("a.hash").alias("hash"),
        )
        for side, docs in (("left", left), ("right", right))
    ]
    shift = (F.col("right_position") - F.col("left_position")).alias("shift")
    return (
        sides[0].join(sides[1], "hash").groupBy("left_id", "right_id", shift)
        .agg(F.count("*").alias("n_anchors"), F.min("left_position").alias("first_position"))
    )


def with_next_text(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """doc_id, text and next_text: the text of the next document by ascending id, cyclically.

    Ids are cut into ranges at ids that occur (quantiles, as many as `buckets`); the documents that
    begin a range are also sent to the range before, so one shuffle gives every row its neighbour and
    no window spans the table. Null ids come first; rows with one id are ordered by text.
    """
    spark = docs.sparkSession
    buckets = buckets or 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("place", F.coalesce("doc_id", F.lit(_LOWEST)))
    cuts = rows.agg(
        F.min("place").alias("lowest"),
        F.percentile_approx("place", [i / buckets for i in range(1, buckets)] or [0.5]).alias("cuts"),
    ).first()
    first = _LOWEST if cuts["lowest"] is None else cuts["lowest"]
    borders = sorted({first, *(cuts["cuts"] or [])})
    border = F.expr(f"array({','.join('-9223372036854775807-1' if b == _LOWEST else f'{b}L' for b in borders)})")
    own = F.size(F.filter(border, lambda b: b <= F.col("place"))) - 1
    before = F.pmod(F.col("own") + len(borders) - 1, F.lit(len(borders)))
    spread = (
        rows.withColumn("own", own)
        .withColumn(
            "slots",
            F.when(
                F.array_contains(border, F.col("place")),
                F.array(
                    F.struct(F.col("own").alias("slot"), F.lit(False).alias("copy")),
                    F.struct(before.alias("slot"), F.lit(True).alias("copy")),
                ),
            ).otherwise(F.array(F.struct(F.col("own").alias("slot"), F.lit(False).alias("copy")))),
        )
        .select("doc_id", "text", "place", F.explode("slots").alias("s"))
        .select("doc_id", "text", "place", "s.slot", "s.copy")
    )
    order = Window.partitionBy("slot").orderBy("copy", "place", "text")
    return (
        spread.withColumn("next_text", F.lead("text").over(order))
        .filter(~F.col("copy"))
        .select("doc_id", "text", "next_text")
    )


def compare_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likeness.

    The edited text has the second half (the last floor(n/2) code points) replaced by the first as
    many of the next document.
    """
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = with_next_text(docs).withColumn("n_chars", F.char_length("text").cast("long"))
    rows = rows.withColumn(
        "edited",
        F.concat(
            F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")),
            F.substring("next_text", F.lit(1), half),
        ),
    )
    rows = rows.select(
        "doc_id", "n_chars", "text", "edited", F.sha2("edited", 256).alias("edited_sha256"),
        sketch(anchors(F.col("text"))).alias("own"),
        sketch(anchors(F.col("edited"))).alias("changed"),
        sketch(anchors(F.col("next_text"))).alias("following"),
    )
    return rows.select(
        "doc_id", "n_chars", "edited_sha256",
        fingerprint(F.col("own"), F.col("text")).alias("fingerprint"),
        fingerprint(F.col("changed"), F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"),
    )
