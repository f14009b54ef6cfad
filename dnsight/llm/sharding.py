"""Placement of rows on shards by a permutation-filled lookup table, in built-in functions only.

Each shard has a preference order over the slots of a table of prime size: a start and a step from its
name's hash. Shards take turns; each claims its next free slot. A row's slot is its key's hash modulo
the size, so placement is one lookup in a table of fixed size, which is broadcast. Shards own equal
numbers of slots (they differ by one at most), and losing a shard moves few rows besides its own.

Defined cases: rows of equal keys share a slot and so a shard, repeated rows are kept each; a null key part is
a value of its own; the text plays no part, so it may be null, empty or very long; no rows, no rows placed,
and no folders; of two shards that want a slot the one listed first is served first.
"""

from __future__ import annotations

from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Slots of the table: a prime well above 100 times the number of shards.
SLOTS = 65537


def _number(text: str) -> int:
    return int(md5(text.encode()).hexdigest()[:12], 16)


def fill(shards: list[str], slots: int = SLOTS) -> list[int]:
    """Index of the owning shard for each slot; `slots` must be prime and no less than the shards."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need distinct names")
    if slots < len(shards) or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be a prime, and enough for the shards")
    place = [_number(f"start {name}") % slots for name in shards]
    step = [_number(f"step {name}") % (slots - 1) + 1 for name in shards]
    owner, claimed = [-1] * slots, 0
    while claimed < slots:
        for shard in range(len(shards)):
            while owner[place[shard]] >= 0:
                place[shard] = (place[shard] + step[shard]) % slots
            owner[place[shard]] = shard
            claimed += 1
            if claimed == slots:
                break
    return owner


def lookup_table(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """The filled table: slot int, shard string. Its size is fixed by `slots`."""
    owners = F.split(F.lit(" ".join(map(str, fill(shards, slots)))), " ")
    names = F.split(F.lit("\n".join(shards)), "\n")
    return spark.range(1, numPartitions=1).select(F.posexplode(owners).alias("slot", "owner")).select(
        "slot", F.get(names, F.col("owner").cast("int")).alias("shard")
    )


def slot_of(keys: list[Column], slots: int = SLOTS) -> Column:
    """Slot of a key: 48 bits of the MD5 of its parts, modulo the number of slots.

    A null part counts as one value of its own. Give more parts to spread a key that holds many rows.
    """
    parts = [F.coalesce(F.concat(F.lit("="), k.cast("string")), F.lit("-")) for k in keys]
    digest = F.md5(F.concat_ws("\x1f", *parts).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") % slots).cast("int")


def place(
    rows: DataFrame, keys: list[str], shards: list[str], slots: int = SLOTS, name: str = "shard"
) -> DataFrame:
    """All rows and columns with `slot` and the shard in a column `name`; columns so named are replaced.

    Every row is kept, also repeated ones and those with null keys (all of which share one slot).
    """
    table = lookup_table(rows.sparkSession, shards, slots).select(
        F.col("slot").alias("__slot"), F.col("shard").alias("__shard")
    )
    kept = rows.drop(*{"slot", name} - set(keys)).withColumn(
        "__slot", slot_of([F.col(k) for k in keys], slots)
    )
    return (
        kept.join(F.broadcast(table), "__slot", "left")
        .withColumn("slot", F.col("__slot")).withColumn(name, F.col("__shard"))
        .drop("__slot", "__shard")
    )


def read_shards(placed: DataFrame, path: str) -> DataFrame:
    """The rows that `write_shards` wrote, with the shard of the folder they lie in."""
    return placed.sparkSession.read.schema(placed.schema).parquet(path).select(*placed.columns)


def write_shards(placed: DataFrame, path: str, splits: int = 8) -> None:
    """Write one folder per shard, each by up to `splits` tasks, so no task holds a whole shard."""
    salt = F.pmod(F.xxhash64(*placed.columns), F.lit(splits)) if placed.columns else F.lit(0)
    (
        placed.withColumn("__salt", salt).repartition("shard", "__salt").drop("__salt")
        .write.partitionBy("shard").parquet(path)
    )
