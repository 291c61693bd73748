"""Tables kept with digests of their keys, so two tables are compared without moving what they share.

A key's leaf is the first ``BITS`` bits of its hash. Per leaf a digest holds the number of rows, the xor of
one hash and the sum of another: repeated keys cancel in the xor and not in the sum. Digests of loads add
up, and those of all leaves of a part (the first ``PART_BITS`` bits) to that of the part, so a tree has at
most ``2 ** BITS + 1`` leaves however large its table is. Tables whose digests agree at a leaf hold the
same keys there, but for a chance of about 2 ** -128 a leaf; only the other leaves are read.

Rows are stored in a folder per part, sorted by leaf, so a scan leaves out folders and, by the leaf's
minimum and maximum, pieces of files. A load is its digests: they are written after its
rows, and readers take rows of loads with digests only, so a load that was killed half way is not seen.
Keys that hold a null have a leaf of their own, which always counts as changed. Both tables must have keys
of the same types, since an int and a long of one value hash apart.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeloom.operators.lookup import unknown

BITS, PART_BITS = 16, 5
RANGES = 64  # ranges of leaves a scan is given; leaves between two close ones are read and dropped
SPREAD = 32  # tasks that may share one leaf when it is written
NO_KEY = -1
LEAF, PART, LOAD = "_leaf", "_part", "_load"
DIGEST = f"{LEAF} int, n bigint, x bigint, s decimal(38,0)"


def leaf_of(key: list[str]) -> Column:
    """The leaf of a key, ``NO_KEY`` where a part of it is null."""
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    return F.when(whole, F.shiftrightunsigned(F.xxhash64(*key), 64 - BITS).cast("int")).otherwise(F.lit(NO_KEY))


def part_of(leaf: Column) -> Column:
    return F.shiftright(leaf, BITS - PART_BITS)


def digests(df: DataFrame, key: list[str]) -> DataFrame:
    """One row per leaf in use: ``_leaf, n, x, s``. Partial aggregates make it one row per leaf and task."""
    second = F.xxhash64(F.lit("second"), *key).cast("decimal(38,0)")
    return df.groupBy(leaf_of(key).alias(LEAF)).agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64(*key)).alias("x"), F.sum(second).alias("s")
    )


def roll_up(digest: DataFrame, bits: int = BITS) -> DataFrame:
    """Digests of several loads added up, at the leaves or at any node of ``bits`` bits above them."""
    node = F.shiftright(LEAF, BITS - bits).alias(LEAF)
    return digest.groupBy(node).agg(F.sum("n").alias("n"), F.bit_xor("x").alias("x"), F.sum("s").alias("s"))


def changed(a: DataFrame, b: DataFrame) -> list[int]:
    """Leaves at which two digests differ, and the leaf of null keys if either has one: at most ``2 ** BITS + 1`` numbers."""
    stacked = a.withColumn("side", F.lit(1)).unionByName(b.withColumn("side", F.lit(-1)))
    both = stacked.groupBy(LEAF).agg(
        F.sum(F.col("n") * F.col("side")).alias("n"), F.bit_xor("x").alias("x"), F.sum(F.col("s") * F.col("side")).alias("s")
    )
    differ = both.filter((F.col("n") != 0) | (F.col("x") != 0) | (F.col("s") != 0) | (F.col(LEAF) == NO_KEY))
    return sorted(r[0] for r in differ.select(LEAF).collect())


def append(df: DataFrame, folder: str, key: list[str], load: int) -> None:
    """Write one load and then its digests; the same load again replaces itself.

    Rows are range-sorted by leaf. A leaf of one frequent key is dealt over up to ``SPREAD`` tasks.
    """
    placed = df.withColumn(LEAF, leaf_of(key)).withColumn(PART, part_of(F.col(LEAF)))
    placed = placed.withColumn("_spread", F.monotonically_increasing_id() % SPREAD)
    ranged = placed.repartitionByRange(LEAF, "_spread").sortWithinPartitions(LEAF).drop("_spread")
    ranged.write.mode("overwrite").partitionBy(PART).parquet(f"{folder}/rows/{LOAD}={load}")
    spark = df.sparkSession
    written = spark.read.schema(ranged.schema).parquet(f"{folder}/rows/{LOAD}={load}")
    digests(written, key).coalesce(1).write.mode("overwrite").parquet(f"{folder}/digests/{LOAD}={load}")


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """The table's digests over all of its loads."""
    return roll_up(spark.read.schema(f"{DIGEST}, {LOAD} bigint").parquet(f"{folder}/digests").select(LEAF, "n", "x", "s"))


def ranges(leaves: list[int], most: int = RANGES) -> list[tuple[int, int]]:
    """At most ``most`` ranges that cover the sorted leaves, split at the widest gaps."""
    if not leaves:
        return []
    gaps = sorted(range(1, len(leaves)), key=lambda i: leaves[i - 1] - leaves[i])[: most - 1]
    cuts = [0, *sorted(i for i in gaps if leaves[i] - leaves[i - 1] > 1), len(leaves)]
    return [(leaves[a], leaves[b - 1]) for a, b in zip(cuts, cuts[1:])]


def read_rows(spark: SparkSession, folder: str, schema: str, leaves: list[int] | None = None) -> DataFrame:
    """Rows of complete loads with their leaf; of the given leaves only, if they are given, which choose the
    folders and ranges to scan."""
    loads = spark.read.schema(f"{DIGEST}, {LOAD} bigint").parquet(f"{folder}/digests").select(LOAD).distinct()
    rows = spark.read.schema(f"{schema}, {LEAF} int, {LOAD} bigint, {PART} int").parquet(f"{folder}/rows")
    if leaves is not None:
        near = reduce(lambda a, b: a | b, [F.col(LEAF).between(*r) for r in ranges(leaves)], F.lit(False))
        parts = sorted({leaf >> (BITS - PART_BITS) for leaf in leaves})
        wanted = spark.createDataFrame([(leaf,) for leaf in leaves], f"{LEAF} int")
        rows = rows.filter(F.col(PART).isin(parts) & near).join(F.broadcast(wanted), LEAF, "left_semi")
    return rows.join(F.broadcast(loads), LOAD, "left_semi").drop(LOAD, PART)


def pull_missing(spark: SparkSession, source: str, target: str, schema: str, key: list[str], target_key: str) -> DataFrame:
    """Rows of the stored source whose key the stored target does not hold, from the leaves that differ.

    The rows are those of an anti join of the whole tables. ``schema`` is the source's, ``target_key``
    the schema of the target's key columns.
    """
    leaves = changed(read_digests(spark, source), read_digests(spark, target))
    known = read_rows(spark, target, target_key, leaves)
    return unknown(read_rows(spark, source, schema, leaves), known, [LEAF, *key]).drop(LEAF)


def missing_count(spark: SparkSession, source: str, target: str, key_schema: str, key: list[str]) -> DataFrame:
    """``origin_count, target_count, a_not_b`` of two stored tables; the totals come from the digests alone."""
    totals = [read_digests(spark, folder).agg(F.coalesce(F.sum("n"), F.lit(0)).alias(name)) for folder, name in ((source, "origin_count"), (target, "target_count"))]
    missing = pull_missing(spark, source, target, key_schema, key, key_schema).agg(F.count("*").alias("a_not_b"))
    one = F.lit(1).alias("_one")  # three rows, one of each table
    return reduce(lambda a, b: a.join(b, "_one"), [t.select(one, "*") for t in (*totals, missing)]).drop("_one")
