"""Ranks, cuts and running offsets over a whole table without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticeloom.session import pin

PREFIX = 4  # hex digits of a hash bucket: at most 16**4 buckets per group


def hash_order(key: Column, seed: str) -> Column:
    """A fixed random order: the md5 of seed and key."""
    return F.md5(F.concat(F.lit(seed), key.cast("string")))


def _hash_counts(keys: DataFrame) -> DataFrame:
    """Rows per ``_g, _h``: the one pass over the keys, whose exchange all steps of a cut share.

    A repeated key is one row from each task. Joins on these counts compare null-safely: an inferred
    null filter would be pushed below the exchange, which could then not be shared.
    """
    return keys.groupBy("_g", "_h").agg(F.count("*").alias("_c"))


def _edge_hashes(hashes: DataFrame, wanted: DataFrame) -> DataFrame:
    """Per group the hash of its n-th row in hash order.

    Buckets of the hash prefix are summed first; only the bucket that holds the n-th row is ranked.
    ``hashes`` has ``_g, _h, _c``, ``wanted`` has ``_g, _n`` with one row per group.
    """
    hashes = hashes.withColumn("_b", F.substring("_h", 1, PREFIX))
    upto = F.sum("_c").over(Window.partitionBy("_g").orderBy("_b"))  # over the buckets, not the rows
    counts = hashes.groupBy("_g", "_b").agg(F.sum("_c").alias("_c")).withColumn("_upto", upto)
    wanted = wanted.withColumnRenamed("_g", "_group")
    edge = (
        counts.join(F.broadcast(wanted), F.col("_g").eqNullSafe(F.col("_group")))
        .filter((F.col("_upto") >= F.col("_n")) & (F.col("_upto") - F.col("_c") < F.col("_n")))
        .select("_group", F.col("_b").alias("_bucket"), (F.col("_n") - F.col("_upto") + F.col("_c")).alias("_need"))
    )
    place = F.sum("_c").over(Window.partitionBy("_g").orderBy("_h"))
    here = F.col("_g").eqNullSafe(F.col("_group")) & F.col("_b").eqNullSafe(F.col("_bucket"))
    return (
        hashes.join(F.broadcast(edge), here)
        .withColumn("_before", place - F.col("_c"))
        .filter(F.col("_before") < F.col("_need"))
        .groupBy("_g")
        .agg(F.max("_h").alias("_edge"))
    )


def split_by_hash(df: DataFrame, key: str, share: float, seed: str, name: str = "part", parts=("train", "dev")) -> DataFrame:
    """Exact cut: the first ``int(n * share)`` rows in hash order get ``parts[0]``. Keys are unique.

    The cut is one hash, found in one pass over the keys; the rows themselves are scanned once and not moved.
    """
    hashes = _hash_counts(df.select(F.lit(0).alias("_g"), hash_order(F.col(key), seed).alias("_h")))
    n = hashes.groupBy("_g").agg(F.floor(F.sum("_c") * F.lit(share)).alias("_n"))
    edge = _edge_hashes(hashes, n).agg(F.max("_edge")).scalar()
    first = F.coalesce(hash_order(F.col(key), seed) <= edge, F.lit(False))
    return df.withColumn(name, F.when(first, F.lit(parts[0])).otherwise(F.lit(parts[1])))


def split_by_share(df: DataFrame, key: str, share: float, seed: str, name: str = "part", parts=("train", "dev")) -> DataFrame:
    """Approximate cut by the hash alone: one pass and no shuffle."""
    point = F.conv(F.substring(hash_order(F.col(key), seed), 1, 8), 16, 10).cast("double") / float(16**8)
    return df.withColumn(name, F.when(point < share, F.lit(parts[0])).otherwise(F.lit(parts[1])))


def balance_and_split(df: DataFrame, key: str, flag: str, share: float, seed: str, name: str = "part", parts=("train", "dev")) -> DataFrame:
    """Both classes cut to the size of the smaller one in hash order, each split by ``share``."""
    hashed = df.filter(F.col(flag).isNotNull()).withColumns(
        {"_g": F.col(flag).cast("int"), "_h": hash_order(F.col(key), seed)}
    )
    hashes = _hash_counts(hashed.select("_g", "_h"))
    sizes = hashes.groupBy("_g").agg(F.sum("_c").alias("count"))
    both = Window.partitionBy(F.lit(0))  # two rows, one per class
    sized = sizes.withColumn("_m", F.when(F.count("*").over(both) > 1, F.min("count").over(both)).otherwise(F.lit(0)))
    kept = _edge_hashes(hashes, sized.select("_g", F.col("_m").alias("_n"))).withColumnRenamed("_edge", "_keep")
    trained = _edge_hashes(hashes, sized.select("_g", F.floor(F.col("_m") * F.lit(share)).alias("_n")))
    return (
        hashed.join(F.broadcast(kept), "_g")
        .filter(F.col("_h") <= F.col("_keep"))
        .join(F.broadcast(trained), "_g", "left")
        .withColumn(name, F.when(F.col("_h") <= F.col("_edge"), F.lit(parts[0])).otherwise(F.lit(parts[1])))
        .drop("_g", "_h", "_keep", "_edge")
    )


def sample_by_hash(df: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """``n`` rows in hash order: each partition keeps its own first n before they meet."""
    return df.withColumn("_h", hash_order(F.col(key), seed)).orderBy("_h").limit(n).drop("_h")


def first_per_group(df: DataFrame, group: list[str], order: list, k: int) -> DataFrame:
    """First ``k`` rows per group; partitions cut to k per group before the shuffle."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")


def distinct_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first in ``order``.

    An aggregate, not a window: copies of a frequent key collapse before the shuffle.
    """
    others = [c for c in df.columns if c not in key]
    row = F.struct(*[F.col(c) for c in others])
    place = F.struct(*[F.col(c) for c in order])
    picked = df.groupBy(*key).agg(F.min_by(row, place).alias("_row"))
    return picked.select(*[F.col(f"_row.{c}").alias(c) if c in others else F.col(c) for c in df.columns])


def _placed(df: DataFrame, order: list[str]) -> DataFrame:
    """Rows range-sorted over the cluster and pinned, so that places in a partition stay fixed."""
    pinned = pin(df.repartitionByRange(*order).sortWithinPartitions(*order))
    return pinned.withColumns(
        {
            "_part": F.spark_partition_id(),
            "_seq": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
        }
    )


def number_rows(df: DataFrame, order: list[str], name: str = "rn") -> DataFrame:
    """Row numbers 1.. in ``order`` (unique); only one count per partition is gathered."""
    placed = _placed(df, order)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").count().select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_off"))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_off") + F.col("_seq") + 1)
        .drop("_part", "_seq", "_off")
    )


def number_wide(df: DataFrame, order: list[str], name: str = "rn") -> DataFrame:
    """As :func:`number_rows`, but only the ``order`` columns are pinned; the rows find their number by them."""
    if set(df.columns) == set(order):
        return number_rows(df, order, name)
    keys = number_rows(df.select(*order), order, name).withColumnsRenamed({c: f"_key_{c}" for c in order})
    same = [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in order]
    return df.join(keys, same).drop(*[f"_key_{c}" for c in order])


def running_offsets(df: DataFrame, order: list[str], weights: dict[str, str]) -> DataFrame:
    """For each weight column the sum over all earlier rows in ``order``, named by ``weights``."""
    placed = _placed(df, order)
    inside = Window.partitionBy("_part").orderBy("_seq").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("_part").agg(*[F.sum(w).alias(f"_sum_{w}") for w in weights])
    offsets = sums.select("_part", *[F.coalesce(F.sum(f"_sum_{w}").over(before), F.lit(0)).alias(f"_off_{w}") for w in weights])
    joined = placed.join(F.broadcast(offsets), "_part")
    named = {name: F.col(f"_off_{w}") + F.coalesce(F.sum(w).over(inside), F.lit(0)) for w, name in weights.items()}
    return joined.withColumns(named).drop("_part", "_seq", *[f"_off_{w}" for w in weights])
