"""Row ids: a hash of the natural key, or dense numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagequarry.scratch import materialise


def hash_id(*key: Column) -> Column:
    """60-bit id that depends on the key alone.

    The same in every run, partitioning and stream replay. Two of n keys share an
    id with odds near n*n / 2**61: beyond some 10**8 rows use ``wide_id``, which is
    as stable, or ``with_dense_ids``.
    """
    return F.conv(F.substring(wide_id(*key), 1, 15), 16, 10).cast("bigint")


def wide_id(*key: Column) -> Column:
    """128-bit id as text: no two keys of any table will share one."""
    return F.md5(F.concat_ws("|", *[k.cast("string") for k in key]))


def with_dense_ids(df: DataFrame, keys: list[str], out: str = "id") -> DataFrame:
    """Number the rows 1, 2, 3, ... in the order of ``keys`` (unique together).

    One range shuffle sorts the rows; each partition numbers its own and the sizes
    of the partitions before it are added. No window runs over the whole data. The
    range shuffle samples ``df`` before it reads it, so store what is costly to compute.
    """
    local = F.monotonically_increasing_id()
    ranked = materialise(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_part", F.shiftright(local, 33))
        .withColumn("_row", local.bitwiseAND(F.lit((1 << 33) - 1))),
        "dense_ids",
    )
    # One row per partition, so the ordered window and the broadcast stay small.
    sizes = ranked.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    return (
        ranked.join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_before") + F.col("_row") + 1)
        .drop("_part", "_row", "_before")
    )


def request_batches(df: DataFrame, keys: list[str], size: int = 150) -> DataFrame:
    """Number rows in key order and cut them into requests of at most ``size``."""
    numbered = with_dense_ids(df, keys, "_ix")
    return numbered.withColumn("batch", F.floor((F.col("_ix") - 1) / size)).drop("_ix")
