"""Ordered concatenation over rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _in_order(order: Column, text: Column, sep: str) -> Column:
    rows = F.array_sort(F.collect_list(F.struct(order.alias("o"), F.coalesce(text, F.lit("")).alias("t"))))
    return F.array_join(F.transform(rows, lambda r: r["t"]), sep)


def ordered_concat(
    df: DataFrame, keys: list[str], order: str, text: Column, sep: str, out: str, block: int = 1024
) -> DataFrame:
    """Join the texts of each group in the order of an integer position; null is empty.

    Positions are joined in blocks first, each block a group of its own, so the rows
    of one long group are sorted and joined by many tasks; the last step sees one
    row per block.
    """
    part = F.floor(F.col(order) / block)
    blocks = df.groupBy(*keys, part.alias("_block")).agg(
        _in_order(F.col(order), text, sep).alias("_text")
    )
    return blocks.groupBy(*keys).agg(
        _in_order(F.col("_block"), F.col("_text"), sep).alias(out)
    )
