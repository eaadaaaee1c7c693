"""Arrays to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_once(
    df: DataFrame, array: Column, *keys: str, pos: str = "pos", item: str = "item"
) -> DataFrame:
    """One row per array item with its position; empty arrays give no row.

    For a plain ``posexplode`` the optimizer adds a filter on the array's size, which
    computes the array a second time. The outer form and a filter after it do not.
    """
    listed = df.select(*keys, array.alias("_array"))
    return listed.select(*keys, F.posexplode_outer("_array").alias(pos, item)).where(
        F.col(pos).isNotNull()
    )
