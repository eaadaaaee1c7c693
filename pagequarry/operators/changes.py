"""Changes between two snapshots of a table, and applying them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.scratch import materialise


# Timestamps to the microsecond, wherever they are nested.
EXACT = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "ignoreNullFields": "false",
}


def fingerprint(*columns: str) -> Column:
    """Digest that tells null from empty and one column from the next."""
    return F.sha2(F.to_json(F.struct(*columns), EXACT), 256)


def snapshot_changes(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows to insert, update or delete to get from ``old`` to ``new``.

    Only keys and fingerprints are shuffled to find the changes; the content of the
    changed rows alone is then joined in.
    """
    values = [c for c in new.columns if c != key]
    before = old.select(key, fingerprint(*values).alias("_old"))
    after = new.select(key, fingerprint(*values).alias("_new"))
    kind = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_new").isNull(), "delete")
        .otherwise("update")
    )
    # Written down because it is read twice; its size then tells Spark whether to
    # broadcast it against the new snapshot. A deleted row has no content to fetch.
    changed = materialise(
        before.join(after, key, "full_outer")
        .where(~F.col("_old").eqNullSafe(F.col("_new")))
        .select(key, kind.alias("change")),
        "changed_keys",
    )
    upserts = changed.where(F.col("change") != "delete").join(new, key)
    deletes = changed.where(F.col("change") == "delete")
    return upserts.unionByName(deletes, allowMissingColumns=True)


def apply_changes(base: DataFrame, changes: DataFrame, key: str, version: str) -> DataFrame:
    """``base`` after the latest change of each key.

    ``max_by`` combines on the map side, so a key changed very often is reduced
    before the shuffle. The result is written down because it is read twice; unchanged
    base rows pass through an anti join, a broadcast when its size allows.
    """
    payload = [c for c in changes.columns if c not in (key, version)]
    order = F.struct(version, fingerprint(*payload))
    latest = materialise(
        changes.groupBy(key)
        .agg(F.max_by(F.struct(*payload), order).alias("_last"))
        .select(key, "_last.*"),
        "latest_changes",
    )
    upserts = latest.where(F.col("change") != "delete").select(base.columns)
    return base.join(latest.select(key), key, "left_anti").unionByName(upserts)
