"""Joining rows to one row per group when a few groups hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnmill.operators.blocks import heavy_keys


def join_groups(
    rows: DataFrame,
    groups: DataFrame,
    keys: list[str],
    how: str = "inner",
    *,
    share: float = 1e-4,
    min_rows: int = 1_000_000,
) -> DataFrame:
    """Join ``rows`` to ``groups``, which has at most one row per key.

    Adaptive execution cannot split a hot key when the other side comes out of an
    aggregation. So rows of heavy keys, of which there are fewer than ``1 / share``, are
    joined to their broadcast groups where they lie; all other rows by a plain join.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    heavy = heavy_keys(rows, keys, share, min_rows)
    if not heavy:
        return rows.join(groups, keys, how)
    hot = F.broadcast(rows.sparkSession.createDataFrame(heavy, rows.select(*keys).schema))
    hot_groups = F.broadcast(groups.join(hot, keys, "left_semi"))
    light = rows.join(hot, keys, "left_anti").join(groups, keys, how)
    return light.unionByName(rows.join(hot, keys, "left_semi").join(hot_groups, keys, how))
