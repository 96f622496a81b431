"""Ordered scans over keys of any size.

A plain window function puts all rows of a key into one task. Here a key's rows are cut
into blocks along their order. Windows run inside a block; what a block has to know
about the ones before or after it is one summary row per block, computed with map-side
combining and joined back. The result is the same as that of the plain window.

Whether any key spans several blocks is found out first, with a narrow job. If none does,
the plan is the plain window and nothing else.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from turnmill.session import stored

BLOCK = "_block"
#: Rows of a block of a heavy key.
ROWS_PER_BLOCK = 1 << 20

MOST_KEYS_SENT = 10_000  # keys brought to the driver to pick out their rows


@dataclass(frozen=True)
class Blocked:
    """Rows with a block column.

    ``several`` lists the keys that have more than one block; None stands for any number
    of them, too many to list.
    """

    rows: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    several: list[Row] | None

    @property
    def plain(self) -> bool:
        return self.several is not None and not self.several

    def with_rows(self, rows: DataFrame) -> Blocked:
        return replace(self, rows=rows)

    def split_rows(self) -> DataFrame:
        """The rows to summarise: those of the listed keys, or all of them."""
        if self.several is None:
            return self.rows
        schema = self.rows.select(*self.keys).schema
        listed = self.rows.sparkSession.createDataFrame(self.several, schema)
        listed = F.broadcast(_renamed(listed, list(self.keys)))
        return self.rows.join(listed, _same(self.rows, listed, list(self.keys)), "left_semi")

    def window(self):
        return Window.partitionBy(*self.keys, BLOCK).orderBy(*self.order)


def by_number(df: DataFrame, keys: list[str], order: str, size: int) -> Blocked:
    """Blocks of ``size`` consecutive values of a whole-number order column.

    Which keys go beyond the first block is a filter the scan can push down.
    """
    beyond = df.where((F.col(order) >= size) | (F.col(order) <= -size)).select(*keys).distinct()
    found = beyond.limit(MOST_KEYS_SENT + 1).collect()
    rows = df.withColumn(BLOCK, F.expr(f"`{order}` div {size}"))
    return Blocked(rows, tuple(keys), (order,), found if len(found) <= MOST_KEYS_SENT else None)


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Equal keys, null ones included; ``right`` has them as ``_k0``, ``_k1``, .."""
    return reduce(and_, [left[k].eqNullSafe(right[f"_k{i}"]) for i, k in enumerate(keys)])


def _renamed(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(keys)})


def _heavy_counts(df: DataFrame, keys: list[str], share: float, min_rows: int) -> list[Row]:
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    limit = counts.agg(F.greatest(F.sum("_n") * F.lit(share), F.lit(float(min_rows))).alias("_l"))
    return counts.where(F.col("_n") > limit.scalar()).select(*keys, "_n").collect()


def heavy_keys(df: DataFrame, keys: list[str], share: float, min_rows: int) -> list[Row]:
    """Keys holding more than ``share`` of all rows: fewer than ``1 / share`` of them.

    That bound holds for any data, so they can be brought to the driver. Counting reads
    the key columns alone and combines before its shuffle.
    """
    return [Row(**{k: r[k] for k in keys}) for r in _heavy_counts(df, keys, share, min_rows)]


def by_heavy_key(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    *,
    share: float = 1e-5,
    min_rows: int = 1_000_000,
    size: int = ROWS_PER_BLOCK,
) -> Blocked:
    """Blocks of at most ``size`` rows for heavy keys, one block for every other key.

    The rows of heavy keys are dealt to tasks by ranges of key and order, sorted there, and
    written with the number of their range and of their row in it. Both grow along the order,
    so runs of rows of a range are blocks, whatever the order column holds: a burst in one
    moment is cut like anything else. Rows alike in key and order may come in any order.
    """
    counted = _heavy_counts(df, keys, share, min_rows)
    if not counted:
        return Blocked(df.withColumn(BLOCK, F.lit(0).cast("long")), tuple(keys), tuple(order), [])
    heavy = [Row(**{k: r[k] for k in keys}) for r in counted]
    listed = F.broadcast(_renamed(df.sparkSession.createDataFrame(heavy, df.select(*keys).schema), keys))
    ranges = -(-sum(r["_n"] for r in counted) // size)
    hot = df.join(listed, _same(df, listed, keys), "left_semi")
    sorted_rows = hot.repartitionByRange(ranges, *keys, *order).sortWithinPartitions(*keys, *order)
    # The upper bits of this number are the range, the lower ones the row in it.
    place = F.monotonically_increasing_id()
    row = place.bitwiseAND(F.lit((1 << 33) - 1))
    block = F.shiftright(place, 33) * F.lit(1 << 33) + F.expr("_row div " + str(size)) + 1
    cut = sorted_rows.withColumn("_row", row).withColumn(BLOCK, block).drop("_row")
    cut = stored(cut, "blocks")
    light = df.join(listed, _same(df, listed, keys), "left_anti").withColumn(BLOCK, F.lit(0).cast("long"))
    return Blocked(light.unionByName(cut), tuple(keys), tuple(order), heavy)


_FOLDS = {
    "sum": (F.sum, lambda here, before: here + F.coalesce(before, F.lit(0))),
    "max": (F.max, lambda here, before: F.greatest(here, before)),
    "min": (F.min, lambda here, before: F.least(here, before)),
}


def running(blocked: Blocked, columns: dict[str, tuple[str, Column]]) -> Blocked:
    """Add running aggregates up to and including each row.

    ``columns`` maps the new name to a fold (``sum``, ``max``, ``min``) and a value.
    """
    keys = [*blocked.keys, BLOCK]
    so_far = blocked.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = (
        Window.partitionBy(*blocked.keys)
        .orderBy(BLOCK)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    names = blocked.rows.columns
    if blocked.plain:
        return blocked.with_rows(
            blocked.rows.select(
                "*", *[_FOLDS[fold][0](value).over(so_far).alias(n) for n, (fold, value) in columns.items()]
            )
        )
    totals = (
        blocked.split_rows()
        .groupBy(*keys)
        .agg(*[_FOLDS[fold][0](value).alias(f"_t_{n}") for n, (fold, value) in columns.items()])
    )
    before = totals.select(
        *keys,
        *[_FOLDS[fold][0](f"_t_{n}").over(earlier).alias(f"_b_{n}") for n, (fold, _) in columns.items()],
    )
    here = blocked.rows.select(
        "*",
        *[_FOLDS[fold][0](value).over(so_far).alias(f"_h_{n}") for n, (fold, value) in columns.items()],
    )
    before = _renamed(before, keys)
    joined = here.join(before, _same(here, before, keys), "left")
    return blocked.with_rows(
        joined.select(
            *names,
            *[
                _FOLDS[fold][1](F.col(f"_h_{n}"), F.col(f"_b_{n}")).alias(n)
                for n, (fold, _) in columns.items()
            ],
        )
    )


def neighbours(blocked: Blocked, column: str) -> Blocked:
    """Add ``previous`` and ``following``: structs of ``column``, null at the ends of a key."""
    keys = [*blocked.keys, BLOCK]
    value = F.struct(F.col(column).alias("value"))
    place = F.struct(*blocked.order)
    blocks = Window.partitionBy(*blocked.keys).orderBy(BLOCK)
    window = blocked.window()
    here = blocked.rows.select(
        "*", F.lag(value).over(window).alias("previous"), F.lead(value).over(window).alias("following")
    )
    if blocked.plain:
        return blocked.with_rows(here)
    edges = (
        blocked.split_rows()
        .groupBy(*keys)
        .agg(F.min_by(value, place).alias("_first"), F.max_by(value, place).alias("_last"))
        .select(
            *keys,
            F.lag("_last").over(blocks).alias("_left"),
            F.lead("_first").over(blocks).alias("_right"),
        )
    )
    edges = _renamed(edges, keys)
    return blocked.with_rows(
        here.join(edges, _same(here, edges, keys), "left").select(
            *blocked.rows.columns,
            F.coalesce("previous", "_left").alias("previous"),
            F.coalesce("following", "_right").alias("following"),
        )
    )
