"""Seeded train/validation split with exact sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnmill import fixed

_BUCKET_DIGITS = 4  # hexadecimal digits, so 65,536 buckets at most


def _hash(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def _cut(ids: DataFrame, key: str, share: float) -> DataFrame:
    """One row: the last validation key in hash order, as ``(hash, key)``.

    Counting per hash bucket finds the bucket the cut falls into; only that bucket,
    1/65,536 of the keys, is sorted. No key list reaches the driver or one task.
    """
    bucket = F.conv(F.substring("_hash", 1, _BUCKET_DIGITS), 16, 10).cast("int")
    placed = ids.withColumn("_bucket", bucket)
    counts = placed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # At most 65,536 count rows, so one task may order them.
    ordered = Window.orderBy("_bucket")
    everything = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = counts.select(
        "_bucket", "_n", F.sum("_n").over(ordered).alias("_upto"), F.sum("_n").over(everything).alias("_all")
    )
    wanted = F.ceil(F.lit(share) * F.col("_all").cast("double"))
    left = (wanted - F.col("_upto") + F.col("_n")).alias("left")
    edge = (
        upto.where(F.col("_upto") >= wanted)
        .agg(F.min(F.struct(F.col("_bucket").alias("bucket"), left)).alias("_edge"))
        .scalar()
    )
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_hash", key))
    return (
        placed.where(F.col("_bucket") == edge["bucket"])
        .withColumn("_rank", rank)
        .where(F.col("_rank") <= edge["left"])
        .agg(F.max(F.struct("_hash", key)).alias("_cut"))
    )


def train_val_split(
    df: DataFrame,
    key: str = "conv_id",
    share: float = fixed.VALIDATION_SHARE,
    seed: int = fixed.SPLIT_SEED,
) -> DataFrame:
    """Add ``split``. Exactly ``ceil(share * n)`` of the n distinct keys are ``val``.

    All rows of a key land on the same side. The rows themselves are only mapped over:
    the cut is a single value, so the table is neither shuffled nor joined.
    """
    hashed = _hash(key, seed)
    ids = df.select(key).distinct().withColumn("_hash", hashed)
    cut = _cut(ids, key, share).scalar()
    place = F.struct(hashed.alias("_hash"), F.col(key))
    return df.withColumn("split", F.when(place <= cut, "val").otherwise("train"))


def split_counts(df: DataFrame, key: str = "conv_id") -> DataFrame:
    """Distinct keys per split."""
    return df.select(key, "split").distinct().groupBy("split").agg(F.count(F.lit(1)).alias("n"))
