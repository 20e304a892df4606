"""Splitting hot keys by what is measured of them, so that no task holds an unbounded group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def buckets_of(counted: DataFrame, n: str, least: int, rows: int) -> DataFrame:
    """One row (buckets, share) from counts by key: as many buckets as hold about `rows` rows each, `least` at least,
    and a quarter of what one of them holds; a key with more than that is to be split."""
    total = counted.agg(F.coalesce(F.sum(n), F.lit(0)).alias("_rows"))
    total = total.select("_rows", F.greatest(F.lit(least), F.ceil(F.col("_rows") / rows)).cast("long").alias("buckets"))
    return total.select("buckets", (F.col("_rows") / (4.0 * F.col("buckets"))).alias("share"))


def hot_bounds(rows: DataFrame, key: list[str], order: str, buckets: int | DataFrame, pieces: int = 64, counts: DataFrame | None = None) -> DataFrame:
    """(key, bounds): keys with more than a quarter of a bucket's fair share, and the values of `order` (a long) that
    cut their rows into even pieces. At most four keys a bucket can have that many rows, so the result may be broadcast.

    buckets: their number, or the row of `buckets_of`; counts: key and _n of all rows, where they are known already.
    """
    counts = rows.groupBy(*key).agg(F.count("*").alias("_n")) if counts is None else counts
    share = counts.agg((F.sum("_n") / F.lit(4.0 * buckets)).alias("share")) if isinstance(buckets, int) else buckets.select("share")
    hot = counts.join(F.broadcast(share), F.col("_n") > F.col("share")).select(*key)
    quantiles = [i / pieces for i in range(1, pieces)]
    cut = rows.join(F.broadcast(hot), key).groupBy(*key).agg(F.percentile_approx(order, quantiles, 2000).alias("bounds"))
    return cut.select(*key, F.array_distinct("bounds").alias("bounds"))


def piece(order: Column, bounds: Column) -> Column:
    """The number of bounds at or below the value; 0 for keys without bounds."""
    return F.coalesce(F.size(F.filter(bounds, lambda b: b <= order)), F.lit(0))
