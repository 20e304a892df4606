"""Ordered computations whose keys may be of any size: a hot key is cut by time into pieces that carry what they need."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronopitch.operators.skew import hot_bounds, piece
from chronopitch.session import width


def latest_by(rows: DataFrame, key: list[str], *order: Column) -> DataFrame:
    """The last row of each key in the given order (put a unique id last), by partial aggregation: no sort, no skew."""
    whole = F.struct(*(F.col(f"`{c}`") for c in rows.columns))
    best = rows.groupBy(*key).agg(F.max_by(whole, F.struct(*order)).alias("_row"))
    return best.select("_row.*")


def earliest_by(rows: DataFrame, key: list[str], *order: Column) -> DataFrame:
    whole = F.struct(*(F.col(f"`{c}`") for c in rows.columns))
    return rows.groupBy(*key).agg(F.min_by(whole, F.struct(*order)).alias("_row")).select("_row.*")


def _pieces(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    bounds = hot_bounds(rows.select(*key, order), key, order, width(rows.sparkSession, 2))
    return rows.join(F.broadcast(bounds), key, "left").withColumns({"_piece": piece(F.col(order), F.col("bounds")), "_hot": F.col("bounds").isNotNull()}).drop("bounds")


def with_last(rows: DataFrame, key: list[str], order: str, tie: str, n: int, values: dict[str, Column]) -> DataFrame:
    """`rows` with window values over the n rows before each, as if partitioned by key and ordered by (order, tie).

    values: name to an aggregate or function that takes a window. order is a long column. A piece of a hot key gets
    the last n rows of all its pieces before as a halo, so every frame is whole; frames of other keys need none.
    """
    cut = _pieces(rows, key, order)
    hot = cut.where("_hot")  # only hot keys have more than one piece: the rest is sorted once, for its own frames
    tail = Window.partitionBy(*key, "_piece").orderBy(F.desc(order), F.desc(tie))
    tails = hot.withColumn("_t", F.row_number().over(tail)).where(F.col("_t") <= n).drop("_t")
    several = hot.groupBy(*key).agg(F.max("_piece").alias("_last")).where("_last > 0")
    # At most n rows of each piece before, for the pieces of hot keys only.
    ahead = tails.join(F.broadcast(several), key).withColumn("_to", F.explode_outer(F.when(F.col("_piece") < F.col("_last"), F.sequence(F.col("_piece") + 1, F.col("_last")))))
    near = Window.partitionBy(*key, "_to").orderBy(F.desc(order), F.desc(tie))
    halo = ahead.where("_to IS NOT NULL").withColumn("_t", F.row_number().over(near)).where(F.col("_t") <= n).withColumn("_piece", F.col("_to"))
    both = cut.withColumn("_halo", F.lit(False)).unionByName(halo.select(*cut.columns).withColumn("_halo", F.lit(True)))
    frame = Window.partitionBy(*key, "_piece").orderBy(order, tie)
    out = both.select("*", *((f(frame) if callable(f) else f.over(frame.rowsBetween(-n, -1))).alias(name) for name, f in values.items()))
    return out.where(~F.col("_halo")).drop("_halo", "_piece", "_hot")


def with_running(rows: DataFrame, key: list[str], order: str, sums: dict[str, Column], strictly: bool = True) -> DataFrame:
    """`rows` with the sums over all rows of the key whose order is less (or, not strictly, at most equal).

    Each piece of a hot key adds the totals of the pieces before; a piece never splits rows of one order value.
    """
    cut = _pieces(rows, key, order)
    named = [(n, F.coalesce(c, F.lit(0))) for n, c in sums.items()]
    totals = cut.where("_hot").groupBy(*key, "_piece").agg(*(F.sum(c).alias(f"_{n}") for n, c in named))
    before = Window.partitionBy(*key).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*key, "_piece", *(F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}") for n, _ in named))
    frame = Window.partitionBy(*key, "_piece").orderBy(order).rangeBetween(Window.unboundedPreceding, -1 if strictly else 0)
    inner = cut.select("*", *(F.coalesce(F.sum(c).over(frame), F.lit(0)).alias(f"_own_{n}") for n, c in named))
    # Hot keys are few and have few pieces.
    out = inner.join(F.broadcast(totals), [*key, "_piece"], "left").na.fill(0, [f"_{n}" for n, _ in named])
    return out.select(*(F.col(f"`{c}`") for c in rows.columns), *((F.col(f"_own_{n}") + F.col(f"_{n}")).alias(n) for n, _ in named))
