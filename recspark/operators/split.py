"""Train, validation and test splits, and down-sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recspark.operators.indexing import global_index, not_after, rows_at, same_values, sortable


def unit(*parts: Column, seed: int = 42) -> Column:
    """A number in (0, 1) that the seed and the parts decide, the same in every engine with md5."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0


def time_ratio_split(df: DataFrame, order: list[Column], train: float, val: float) -> DataFrame:
    """``split`` by global order: the first floor(n * train) rows train, the next floor(n * val) val, the rest test.

    A ratio of 1 or more puts all rows into train. The two rows where a split ends are searched for, and each row is compared with them, so
    no row is written or shuffled. Only rows that ``order`` doesn't tell from those two are numbered, ties by a hash of the whole row; so are
    all rows where ``order`` holds nulls or anything but whole numbers, dates and times. ``df`` is read several times, so a costly plan should be written first.
    """
    if train >= 1:
        return df.withColumn("split", F.lit("train"))
    absent = F.lit(False)
    for c in order:
        absent = absent | c.isNull()
    known = sortable(df, order)
    size = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(absent).alias("absent")).first()
    n, a = size["n"], int(size["n"] * train)
    ends = [a, a + int(n * val)]
    if not known or size["absent"]:
        return _by_place(global_index(df, order, "__idx"), F.col("__idx"), ends).drop("__idx")
    inner = sorted({e for e in ends if 0 < e < n})
    cuts = dict(zip(inner, rows_at(df, order, [e - 1 for e in inner], n), strict=True))

    def reached(end: int) -> Column:
        """Whether a row lies before ``end``."""
        if end not in cuts:
            return F.lit(end >= n)
        return not_after(order, cuts[end].values)

    compared = df.withColumn("split", F.when(reached(ends[0]), "train").when(reached(ends[1]), "val").otherwise("test"))
    # rows of one value that a split's end parts
    parted = {c.values: c for end, c in cuts.items() if c.before + c.equal > end}
    if not parted:
        return compared
    tied, places = F.lit(False), F.lit(None).cast("long")
    numbered = 0
    for c in sorted(parted.values(), key=lambda c: c.before):
        same = same_values(order, c.values)
        tied, places = tied | same, F.when(same, F.lit(c.before - numbered)).otherwise(places)
        numbered += c.equal
    ties = global_index(df.where(tied), order, "__idx")
    return compared.where(~tied).unionByName(_by_place(ties, F.col("__idx") + places, ends).drop("__idx"))


def _by_place(df: DataFrame, place: Column, ends: list[int]) -> DataFrame:
    return df.withColumn("split", F.when(place < ends[0], "train").when(place < ends[1], "val").otherwise("test"))


def leave_one_out_split(df: DataFrame, user: str, order: list[Column]) -> DataFrame:
    """``split``: a user's last row test, the one before val, all others train. ``order`` goes from the last row on."""
    rank = F.row_number().over(Window.partitionBy(user).orderBy(*order))
    return df.withColumn("split", F.when(rank == 1, "test").when(rank == 2, "val").otherwise("train"))


def downsample_negatives(df: DataFrame, ratio: float, *key: Column, seed: int = 42) -> DataFrame:
    """All rows of label 1, and rows of label 0 whose key's number is below the ratio."""
    return df.where((F.col("label") == 1) | (unit(*key, seed=seed) < ratio))
