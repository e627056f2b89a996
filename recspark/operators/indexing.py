"""A dense global row number without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recspark.functions.names import fresh
from recspark.sources.scratch import written


def global_index(df: DataFrame, order: Sequence[Column], out: str = "idx", within: Sequence[str] = (), partitions: int | None = None) -> DataFrame:
    """``df`` with a 0-based position by ``order``, overall or within the groups of columns ``within``.

    Rows are range-partitioned by (within, order) and written with the number of their partition, so that counting and
    numbering see one partitioning even when executors are lost. Each partition numbers its own rows, and the sizes of
    the partitions before it, one row a partition and group, are added. Ties go by a hash of the whole row, so reruns agree.
    """
    part, at, n, start = fresh([*df.columns, out], "part", "at", "n", "start")
    keys = [F.col(c) for c in within]
    count = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(df.repartitionByRange(count, *keys, *order).withColumn(part, F.spark_partition_id()), "ranged")
    sizes = ranged.groupBy(*within, part).agg(F.count(F.lit(1)).alias(n))
    before = Window.partitionBy(*within).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*within, part, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(start))
    tie = F.xxhash64(*[F.col(f"`{c}`") for c, t in df.dtypes if "map<" not in t])
    numbered = ranged.withColumn(at, F.row_number().over(Window.partitionBy(*within, part).orderBy(*order, tie)))
    on = F.lit(True)
    for c in (*within, part):
        on = on & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    joined = numbered.alias("a").join(starts.alias("b"), on)
    return joined.select(*[F.col(f"a.`{c}`") for c in df.columns], (F.col(f"b.{start}") + F.col(f"a.{at}") - 1).alias(out))


def running_sums(df: DataFrame, order: Sequence[Column], sums: dict[str, Column], within: Sequence[str] = (), partitions: int | None = None, most: dict[str, Column] | None = None) -> DataFrame:
    """``df`` with the sum of each of ``sums``, whole numbers, over the rows before it by ``order``, overall or within the groups of ``within``.

    ``most`` gives the largest value of a column over the rows before, null without any.

    Rows are dealt as in ``global_index``, so a giant group is spread over tasks. Of rows that ``order`` doesn't tell apart
    a hash of the whole row decides.
    """
    most = most or {}
    names, tops = list(sums), list(most)
    part, *helpers = fresh([*df.columns, *names, *tops], "part", *[f"v_{n}" for n in [*names, *tops]])
    values = dict(zip([*names, *tops], helpers, strict=True))
    count = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    valued = df.withColumns({values[n]: F.coalesce(c.cast("long"), F.lit(0).cast("long")) for n, c in sums.items()} | {values[n]: c for n, c in most.items()})
    ranged = written(valued.repartitionByRange(count, *[F.col(c) for c in within], *order).withColumn(part, F.spark_partition_id()), "ranged")
    totals = ranged.groupBy(*within, part).agg(*[F.sum(values[n]).alias(n) for n in names], *[F.max(values[n]).alias(n) for n in tops])
    earlier = Window.partitionBy(*within).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*within, part, *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n) for n in names], *[F.max(n).over(earlier).alias(n) for n in tops])
    tie = F.xxhash64(*[F.col(f"`{c}`") for c, t in df.dtypes if "map<" not in t])
    before = Window.partitionBy(*within, part).orderBy(*order, tie).rowsBetween(Window.unboundedPreceding, -1)
    inner = ranged.withColumns({values[n]: F.coalesce(F.sum(values[n]).over(before), F.lit(0)) for n in names} | {values[n]: F.max(values[n]).over(before) for n in tops})
    on = F.lit(True)
    for c in (*within, part):
        on = on & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    joined = inner.alias("a").join(starts.alias("b"), on)
    return joined.select(*[F.col(f"a.`{c}`") for c in df.columns], *[(F.col(f"a.{values[n]}") + F.col(f"b.{n}")).alias(n) for n in names], *[F.greatest(f"a.{values[n]}", f"b.{n}").alias(n) for n in tops])


#: Rows of a range that are fetched and sorted by the driver, to find a cut among them; larger ranges are narrowed.
FETCHED_ROWS = 20_000
#: Error of an approximate percentile, as a share of the rows: one divided by this.
ACCURACY = 10_000


@dataclass
class Cut:
    """The row at a rank: its values, and how many rows come before the first of those values and have just those."""

    values: tuple
    before: int
    equal: int


@dataclass
class _Search:
    rank: int
    fixed: list
    low: object = None
    high: object = None
    before: int = 0
    inside: int = 0

    def within(self, keys: list[Column]) -> Column:
        """Rows of the range that the rank is known to lie in."""
        out = F.lit(True)
        for k, v in zip(keys, self.fixed, strict=False):
            out = out & (k == F.lit(v))
        if self.low is not None:
            k = keys[len(self.fixed)]
            out = out & (k >= F.lit(self.low)) & (k <= F.lit(self.high))
        return out


def sortable(df: DataFrame, order: Sequence[Column]) -> bool:
    """Whether ``rows_at`` can search by ``order``: columns of whole numbers, dates or times, ascending."""
    kinds = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.TimestampType)
    return all(isinstance(f.dataType, kinds) for f in df.select(*order).schema.fields)


def same_values(order: Sequence[Column], values: Sequence) -> Column:
    out = F.lit(True)
    for k, v in zip(order, values, strict=True):
        out = out & (k == F.lit(v))
    return out


def not_after(order: Sequence[Column], values: Sequence) -> Column:
    """Whether a row comes before the row of these values, or has them."""
    out = F.lit(True)
    for k, v in reversed(list(zip(order, values, strict=True))):
        out = (k < F.lit(v)) | ((k == F.lit(v)) & out)
    return out


def rows_at(df: DataFrame, order: Sequence[Column], ranks: Sequence[int], n: int) -> list[Cut]:
    """The rows at 0-based ``ranks`` of the ``n`` rows of ``df`` by ``order`` (see ``sortable``, no nulls), without sorting or writing ``df``.

    Approximate percentiles bound each rank by two values, an exact count tells what lies before and between them, and so on inside
    until a range is small enough to be fetched; of the rows of one value the next column decides. Each step is one aggregate over ``df`` for all
    ranks, and leaves 3 in ACCURACY rows.
    """
    keys = list(order)
    open_ = [_Search(r, [], inside=n) for r in ranks]
    while searching := [s for s in open_ if s.inside > FETCHED_ROWS and len(s.fixed) < len(keys)]:
        asked = []
        for s in searching:
            at = (s.rank - s.before + 0.5) / s.inside
            ends = [max(0.0, at - 1.5 / ACCURACY), min(1.0, at + 1.5 / ACCURACY)]
            asked.append(F.percentile_approx(F.when(s.within(keys), keys[len(s.fixed)]), ends, ACCURACY))
        bounds = df.agg(*[c.alias(f"p{i}") for i, c in enumerate(asked)]).first()
        counts, near = [], []
        for i, s in enumerate(searching):
            k, (low, high) = keys[len(s.fixed)], bounds[f"p{i}"]
            narrow = _Search(s.rank, s.fixed, low, high)
            near.append(narrow)
            counts += [F.count_if(s.within(keys) & (k < F.lit(low))).alias(f"b{i}"), F.count_if(narrow.within(keys)).alias(f"n{i}")]
        got = df.agg(*counts).first()
        for i, (s, narrow) in enumerate(zip(searching, near, strict=True)):
            before, inside = s.before + got[f"b{i}"], got[f"n{i}"]
            if not before <= s.rank < before + inside:
                raise RuntimeError(f"no row of rank {s.rank} between {narrow.low} and {narrow.high}")
            s.before, s.inside, s.low, s.high = before, inside, narrow.low, narrow.high
            if s.low == s.high:
                s.fixed, s.low, s.high = [*s.fixed, s.low], None, None
    return [_fetched(df, keys, s) for s in open_]


def _fetched(df: DataFrame, keys: list[Column], s: _Search) -> Cut:
    if len(s.fixed) == len(keys):
        return Cut(tuple(s.fixed), s.before, s.inside)
    found = sorted(tuple(r) for r in df.where(s.within(keys)).select(*keys).collect())  # FETCHED_ROWS rows at most
    values = found[s.rank - s.before]
    return Cut(values, s.before + found.index(values), found.count(values))
