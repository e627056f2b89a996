"""Features of a user's earlier events, without copying histories onto rows and without a task a user."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recspark.functions import scalars as X
from recspark.functions.names import fresh
from recspark.operators.indexing import running_sums
from recspark.operators.windows import DAYS

#: Distinct times of a user that one task makes sequences of.
CHUNK_TIMES = 50_000


def stats_before(samples: DataFrame, events: DataFrame, keys: Sequence[str] = ("user_id",), days: Sequence[int] = DAYS, unit: float = 1.0, last: str | None = None) -> DataFrame:
    """``samples`` with cnt_, avg_ and std_ of the ratings of events with the same ``keys`` before them: of all, and of each window of days.

    Sums of a window are differences of running sums at its two ends, so work grows with rows and windows, not with the
    length of histories, and a user of any size is spread over tasks. The sums are of whole multiples of ``unit``, to which ratings
    are rounded, and so exact. Null keys equal each other; null times are before nothing and have nothing before them; null ratings are counted in cnt_
    only. Without ratings avg_ is 3 and std_ is 0. ``last`` names a column with the time of the last event before, null without any. Columns of ``samples`` with names of results are replaced.
    """
    at, of, w, kind, r, newest, *sums = fresh(keys, "at", "of", "w", "kind", "r", "newest", "cnt", "n", "s", "q")
    dated = [x.where(F.col("time_stamp").isNotNull()) for x in (samples, events)]
    asked = dated[0].select(*keys, F.col("time_stamp").alias(of)).distinct()
    ends = [F.struct(F.lit(d).alias(w), (F.col(of) - d * X.DAY).alias(at)) for d in (0, *days)]
    probes = asked.select(*keys, of, F.inline(F.array(*ends))).withColumns({kind: F.lit(0), r: F.lit(None).cast("long")})
    given = dated[1].withColumns({r: F.round(F.col("rating") / unit).cast("long")}).select(*keys, F.lit(None).cast(dict(asked.dtypes)[of]).alias(of), F.lit(None).cast("int").alias(w), F.col("time_stamp").alias(at), F.lit(1).alias(kind), r)
    summed = running_sums(probes.unionByName(given), [F.col(at), F.col(kind)], dict(zip(sums, [F.col(kind), F.col(r).isNotNull(), F.col(r), F.col(r) * F.col(r)], strict=True)), keys, most={newest: F.when(F.col(kind) == 1, F.col(at))} if last else None)
    picked = [F.max(F.when(F.col(w) == d, F.col(c))).alias(f"{c}{d}") for d in (0, *days) for c in sums]
    if last:
        picked.append(F.max(F.when(F.col(w) == 0, F.col(newest))).alias(newest))
    found = summed.where(F.col(kind) == 0).groupBy(*keys, of).agg(*picked)

    out = {}
    for d in (None, *days):
        cnt, n, s, q = [F.col(f"b.{c}0") - (F.lit(0) if d is None else F.col(f"b.{c}{d}")) for c in sums]
        wide = [c.cast("decimal(19,0)") for c in (n, s, q)]
        spread = (wide[0] * wide[2] - wide[1] * wide[1]).cast("double")
        name = "all" if d is None else str(d)
        out[f"cnt_{name}"] = F.coalesce(cnt, F.lit(0)).cast("long")
        out[f"avg_{name}"] = F.coalesce(F.when(n > 0, s * unit / n), F.lit(3.0))
        out[f"std_{name}"] = F.coalesce(F.when(n > 0, F.sqrt(spread) * unit / n), F.lit(0.0))
    if last:
        out[last] = F.col(f"b.{newest}")
    kept = samples.drop(*out)
    joined = kept.alias("a").join(found.alias("b"), _same(keys) & (F.col("a.time_stamp") == F.col(f"b.{of}")), "left")
    return joined.select(*[F.col(f"a.`{c}`") for c in kept.columns], *[c.alias(n) for n, c in out.items()])


def _same(keys: Sequence[str]) -> Column:
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"a.`{k}`").eqNullSafe(F.col(f"b.`{k}`"))
    return on


def same_genre_before(samples: DataFrame, events: DataFrame, items: DataFrame, days: Sequence[int] = (1, 3, 7, 15)) -> DataFrame:
    """``samples`` with hit_all and hit_ of each window (2 if the user had an event with a genre of the sample's item before, else 1), and
    same_genre_rate, the mean over those genres of their average rating before (3 without any).

    One ``stats_before`` by user and genre: rows grow with the genres of an item, not with a user's history. Whether a window has an event is told
    by the last one before the sample, so no window needs rows of its own.
    """
    own = items.select("item_id", F.array_distinct("genres").alias("genre"))
    of = ["user_id", "item_id", "time_stamp"]
    asked = samples.select(*of).distinct().join(own, "item_id").withColumn("genre", F.explode("genre"))
    given = events.select(*of, "rating").join(own, "item_id").withColumn("genre", F.explode("genre"))
    (last,) = fresh([*asked.columns, *given.columns], "last")
    stats = stats_before(asked, given, ("user_id", "genre"), (), last=last)
    hits = {"hit_all": F.max(F.when(F.col("cnt_all") > 0, 2).otherwise(1))}
    hits |= {f"hit_{d}": F.max(F.when(F.col(last) >= F.col("time_stamp") - d * X.DAY, 2).otherwise(1)) for d in days}
    # a genre without events before has no rating that counts
    rate = F.avg(F.when(F.col("cnt_all") > 0, F.col("avg_all"))).alias("same_genre_rate")
    found = stats.groupBy(*of).agg(*[c.alias(n) for n, c in hits.items()], rate)
    kept = samples.drop(*hits, "same_genre_rate")
    joined = kept.alias("a").join(found.alias("b"), _same(of), "left")
    return joined.select(*[F.col(f"a.`{c}`") for c in kept.columns], *[F.coalesce(f"b.{n}", F.lit(1)).alias(n) for n in hits], F.coalesce("b.same_genre_rate", F.lit(3.0)).alias("same_genre_rate"))


def sequences_before(ix: DataFrame, n: int = 200, element: Column | None = None, ties: Sequence[Column] = (), out: str = "history", chunk: int = CHUNK_TIMES) -> DataFrame:
    """``ix`` with ``out``: the user's ``n`` last events before each row's time, newest first, as array<struct<item_id, rating, ts>> or of ``element``.

    Events of one time come in the order of ``ties``, by item and higher rating first if none are given. Rows are numbered by the
    user's distinct times and dealt in chunks of these, each with the last ``n`` of the chunk before, so that a user of any
    size is spread over tasks; lists are made last, where their rows stay, and cross no shuffle. Null users are one user; rows of null
    time have no events before them and are before none. A column ``out`` is replaced.
    """
    ix = ix.drop(out)
    tie, at, part, e = fresh([*ix.columns, out], "tie", "at", "part", "e")
    size = max(chunk, n)
    time = F.col("time_stamp")
    ties = list(ties) or [F.col("item_id"), F.col("rating").desc()]
    element = F.struct("item_id", "rating", time.alias("ts")) if element is None else element
    ranked = ix.withColumn(tie, F.row_number().over(Window.partitionBy("user_id", "time_stamp").orderBy(*ties)))
    placed = running_sums(ranked, [time, F.col(tie)], {at: (F.col(tie) == 1) & time.isNotNull()}, ["user_id"])
    # the sum before a row has its own time in it, unless it is the first of that time
    placed = placed.withColumn(at, F.col(at) - F.when((F.col(tie) > 1) & time.isNotNull(), 1).otherwise(0))
    home = F.floor(F.col(at) / size)
    dealt = placed.withColumn(part, F.explode(F.when(F.col(at) % size >= size - n, F.array(home, home + 1)).otherwise(F.array(home))))
    # of one time no more than n events can be among the last n
    listed = dealt.withColumn(e, F.when(time.isNotNull() & (F.col(tie) <= n), F.struct((-F.col(at)).alias("at"), F.col(tie).alias("tie"), element.alias("v"))))
    before = F.collect_list(e).over(Window.partitionBy("user_id", part).orderBy(at).rangeBetween(-n, -1))
    made = listed.withColumn(e, before).where(F.col(part) == home)
    return made.select(*[f"`{c}`" for c in ix.columns], F.transform(F.slice(F.array_sort(e), 1, n), lambda x: x["v"]).alias(out))
