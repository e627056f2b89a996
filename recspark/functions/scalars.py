"""Column functions: time, buckets, parsing and the small statistics of a history array."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86400


def try_int(c: Column) -> Column:
    return F.trim(c.cast("string")).try_cast("int")


def epoch_seconds(ntz: Column) -> Column:
    """Seconds since 1970 of a timestamp without zone, whatever the session's zone."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ntz.cast("timestamp_ntz"))


def to_millis(raw: Column) -> Column:
    """Milliseconds of a time that is given in seconds (up to ten digits), in milliseconds (more digits), or formatted.

    Fourteen digits are all digits, so they are read as milliseconds; ``yyyy-MM-dd HH:mm:ss`` is parsed; else null.
    """
    s = F.trim(raw.cast("string"))
    digits = s.rlike(r"^\d+$")
    number = s.try_cast("long")
    parsed = epoch_seconds(s.try_cast("timestamp_ntz")) * 1000
    return F.when(digits & (F.length(s) <= 10), number * 1000).when(digits, number).otherwise(parsed)


def _ntz(seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def day_of(seconds: Column, pattern: str = "yyyy-MM-dd") -> Column:
    return F.date_format(_ntz(seconds), pattern)


def hour_of(seconds: Column) -> Column:
    return F.pmod(F.floor(seconds / 3600), F.lit(24)).cast("int")


def weekday_of(seconds: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return (F.weekday(_ntz(seconds)) + 1).cast("int")


def shift_day(day: Column, n: int) -> Column:
    return F.date_format(F.date_add(day.cast("date"), n), "yyyy-MM-dd")


def release_year(title: Column) -> Column:
    """The year in brackets of a title; 1990 without one."""
    return F.coalesce(F.regexp_extract(title, r"\((\d{4})\)", 1).try_cast("int"), F.lit(1990))


def title_tokens(title: Column) -> Column:
    """White-space tokens of a title without its year in brackets, case kept."""
    bare = F.trim(F.regexp_replace(title, r"\s*\(\d{4}\)\s*$", ""))
    return F.filter(F.split(bare, r"\s+"), lambda t: t != "")


def genre_list(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, r"\|"), lambda g: F.lower(F.trim(g))), lambda g: g != "")


def bucket(value: Column, bounds: Sequence[float], first: int = 1) -> Column:
    """Number of the first upper bound that a value doesn't exceed, from ``first``; the next number beyond all."""
    out = None
    for i, b in enumerate(bounds):
        out = F.when(value <= b, first + i) if out is None else out.when(value <= b, first + i)
    return out.otherwise(first + len(bounds)).cast("long")


def gender_code(gender: Column) -> Column:
    return F.when(gender == "M", 1).when(gender == "F", 2).otherwise(0).cast("long")


def rate_std_bucket(v: Column) -> Column:
    return bucket(v, (0, 1, 2))


def rate_avg_bucket(v: Column) -> Column:
    return F.when(v == 0, 1).when(v < 3, 2).when(v < 4, 3).otherwise(4).cast("long")


def rate_count_bucket(v: Column) -> Column:
    return bucket(v, (0, 10, 30, 50, 100))


def active_day_bucket(v: Column) -> Column:
    return bucket(v, (0, 7, 30))


def item_count_bucket(v: Column) -> Column:
    return bucket(v, (0, 2, 5, 10, 20, 50, 100, 200, 500, 1000))


def item_avg_bucket(v: Column) -> Column:
    return bucket(v, (0, 1, 2, 2.5, 3, 3.5, 4, 4.5))


def hot_rank_bucket(v: Column) -> Column:
    return F.when(v <= 100, 4).when(v <= 500, 3).when(v <= 2000, 2).otherwise(1).cast("long")


def year_bucket(v: Column) -> Column:
    return F.when(v == 0, 1).when(v < 1970, 2).when(v < 1980, 3).when(v < 1990, 4).when(v < 2000, 5).when(v < 2010, 6).otherwise(7).cast("long")


def genre_avg_bucket(v: Column) -> Column:
    return bucket(v, (1, 2, 3, 4))


# ---- a history: array<struct<item_id, rating, ts, genres>>, newest first


def within(history: Column, now: Column, days: int | None) -> Column:
    """Elements strictly before ``now``, and at most ``days`` old."""
    if days is None:
        return F.filter(history, lambda x: x["ts"] < now)
    return F.filter(history, lambda x: (x["ts"] < now) & (x["ts"] >= now - days * DAY))


def once(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of ``value``, which is made once, not at each place where ``f`` reads it (a lambda's body is run for every element)."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def mean_rating(history: Column, default: float = 3.0) -> Column:
    total = F.aggregate(history, F.lit(0.0), lambda s, x: s + x["rating"])
    return F.when(F.size(history) > 0, total / F.size(history)).otherwise(F.lit(default))


def std_rating(history: Column, mean: Column | None = None) -> Column:
    """Population standard deviation of the ratings, whose mean may be given; 0 for an empty history."""

    def spread(m: Column) -> Column:
        return F.sqrt(F.aggregate(history, F.lit(0.0), lambda s, x: s + (x["rating"] - m) * (x["rating"] - m)) / F.size(history))

    return F.when(F.size(history) > 0, once(mean_rating(history) if mean is None else mean, spread)).otherwise(F.lit(0.0))


def genre_stats(history: Column) -> Column:
    """array<struct<genre, cnt, avg>> over all genres of a history, by genre."""
    return F.transform(genre_elements(history), _of_genre)


def _of_genre(e: Column) -> Column:
    return F.struct(e["genre"].alias("genre"), F.size(e["own"]).alias("cnt"), mean_rating(e["own"]).alias("avg"))


def genre_elements(history: Column) -> Column:
    """array<struct<genre, own>> over all genres of a history, by genre: the ratings and times of its elements of that genre."""

    def dealt(known: Column) -> Column:
        genres = F.array_sort(F.array_distinct(F.flatten(F.transform(known, lambda x: x["genres"]))))

        def own(g: Column) -> Column:
            return F.filter(known, lambda x: F.coalesce(F.array_contains(x["genres"], g), F.lit(False)))

        return F.transform(genres, lambda g: F.struct(g.alias("genre"), F.transform(own(g), lambda x: F.struct(x["rating"].alias("rating"), x["ts"].alias("ts"))).alias("own")))

    return once(F.filter(history, lambda x: x["genres"].isNotNull()), dealt)


def genre_counts(history: Column) -> Column:
    """array<struct<genre, cnt>> over all genres of a history, by genre: how many elements have it."""

    def counted(flat: Column) -> Column:
        return F.transform(F.array_sort(F.array_distinct(flat)), lambda g: F.struct(g.alias("genre"), (F.size(flat) - F.size(F.array_remove(flat, g))).alias("cnt")))

    own = F.transform(F.filter(history, lambda x: x["genres"].isNotNull()), lambda x: F.array_distinct(F.array_compact(x["genres"])))
    return once(F.flatten(own), counted)


def stats_within(elements: Column, now: Column, days: int | None) -> Column:
    """``genre_stats`` of a window, from ``genre_elements`` of the whole history."""
    kept = F.transform(elements, lambda e: F.struct(e["genre"].alias("genre"), within(e["own"], now, days).alias("own")))
    kept = F.filter(kept, lambda e: F.size(e["own"]) > 0)
    return F.transform(kept, _of_genre)


def top_genres(stats: Column, k: int = 3) -> Column:
    """The ``k`` genres with the highest counts, ties by name."""
    keyed = F.array_sort(F.transform(stats, lambda s: F.struct((-s["cnt"]).alias("o"), s["genre"].alias("genre"), s["cnt"].alias("cnt"))))
    return F.transform(F.slice(keyed, 1, k), lambda s: F.struct(s["genre"].alias("genre"), s["cnt"].alias("cnt")))


def same_genre_mean(stats: Column, genres: Column) -> Column:
    """Mean of a user's genre averages over an item's genres; 3 without one."""
    own = F.filter(stats, lambda s: F.coalesce(F.array_contains(genres, s["genre"]), F.lit(False)))
    return once(own, lambda o: F.when(F.size(o) > 0, F.aggregate(o, F.lit(0.0), lambda a, s: a + s["avg"]) / F.size(o)).otherwise(F.lit(3.0)))


def same_genre_mean_of(history: Column, genres: Column) -> Column:
    """``same_genre_mean`` of a history's statistics, made for the item's genres only."""

    def own(g: Column) -> Column:
        return F.filter(history, lambda x: F.coalesce(F.array_contains(x["genres"], g), F.lit(False)))

    kept = F.filter(F.transform(F.array_sort(F.array_distinct(F.array_compact(genres))), own), lambda o: F.size(o) > 0)
    means = F.transform(kept, lambda o: mean_rating(o))
    return once(means, lambda m: F.when(F.size(m) > 0, F.aggregate(m, F.lit(0.0), lambda a, x: a + x) / F.size(m)).otherwise(F.lit(3.0)))
