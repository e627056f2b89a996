"""The library's queries over the star-schema tables, each with the same query in SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.functions import scalars as X
from recspark.operators import clean, encode, evaluate, point_in_time, profiles, quality, sampling, sequences, split, vocab, windows
from recspark.operators.indexing import global_index
from recspark.operators.registry import Registry
from recspark.plans import training
from recspark.plans.stages import Stages
from recspark.sources import sinks, tfrecord, text, views
from recspark.sources.scratch import new_path, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
#: Items of a sequence in the queries that show how it is cut, and of a history everywhere else.
N, HISTORY = 20, 200


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = "WITH " + COMMON + sql if not sql.lstrip().startswith("WITH") else sql
        return f

    return add


COMMON = """
ix AS (SELECT DISTINCT o_custkey::VARCHAR AS user_id, l_partkey::VARCHAR AS item_id, CAST(ceil(l_quantity / 10) AS INT) AS rating,
    epoch(o_orderdate)::BIGINT + l_linenumber AS time_stamp, strftime(o_orderdate, '%Y-%m-%d') AS day
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE ceil(l_quantity / 10) BETWEEN 1 AND 5),
items AS (SELECT p_partkey::VARCHAR AS item_id, p_name AS title, string_split(p_name, ' ') AS genres FROM part),
users AS (SELECT c_custkey::VARCHAR AS user_id, CASE WHEN c_mktsegment < 'F' THEN 'F' ELSE 'M' END AS gender, c_nationkey::VARCHAR AS age, n_regionkey::VARCHAR AS occupation,
    lpad(c_custkey::VARCHAR, 5, '0') AS zip_code FROM customer JOIN nation ON c_nationkey = n_nationkey),
ev AS (SELECT event_id AS sample_id, user_id::VARCHAR AS user_id, regexp_extract(props, '"k": *([0-9]+)', 1) AS item_id, 1 + (CAST(floor(value) AS BIGINT) % 5 + 5) % 5 AS rating,
    floor(epoch(ts))::BIGINT AS time_stamp, strftime(ts, '%Y-%m-%d') AS day FROM events),
counts AS (SELECT item_id, count(DISTINCT user_id) AS rate_count, round(avg(rating), 2) AS avg_rate FROM ix GROUP BY 1),
stats AS (SELECT item_id, title, genres, len(genres) AS genre_cnt, rate_count, avg_rate, row_number() OVER (ORDER BY rate_count DESC, item_id) AS hot_rank FROM counts JOIN items USING (item_id)),
latest AS (SELECT user_id, item_id, rating, time_stamp FROM (SELECT *, row_number() OVER (PARTITION BY user_id, item_id ORDER BY time_stamp DESC, rating DESC) AS r FROM ix) WHERE r = 1),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY time_stamp DESC, item_id) AS rk FROM latest) WHERE rk <= 20),
evlatest AS (SELECT user_id, item_id, rating, time_stamp FROM (SELECT *, row_number() OVER (PARTITION BY user_id, item_id ORDER BY time_stamp DESC, rating DESC) AS r FROM ev) WHERE r = 1),
evtop AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY time_stamp DESC, item_id) AS rk FROM evlatest) WHERE rk <= 200),
hist AS (SELECT s.sample_id, s.time_stamp, h.rk, h.item_id AS h_item, h.rating AS h_rating, s.time_stamp - h.time_stamp AS age FROM ev s JOIN evtop h ON s.user_id = h.user_id AND h.time_stamp < s.time_stamp),
preds AS (SELECT doc_id, quality::DOUBLE AS label, n_chars::DOUBLE AS score, source AS grp, lang FROM labels JOIN documents USING (doc_id))
"""


def _ix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_ratings(views.order_interactions(spark, sf_dir))


def _ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.event_interactions(spark, sf_dir)


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _ev(spark, sf_dir)
    seqs = sequences.with_genres(sequences.user_sequences(ev.drop("sample_id"), HISTORY), views.items(spark, sf_dir))
    return windows.with_history(ev, seqs)


# ---- cleaning, item statistics, sequences, joins


@query("SELECT user_id, item_id, rating, time_stamp, day FROM ix")
def clean_interactions(spark, sf_dir):
    return _ix(spark, sf_dir)


@query("SELECT item_id, title, array_to_string(genres, '|') AS genres, genre_cnt, rate_count, avg_rate, hot_rank FROM stats")
def item_stats(spark, sf_dir):
    return sequences.item_stats(_ix(spark, sf_dir), views.items(spark, sf_dir)).withColumn("genres", F.array_join("genres", "|"))


@query("SELECT item_id, rate_count, row_number() OVER (ORDER BY rate_count DESC, item_id) AS hot_rank FROM counts")
def hot_rank(spark, sf_dir):
    counts = sequences.item_counts(_ix(spark, sf_dir)).drop("avg_rate")
    return global_index(counts, [F.col("rate_count").desc(), F.col("item_id")], "hot_rank").withColumn("hot_rank", F.col("hot_rank") + 1)


@query("SELECT user_id, item_id, rating, time_stamp FROM latest")
def latest_per_user_item(spark, sf_dir):
    return sequences.latest_per_user_item(_ix(spark, sf_dir)).select("user_id", "item_id", "rating", "time_stamp")


@query("SELECT user_id, string_agg(item_id || ':' || rating || ':' || time_stamp, ',' ORDER BY rk) AS seq FROM top GROUP BY 1")
def user_sequence_topn(spark, sf_dir):
    return sequences.sequence_text(sequences.user_sequences(_ix(spark, sf_dir), N))


@query("""SELECT user_id, string_agg(item_id || ':' || rating, ',' ORDER BY rk) AS seq FROM
(SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY time_stamp DESC, item_id, rating DESC) AS rk FROM (SELECT DISTINCT user_id, item_id, rating, time_stamp FROM ix)) WHERE rk <= 20 GROUP BY 1""")
def user_sequence_all(spark, sf_dir):
    return sequences.sequence_text(sequences.user_sequences(_ix(spark, sf_dir), N, latest=False), with_time=False)


@query("""SELECT ix.user_id, ix.item_id, rating, time_stamp, gender, age, occupation, zip_code, title, rate_count, hot_rank, coalesce(n, 0) AS n_behavior FROM ix
LEFT JOIN users USING (user_id) LEFT JOIN stats USING (item_id) LEFT JOIN (SELECT user_id, count(*) AS n FROM top GROUP BY 1) q USING (user_id)""")
def join_sample(spark, sf_dir):
    ix, it = written(_ix(spark, sf_dir), "interactions"), views.items(spark, sf_dir)
    j = sequences.join_samples(ix, views.users(spark, sf_dir), sequences.user_sequences(ix, N), sequences.item_stats(ix, it))
    return j.select("user_id", "item_id", "rating", "time_stamp", "user_profile.*", "item_feature.title", "item_feature.rate_count", "item_feature.hot_rank", F.coalesce(F.size("user_behavior"), F.lit(0)).alias("n_behavior"))


@query("""SELECT o_orderkey, o_custkey::VARCHAR AS user_id, l_partkey::VARCHAR AS item_id, l_linenumber, p_brand, gender, n FROM lineitem JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN users ON user_id = o_custkey::VARCHAR LEFT JOIN (SELECT user_id AS u, count(*) AS n FROM top GROUP BY 1) ON u = o_custkey::VARCHAR""")
def join_sample_star(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem").join(views.table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    facts = lines.select("o_orderkey", F.col("o_custkey").cast("string").alias("user_id"), F.col("l_partkey").cast("string").alias("item_id"), "l_linenumber")
    ads = views.items(spark, sf_dir).select("item_id", F.col("brand").alias("p_brand"))
    seqs = sequences.user_sequences(_ix(spark, sf_dir), N).select("user_id", F.size("seq").alias("n"))
    return sequences.star_join(facts, ads, views.users(spark, sf_dir).select("user_id", "gender"), seqs)


@query("SELECT item_id, title, coalesce(rate_count, 0) AS rate_count, coalesce(avg_rate, 0) AS avg_rate FROM items LEFT JOIN (SELECT item_id, count(DISTINCT user_id) AS rate_count, round(avg(rating), 2) AS avg_rate FROM ix WHERE rating = 5 AND day < '1996-06-01' GROUP BY 1) USING (item_id)")
def item_stats_left(spark, sf_dir):
    return sequences.item_stats_left(_ix(spark, sf_dir).where("rating = 5 and day < '1996-06-01'"), views.items(spark, sf_dir)).select("item_id", "title", "rate_count", "avg_rate")


@query("SELECT o_orderkey::VARCHAR AS sample, CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE 1 END = 1 AS parse_ok, CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE (o_orderkey % 5)::INT END AS rating, epoch(o_orderdate)::BIGINT * 1000 AS millis FROM orders")
def parse_samples(spark, sf_dir):
    o = views.table(spark, sf_dir, "orders")
    raw = o.select(
        F.col("o_orderkey").cast("string").alias("sample"), F.col("o_custkey").cast("string").alias("user_id"), F.lit("1").alias("item_id"),
        F.when(F.col("o_orderkey") % 7 == 0, "x").otherwise((F.col("o_orderkey") % 5).cast("string")).alias("rating"), X.epoch_seconds(F.col("o_orderdate")).cast("string").alias("time_stamp"),
    )
    return clean.parse_samples(raw).select("sample", "parse_ok", "rating", "millis")


@query("SELECT user_id, count(*) AS n, max(day) AS last_day FROM ev WHERE day <= (SELECT max(day) FROM ev WHERE day <= '2024-01-20') GROUP BY 1")
def latest_partition(spark, sf_dir):
    ev = _ev(spark, sf_dir)
    last = text.latest_day(ev, "2024-01-20")
    return ev.join(F.broadcast(last.withColumnRenamed("day", "last")), F.col("day") <= F.col("last")).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("day").alias("last_day"))


@query("SELECT (SELECT max(day) FROM ev) AS last, (SELECT max(day) FROM ev WHERE day <= '2024-01-20') AS nearest")
def partition_days(spark, sf_dir):
    """The last day of a table partitioned by day, and the last not after a given one, from the listing of its files."""
    ev, path = _ev(spark, sf_dir), new_path(spark, "days")
    sinks.write_partition(ev, path, ["day"])
    days = text.listed_days(spark.read.schema(ev.schema).parquet(path))
    return text.last_day(days).select(F.col("day").alias("last")).crossJoin(text.latest_day(days, "2024-01-20").select(F.col("day").alias("nearest")))  # one row each


@query("SELECT day, least(count(*), 25) AS n FROM ev WHERE day = '2024-01-05' GROUP BY 1")
def partition_sample(spark, sf_dir):
    return text.partition_sample(_ev(spark, sf_dir), "2024-01-05", 25).groupBy("day").agg(F.count(F.lit(1)).alias("n"))


# ---- history windows

_D = ("all", "1", "3", "7", "15", "30")


def _window_sql(agg: Callable[[str], str]) -> str:
    return ", ".join(agg(d) for d in _D)


def _age(d: str) -> str:
    return "true" if d == "all" else f"age <= {d} * 86400"


@query("SELECT ev.sample_id, " + _window_sql(lambda d: f"count(age) FILTER (WHERE {_age(d)}) AS cnt_{d}, round(coalesce(avg(h_rating) FILTER (WHERE {_age(d)}), 3.0), 6) AS avg_{d}, round(coalesce(stddev_pop(h_rating) FILTER (WHERE {_age(d)}), 0.0), 6) AS std_{d}") + " FROM ev LEFT JOIN hist USING (sample_id) GROUP BY 1")
def user_window_stats(spark, sf_dir):
    return _rounded_stats(windows.snapshot_stats(_history(spark, sf_dir)))


AS_OF = "SELECT sample_id, " + _window_sql(lambda d: (lambda w: f"count(*) OVER ({w}) AS cnt_{d}, round(coalesce(avg(rating) OVER ({w}), 3.0), 6) AS avg_{d}, round(coalesce(stddev_pop(rating) OVER ({w}), 0.0), 6) AS std_{d}")(
    f"PARTITION BY user_id ORDER BY time_stamp RANGE BETWEEN {'UNBOUNDED' if d == 'all' else int(d) * 86400} PRECEDING AND 1 PRECEDING")) + " FROM ev"


def _rounded_stats(s: DataFrame) -> DataFrame:
    return s.select("sample_id", *[c for d in _D for c in (F.col(f"cnt_{d}"), F.round(f"avg_{d}", 6).alias(f"avg_{d}"), F.round(f"std_{d}", 6).alias(f"std_{d}"))])


@query(AS_OF)
def user_window_stats_asof(spark, sf_dir):
    return _rounded_stats(windows.as_of_stats(_ev(spark, sf_dir)))


@query(AS_OF)
def user_window_stats_sums(spark, sf_dir):
    """The same by differences of running sums: a user of any size is spread over tasks."""
    ev = _ev(spark, sf_dir)
    return _rounded_stats(point_in_time.stats_before(ev, ev))


@query("""SELECT sample_id, string_agg(h_item || ':' || h_rating, ',' ORDER BY r) AS ids, count(*) AS n, min(ts) AS first_ts FROM
(SELECT s.sample_id, h.item_id AS h_item, h.rating AS h_rating, h.time_stamp AS ts, row_number() OVER (PARTITION BY s.sample_id ORDER BY h.time_stamp DESC, h.item_id, h.rating DESC) AS r
 FROM ev s JOIN ev h ON s.user_id = h.user_id AND h.time_stamp < s.time_stamp) WHERE r <= 200 GROUP BY 1""")
def history_before(spark, sf_dir):
    """The user's last events before each sample, newest first."""
    h = point_in_time.sequences_before(_ev(spark, sf_dir), HISTORY).where(F.size("history") > 0)
    ids = F.concat_ws(",", F.transform("history", lambda x: F.concat_ws(":", x["item_id"], x["rating"].cast("string"))))
    return h.select("sample_id", ids.alias("ids"), F.size("history").cast("long").alias("n"), F.array_min(F.transform("history", lambda x: x["ts"])).alias("first_ts"))


@query("""WITH """ + COMMON + """, own AS (SELECT sample_id, user_id, time_stamp, unnest(list_distinct(genres)) AS genre FROM ev JOIN items USING (item_id)),
given AS (SELECT user_id, time_stamp, rating, unnest(list_distinct(genres)) AS genre FROM ev JOIN items USING (item_id)),
st AS (SELECT a.sample_id, a.genre, avg(b.rating) AS m, min(a.time_stamp - b.time_stamp) AS age FROM own a LEFT JOIN given b ON a.user_id = b.user_id AND a.genre = b.genre AND b.time_stamp < a.time_stamp GROUP BY 1, 2)
SELECT ev.sample_id, """ + ", ".join(f"CASE WHEN min(age) <= {d} * 86400 THEN 2 ELSE 1 END AS hit_{n}" for n, d in (("all", 9999), (1, 1), (3, 3), (7, 7), (15, 15))) + """, round(coalesce(avg(m), 3.0), 6) AS same_genre_rate FROM ev LEFT JOIN st USING (sample_id) GROUP BY 1""")
def same_genre_before(spark, sf_dir):
    ev = _ev(spark, sf_dir)
    out = point_in_time.same_genre_before(ev, ev, views.items(spark, sf_dir))
    return out.select("sample_id", *[f"hit_{d}" for d in ("all", 1, 3, 7, 15)], F.round("same_genre_rate", 6).alias("same_genre_rate"))


@query("SELECT sample_id, w AS days, string_agg(h_item || ':' || h_rating, ',' ORDER BY rk) AS ids FROM hist, (VALUES (1), (3), (7), (15), (9999)) v(w) WHERE age <= w * 86400 GROUP BY 1, 2")
def history_window_ids(spark, sf_dir):
    h = _history(spark, sf_dir)
    lists = [F.struct(F.lit(d or 9999).alias("days"), X.within(F.col("history"), F.col("time_stamp"), d).alias("h")) for d in (1, 3, 7, 15, None)]
    out = h.select("sample_id", F.explode(F.array(*lists)).alias("w")).where(F.size("w.h") > 0)
    return out.select("sample_id", "w.days", F.concat_ws(",", F.transform("w.h", lambda x: F.concat_ws(":", x["item_id"], x["rating"].cast("string")))).alias("ids"))


@query("SELECT sample_id, w AS days, string_agg(genres[1] || ':' || h_rating, ',' ORDER BY rk) AS genres FROM hist JOIN items ON h_item = items.item_id, (VALUES (1), (3), (7), (15), (9999)) v(w) WHERE age <= w * 86400 GROUP BY 1, 2")
def history_window_genres(spark, sf_dir):
    h = _history(spark, sf_dir)
    lists = [F.struct(F.lit(d or 9999).alias("days"), F.filter(X.within(F.col("history"), F.col("time_stamp"), d), lambda x: x["genres"].isNotNull()).alias("h")) for d in (1, 3, 7, 15, None)]
    out = h.select("sample_id", F.explode(F.array(*lists)).alias("w")).where(F.size("w.h") > 0)
    return out.select("sample_id", "w.days", F.concat_ws(",", F.transform("w.h", lambda x: F.concat_ws(":", F.get(x["genres"], F.lit(0)), x["rating"].cast("string")))).alias("genres"))


GENRES = "gh AS (SELECT sample_id, age, h_rating, unnest(genres) AS genre FROM hist JOIN items ON h_item = items.item_id)"


@query("WITH " + COMMON + "," + GENRES + " SELECT sample_id, genre, count(*) AS cnt_all, round(avg(h_rating), 6) AS avg_all, " + ", ".join(f"count(*) FILTER (WHERE age <= {d} * 86400) AS cnt_{d}, round(avg(h_rating) FILTER (WHERE age <= {d} * 86400), 6) AS avg_{d}" for d in (1, 3, 7, 15)) + " FROM gh GROUP BY 1, 2")
def genre_affinity(spark, sf_dir):
    g = windows.genre_affinity(_history(spark, sf_dir))
    return g.select("sample_id", "genre", *[c for d in ("all", 1, 3, 7, 15) for c in (F.col(f"cnt_{d}"), F.round(f"avg_{d}", 6).alias(f"avg_{d}"))])


@query("WITH " + COMMON + "," + GENRES + " SELECT sample_id, rank, genre, cnt FROM (SELECT sample_id, genre, count(*) AS cnt, row_number() OVER (PARTITION BY sample_id ORDER BY count(*) DESC, genre) AS rank FROM gh GROUP BY 1, 2) WHERE rank <= 3")
def top3_genres(spark, sf_dir):
    h = _history(spark, sf_dir).withColumn("t", X.top_genres(X.genre_counts(F.col("history"))))
    return h.select("sample_id", F.posexplode("t").alias("rank", "t")).select("sample_id", (F.col("rank") + 1).alias("rank"), "t.genre", "t.cnt")


@query("WITH " + COMMON + "," + GENRES + """ SELECT ev.sample_id, w AS days, CASE WHEN count(gh.genre) > 0 THEN 2 ELSE 1 END AS hit FROM ev CROSS JOIN (VALUES (1), (3), (7), (15), (9999)) v(w)
LEFT JOIN items ON items.item_id = ev.item_id LEFT JOIN gh ON gh.sample_id = ev.sample_id AND age <= w * 86400 AND list_contains(genres, gh.genre) GROUP BY 1, 2""")
def same_genre_hit(spark, sf_dir):
    h = _history(spark, sf_dir).join(views.items(spark, sf_dir).select("item_id", "genres"), "item_id", "left")
    own = F.coalesce("genres", F.array().cast("array<string>"))

    def hit(d):
        seen = F.flatten(F.transform(F.filter(X.within(F.col("history"), F.col("time_stamp"), d), lambda x: x["genres"].isNotNull()), lambda x: x["genres"]))
        return F.struct(F.lit(d or 9999).alias("days"), F.when(F.coalesce(F.arrays_overlap(own, seen), F.lit(False)), 2).otherwise(1).alias("hit"))

    return h.select("sample_id", F.explode(F.array(*[hit(d) for d in (1, 3, 7, 15, None)])).alias("x")).select("sample_id", "x.*")


@query("WITH " + COMMON + "," + GENRES + """, ga AS (SELECT sample_id, genre, avg(h_rating) AS a FROM gh GROUP BY 1, 2)
SELECT ev.sample_id, round(coalesce(avg(a), 3.0), 6) AS avg_rate, CASE WHEN coalesce(avg(a), 3.0) <= 1 THEN 1 WHEN coalesce(avg(a), 3.0) <= 2 THEN 2 WHEN coalesce(avg(a), 3.0) <= 3 THEN 3 WHEN coalesce(avg(a), 3.0) <= 4 THEN 4 ELSE 5 END AS bucket
FROM ev LEFT JOIN items USING (item_id) LEFT JOIN ga ON ga.sample_id = ev.sample_id AND list_contains(genres, ga.genre) GROUP BY 1""")
def same_genre_avg_rate(spark, sf_dir):
    h = _history(spark, sf_dir).join(views.items(spark, sf_dir).select("item_id", "genres"), "item_id", "left")
    m = X.same_genre_mean_of(F.col("history"), F.coalesce("genres", F.array().cast("array<string>")))
    return h.select("sample_id", m.alias("m")).select("sample_id", F.round("m", 6).alias("avg_rate"), X.genre_avg_bucket(F.col("m")).alias("bucket"))


@query("SELECT sample_id, (time_stamp // 3600) % 24 + 1 AS hour_fea, ((time_stamp // 3600) % 24) // 4 + 1 AS area_fea, isodow(make_timestamp(time_stamp * 1000000)) AS week_fea, CASE WHEN isodow(make_timestamp(time_stamp * 1000000)) >= 6 THEN 2 ELSE 1 END AS weekend_fea FROM ev")
def context_features(spark, sf_dir):
    t = F.col("time_stamp")
    return _ev(spark, sf_dir).select("sample_id", (X.hour_of(t) + 1).alias("hour_fea"), (F.floor(X.hour_of(t) / 4) + 1).alias("area_fea"), X.weekday_of(t).alias("week_fea"), F.when(X.weekday_of(t) >= 6, 2).otherwise(1).alias("weekend_fea"))


@query("SELECT item_id, pos - 1 AS pos, tok FROM (SELECT item_id, unnest(string_split(title, ' ')) AS tok, generate_subscripts(string_split(title, ' '), 1) AS pos FROM items)")
def title_tokens(spark, sf_dir):
    titled = views.items(spark, sf_dir).select("item_id", F.concat("title", F.lit(" (1995)")).alias("title"))
    return titled.select("item_id", F.posexplode(X.title_tokens(F.col("title"))).alias("pos", "tok"))


def _case(v: str, bounds: list[float]) -> str:
    return "CASE " + " ".join(f"WHEN {v} <= {b} THEN {i + 1}" for i, b in enumerate(bounds)) + f" ELSE {len(bounds) + 1} END"


@query("SELECT item_id, " + _case("rate_count", [0, 2, 5, 10, 20, 50, 100, 200, 500, 1000]) + " AS count_fea, " + _case("avg_rate", [0, 1, 2, 2.5, 3, 3.5, 4, 4.5]) + " AS avg_fea, CASE WHEN hot_rank <= 100 THEN 4 WHEN hot_rank <= 500 THEN 3 WHEN hot_rank <= 2000 THEN 2 ELSE 1 END AS hot_fea, least(genre_cnt, 3) AS genre_fea, 5 AS year_fea FROM stats")
def item_buckets(spark, sf_dir):
    s = sequences.item_stats(_ix(spark, sf_dir), views.items(spark, sf_dir))
    year = X.year_bucket(X.release_year(F.col("title")))
    return s.select("item_id", X.item_count_bucket(F.col("rate_count")).alias("count_fea"), X.item_avg_bucket(F.col("avg_rate")).alias("avg_fea"), X.hot_rank_bucket(F.col("hot_rank")).alias("hot_fea"), F.least("genre_cnt", F.lit(3)).alias("genre_fea"), year.alias("year_fea"))


@query("SELECT ev.sample_id, n AS active_days, " + _case("n", [0, 7, 30]) + " AS active_fea FROM ev JOIN (SELECT user_id, day, row_number() OVER (PARTITION BY user_id ORDER BY day) - 1 AS n FROM (SELECT DISTINCT user_id, day FROM ev)) d USING (user_id, day)")
def user_active_days(spark, sf_dir):
    return windows.active_days(_ev(spark, sf_dir)).select("sample_id", "active_days", X.active_day_bucket(F.col("active_days")).alias("active_fea"))


# ---- splits and sampling

U = "((('0x' || substr(md5(concat_ws('|', {})), 1, 8))::BIGINT + 0.5) / 4294967296.0)"


@query("SELECT sample_id, CASE WHEN i <= floor(n * 0.8) THEN 'train' WHEN i <= floor(n * 0.8) + floor(n * 0.1) THEN 'val' ELSE 'test' END AS split FROM (SELECT sample_id, row_number() OVER (ORDER BY time_stamp, sample_id) AS i, count(*) OVER () AS n FROM ev)")
def split_time_ratio(spark, sf_dir):
    return split.time_ratio_split(_ev(spark, sf_dir), [F.col("time_stamp"), F.col("sample_id")], 0.8, 0.1).select("sample_id", "split")


@query("SELECT sample_id, CASE r WHEN 1 THEN 'test' WHEN 2 THEN 'val' ELSE 'train' END AS split FROM (SELECT sample_id, row_number() OVER (PARTITION BY user_id ORDER BY time_stamp DESC, sample_id DESC) AS r FROM ev)")
def split_leave_one_out(spark, sf_dir):
    return split.leave_one_out_split(_ev(spark, sf_dir), "user_id", [F.col("time_stamp").desc(), F.col("sample_id").desc()]).select("sample_id", "split")


@query("SELECT user_id, item_id, rating, time_stamp, row_number() OVER (ORDER BY time_stamp, user_id, item_id, rating) - 1 AS idx FROM ix")
def global_index_by_time(spark, sf_dir):
    return global_index(_ix(spark, sf_dir), [F.col(c) for c in ("time_stamp", "user_id", "item_id", "rating")]).drop("day")


@query("SELECT sample_id, CASE WHEN rating >= 4 THEN 1 ELSE 0 END AS label FROM ev WHERE rating >= 4 OR " + U.format("'42', sample_id::VARCHAR") + " < 0.3")
def downsample_negatives(spark, sf_dir):
    return split.downsample_negatives(clean.labelled(_ev(spark, sf_dir)), 0.3, F.col("sample_id")).select("sample_id", "label")


POOL = """pool AS (SELECT item_id AS cand, count(DISTINCT user_id) AS pop FROM ev GROUP BY 1),
pos AS (SELECT DISTINCT user_id, item_id FROM ev WHERE rating = 5),
cands AS (SELECT p.user_id, p.item_id, cand, pop FROM pos p CROSS JOIN pool WHERE cand <> p.item_id AND NOT EXISTS (SELECT 1 FROM ev e WHERE e.user_id = p.user_id AND e.item_id = cand)),
uni AS (SELECT *, row_number() OVER (PARTITION BY user_id, item_id ORDER BY round({u}, 9), cand) AS rk FROM cands),
uni1 AS (SELECT *, row_number() OVER (PARTITION BY user_id, item_id ORDER BY round({u1}, 9), cand) AS rk FROM cands),
pop AS (SELECT *, row_number() OVER (PARTITION BY user_id, item_id ORDER BY round(-ln({u}) / pow(pop, 0.75), 9), cand) AS rk FROM cands),
mix AS (SELECT user_id, item_id, cand, row_number() OVER (PARTITION BY user_id, item_id ORDER BY part, rk, cand) AS rk FROM (SELECT user_id, item_id, cand, part, rk FROM
  (SELECT *, row_number() OVER (PARTITION BY user_id, item_id, cand ORDER BY part, rk) AS d FROM (SELECT user_id, item_id, cand, 0 AS part, rk FROM pop WHERE rk <= 2 UNION ALL SELECT user_id, item_id, cand, 1, rk FROM uni1 WHERE rk <= 4)) WHERE d = 1))
""".format(u=U.format("'42', user_id, item_id, cand"), u1=U.format("'43', user_id, item_id, cand"))


def _negatives(spark, sf_dir, strategy):
    ev = _ev(spark, sf_dir)
    pool = sampling.popularity(ev)
    return sampling.sample_negatives(ev.where("rating = 5"), pool, ev, 4, strategy)


@query("WITH " + COMMON + "," + POOL + "SELECT user_id, item_id, cand, rk FROM uni WHERE rk <= 4")
def negatives_uniform(spark, sf_dir):
    return _negatives(spark, sf_dir, "uniform")


@query("WITH " + COMMON + "," + POOL + "SELECT user_id, item_id, cand, rk FROM pop WHERE rk <= 4")
def negatives_popular(spark, sf_dir):
    return _negatives(spark, sf_dir, "popular")


@query("WITH " + COMMON + "," + POOL + "SELECT user_id, item_id, cand, rk FROM mix WHERE rk <= 4")
def negatives_mixed(spark, sf_dir):
    return _negatives(spark, sf_dir, "mixed")


@query("WITH " + COMMON + "," + POOL + """SELECT user_id, item_id, 5 AS rating, 1 AS label, count(*) AS n FROM ev WHERE rating = 5 GROUP BY 1, 2
UNION ALL SELECT u.user_id, cand, 0, 0, count(*) FROM uni u JOIN ev e ON e.user_id = u.user_id AND e.item_id = u.item_id AND e.rating = 5 WHERE rk <= 4 GROUP BY 1, 2""")
def labelled_samples(spark, sf_dir):
    pos = _ev(spark, sf_dir).where("rating = 5")
    out = sampling.with_negatives(pos, _negatives(spark, sf_dir, "uniform"))
    return out.groupBy("user_id", "item_id", "rating", "label").agg(F.count(F.lit(1)).alias("n"))


@query("WITH " + COMMON + "," + POOL + "SELECT user_id, item_id, least(count(*), 4) AS n, 0 AS seen FROM cands GROUP BY 1, 2")
def negatives_drawn(spark, sf_dir):
    """Negatives by drawing: as many as there can be, none of them seen."""
    ev = _ev(spark, sf_dir)
    got = sampling.drawn(ev.where("rating = 5"), sampling.popularity(ev), ev, 4)
    seen = ev.select("user_id", F.col("item_id").alias("cand")).distinct().withColumn("seen", F.lit(1))
    return got.join(seen, ["user_id", "cand"], "left").groupBy("user_id", "item_id").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("seen"), F.lit(0)).alias("seen"))


@query("WITH RECURSIVE " + COMMON + """, line AS (SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS number FROM (SELECT DISTINCT item_id FROM ev)),
pos AS (SELECT DISTINCT user_id, item_id FROM ev WHERE rating = 5),
unseen AS (SELECT user_id, line.item_id, row_number() OVER (PARTITION BY user_id ORDER BY number) - 1 AS place FROM (SELECT DISTINCT user_id FROM pos) u CROSS JOIN line
  WHERE NOT EXISTS (SELECT 1 FROM ev e WHERE e.user_id = u.user_id AND e.item_id = line.item_id)),
n AS (SELECT user_id, count(*) AS n FROM unseen GROUP BY 1),
draws AS (SELECT user_id, item_id, n, 0::BIGINT AS d, []::BIGINT[] AS got FROM pos JOIN n USING (user_id)
  UNION ALL SELECT user_id, item_id, n, d + 1, list_append(got, list_reduce(list_prepend(('0x' || substr(md5(concat_ws('|', '42', 'uniform', user_id, item_id, d + 1)), 1, 15))::BIGINT % (n - d), list_sort(got)),
    lambda p, g: p + CASE WHEN g <= p THEN 1 ELSE 0 END)) FROM draws WHERE d < 4 AND d < n),
flat AS (SELECT user_id, item_id, unnest(got) AS place, unnest(range(1, len(got) + 1)) AS rk FROM draws WHERE d = least(4, n))
SELECT f.user_id, f.item_id, u.item_id AS cand, rk::INT AS rk FROM flat f JOIN unseen u ON u.user_id = f.user_id AND u.place = f.place""")
def negatives_selected(spark, sf_dir):
    """Negatives by uniform selection among what a user hasn't seen."""
    ev = _ev(spark, sf_dir)
    return sampling.drawn(ev.where("rating = 5"), sampling.popularity(ev), ev, 4)


@query("WITH " + COMMON + "," + POOL + "SELECT user_id, item_id, least(count(*), 4) AS n, 0 AS seen, least(count(*), 4) AS different FROM cands GROUP BY 1, 2")
def negatives_selected_mixed(spark, sf_dir):
    """Negatives by selection, half by popularity: as many as there can be, all different, none of them seen."""
    ev = _ev(spark, sf_dir)
    got = sampling.drawn(ev.where("rating = 5"), sampling.popularity(ev), ev, 4, "mixed")
    seen = ev.select("user_id", F.col("item_id").alias("cand")).distinct().withColumn("seen", F.lit(1))
    per = got.join(seen, ["user_id", "cand"], "left").groupBy("user_id", "item_id")
    return per.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("seen"), F.lit(0)).alias("seen"), F.count_distinct("cand").alias("different"))


# ---- registry, tokens, vocabulary

TOKENS = ["user_id", "movie_id", "movie_genres", "context_time_hour", "context_time_week", "context_is_weekend", "user_rate_avg", "user_rate_avg_continue", "user_movie_rate_cnt", "user_movie_rate_cnt_continue", "user_movie_rate_ids", "user_movie_rate_genres"]

TOKENS_SQL = "WITH " + COMMON + "," + GENRES + """,
hs AS (SELECT ev.sample_id, count(age) AS n, coalesce(avg(h_rating), 3.0) AS a FROM ev LEFT JOIN hist USING (sample_id) GROUP BY 1),
tokens AS (
  SELECT sample_id, 'user_id' AS field_name, 1 AS field_index, 1 AS field_type, 0 AS ord, user_id AS key, 1.0 AS value FROM ev WHERE user_id <> '0'
  UNION ALL SELECT sample_id, 'movie_id', 101, 1, 0, item_id, 1.0 FROM ev WHERE item_id <> '0'
  UNION ALL SELECT sample_id, 'movie_genres', 103, 1, unnest(range(len(genres))), unnest(list_transform(genres, lambda x: lower(x))), 1.0 FROM ev JOIN items USING (item_id)
  UNION ALL SELECT sample_id, 'context_time_hour', 201, 1, 0, ((time_stamp // 3600) % 24 + 1)::VARCHAR, 1.0 FROM ev
  UNION ALL SELECT sample_id, 'context_time_week', 203, 1, 0, isodow(make_timestamp(time_stamp * 1000000))::VARCHAR, 1.0 FROM ev
  UNION ALL SELECT sample_id, 'context_is_weekend', 204, 1, 0, CASE WHEN isodow(make_timestamp(time_stamp * 1000000)) >= 6 THEN '2' ELSE '1' END, 1.0 FROM ev
  UNION ALL SELECT sample_id, 'user_rate_avg', 14, 1, 0, CASE WHEN a = 0 THEN '1' WHEN a < 3 THEN '2' WHEN a < 4 THEN '3' ELSE '4' END, 1.0 FROM hs
  UNION ALL SELECT sample_id, 'user_rate_avg_continue', 18, 0, 0, '1', a FROM hs
  UNION ALL SELECT sample_id, 'user_movie_rate_cnt', 22, 1, 0, CASE WHEN n <= 0 THEN '1' WHEN n <= 10 THEN '2' WHEN n <= 30 THEN '3' WHEN n <= 50 THEN '4' WHEN n <= 100 THEN '5' ELSE '6' END, 1.0 FROM hs
  UNION ALL SELECT sample_id, 'user_movie_rate_cnt_continue', 26, 0, 0, '1', n FROM hs
  UNION ALL SELECT sample_id, 'user_movie_rate_ids', 101, 1, row_number() OVER (PARTITION BY sample_id ORDER BY rk) - 1, h_item, h_rating FROM hist WHERE h_item <> '0'
  UNION ALL SELECT sample_id, 'user_movie_rate_genres', 103, 1, row_number() OVER (PARTITION BY sample_id ORDER BY rk) - 1, genres[1], h_rating FROM hist JOIN items ON items.item_id = h_item),
vstats AS (SELECT field_name, field_index, field_type, key, count(*) AS cnt, sum(value) AS "sum", sum(value * value) AS sum_sq, avg(value) AS mean, var_pop(value) * count(*) AS m2 FROM tokens GROUP BY 1, 2, 3, 4),
passed AS (SELECT field_index, field_type, key, sum(cnt)::BIGINT AS cnt FROM vstats WHERE cnt >= 3 GROUP BY 1, 2, 3),
pos_map AS (SELECT field_index, field_type, key, cnt, CASE WHEN field_type = 0 THEN 1 ELSE row_number() OVER (PARTITION BY field_index, field_type ORDER BY cnt DESC, key) END AS pos FROM passed)
"""


def _registry(spark, sf_dir, only: list[str] | None = TOKENS) -> Registry:
    """The features, whose histories come to rows of ``_samples`` where features are made."""
    seqs = training.histories(_ev(spark, sf_dir).drop("sample_id"), views.items(spark, sf_dir), HISTORY)
    return training.reading_histories(training.default_registry(only), written(seqs, "histories"), HISTORY)


def _samples(spark, sf_dir) -> DataFrame:
    return training.plain_samples(_ev(spark, sf_dir), views.items(spark, sf_dir), views.users(spark, sf_dir))


def _stats(spark, sf_dir) -> DataFrame:
    return vocab.feature_stats(_registry(spark, sf_dir), _samples(spark, sf_dir))


def _tokens(spark, sf_dir) -> DataFrame:
    return _registry(spark, sf_dir).tokens(_samples(spark, sf_dir))


@query(TOKENS_SQL + "SELECT sample_id, field_name, field_index, field_type, ord, key, round(value, 6) AS value FROM tokens")
def feature_tokens(spark, sf_dir):
    return _tokens(spark, sf_dir).select("sample_id", "field_name", "field_index", "field_type", "ord", "key", F.round("value", 6).alias("value"))


@query(TOKENS_SQL + "SELECT field_name, field_index, field_type, key, cnt, round(\"sum\", 4) AS \"sum\", round(sum_sq, 4) AS sum_sq, round(mean, 6) AS mean, round(sqrt(greatest(m2 / cnt, 0) + 1e-6), 6) AS std FROM vstats")
def feature_value_stats(spark, sf_dir):
    s = _stats(spark, sf_dir)
    return s.select("field_name", "field_index", "field_type", "key", "cnt", F.round("sum", 4).alias("sum"), F.round("sum_sq", 4).alias("sum_sq"), F.round("mean", 6).alias("mean"), F.round(vocab.std(F.col("m2"), F.col("cnt")), 6).alias("std"))


def _row(name: str, index: int, key: str, source: str, value: str = "1.0", kind: int = 1) -> str:
    return f"SELECT '{name}' AS field_name, {index} AS field_index, {kind} AS field_type, ({key})::VARCHAR AS key, ({value})::DOUBLE AS value FROM {source}"


def _all_features_sql() -> str:
    """Every default feature from its definition: profile, item, context, and the histories' windows."""
    std = "greatest(n * q - t * t, 0)"  # the variance times n * n, in whole numbers
    rows = [
        _row("user_id", 1, "user_id", "b WHERE user_id <> '0'"), _row("user_age", 2, "uage", "b WHERE uage <> '0'"),
        _row("user_gender", 3, "CASE gender WHEN 'M' THEN 1 ELSE 2 END", "b WHERE gender IS NOT NULL"), _row("user_occupation", 4, "occupation", "b WHERE occupation <> '0'"),
        _row("movie_id", 101, "item_id", "b WHERE item_id <> '0'"), _row("movie_title", 102, "unnest(string_split(title, ' '))", "b"), _row("movie_genres", 103, "unnest(list_transform(genres, lambda x: lower(x)))", "b"),
        _row("movie_rate_count", 104, _case("rate_count", [0, 2, 5, 10, 20, 50, 100, 200, 500, 1000]), "b"), _row("movie_rate_avg", 105, _case("avg_rate", [0, 1, 2, 2.5, 3, 3.5, 4, 4.5]), "b"),
        _row("movie_genre_cnt", 106, "least(len(genres), 3)", "b"), _row("item_hot_rank", 107, "CASE WHEN hot_rank <= 100 THEN 4 WHEN hot_rank <= 500 THEN 3 WHEN hot_rank <= 2000 THEN 2 ELSE 1 END", "b"),
        _row("movie_publish_year", 108, "5", "b"), _row("movie_rate_avg_continue", 109, "1", "b", "avg_rate", 0),
        _row("context_time_hour", 201, "(time_stamp // 3600) % 24 + 1", "b"), _row("context_time_area", 202, "((time_stamp // 3600) % 24) // 4 + 1", "b"),
        _row("context_time_week", 203, "isodow(make_timestamp(time_stamp * 1000000))", "b"), _row("context_is_weekend", 204, "CASE WHEN isodow(make_timestamp(time_stamp * 1000000)) >= 6 THEN 2 ELSE 1 END", "b"),
        _row("user_top3_genres", 103, "genre", "(SELECT genre, c, row_number() OVER (PARTITION BY sample_id ORDER BY c DESC, genre) AS r FROM g WHERE w = 9999) WHERE r <= 3", "c"),
        _row("user_same_genre_avg_rate", 356, _case("m", [1, 2, 3, 4]), "same"), _row("user_same_genre_avg_rate_continue", 357, "1", "same", "m", 0),
    ]
    for k, d in enumerate((9999, 7, 15, 30)):
        tag, of = "" if d == 9999 else f"_{d}day", f"st WHERE w = {d}"
        mean = "coalesce(t / n, 3.0)"
        rows += [
            _row(f"user_rate_std{tag}", 6 + k, f"CASE WHEN n = 0 OR {std} = 0 THEN 1 WHEN {std} <= n * n THEN 2 WHEN {std} <= 4 * n * n THEN 3 ELSE 4 END", of),
            _row(f"user_rate_std{tag}_continue", 10 + k, "1", of, f"CASE WHEN n = 0 THEN 0 ELSE sqrt({std}) / n END", 0),
            _row(f"user_rate_avg{tag}", 14 + k, f"CASE WHEN {mean} = 0 THEN 1 WHEN {mean} < 3 THEN 2 WHEN {mean} < 4 THEN 3 ELSE 4 END", of),
            _row(f"user_rate_avg{tag}_continue", 18 + k, "1", of, mean, 0),
            _row(f"user_movie_rate{tag}_cnt", 22 + k, _case("n", [0, 10, 30, 50, 100]), of),
            _row(f"user_movie_rate{tag}_cnt_continue", 26 + k, "1", of, "n", 0),
        ]
    for k, d in enumerate((9999, 1, 3, 7, 15)):
        one, many, age = ("", "", "true") if d == 9999 else (f"_{d}day", f"_{d}days", f"age <= {d} * 86400")
        rows += [
            _row("user_movie_rate_ids" if not many else f"user_movie_rate_id{many}", 101, "h_item", f"hist WHERE h_item <> '0' AND {age}", "h_rating"),
            _row("user_movie_rate_genres" if not many else f"user_movie_rate_genre{many}", 103, "genres[1]", f"hist JOIN items ON items.item_id = h_item WHERE {age}", "h_rating"),
            _row(f"user_genres_rate{one}", 103, "genre", f"g WHERE w = {d}", "a"),
            _row("user_genres_rate_cnts" if not many else f"user_genres_rate_cnt{many}", 103, "genre", f"g WHERE w = {d}", "c"),
            _row(f"user_watch_same_genre{one}", 351 + k, "CASE WHEN EXISTS (SELECT 1 FROM g WHERE g.sample_id = b.sample_id AND g.w = " + str(d) + " AND list_contains(b.genres, g.genre)) THEN 2 ELSE 1 END", "b"),
        ]
    days = "(VALUES (1), (3), (7), (15), (30), (9999)) v(w)"
    return f"""WITH {COMMON},{GENRES},
evcounts AS (SELECT item_id, count(DISTINCT user_id) AS rate_count, round(avg(rating), 2) AS avg_rate FROM ev GROUP BY 1),
evstats AS (SELECT item_id, title, genres, rate_count, avg_rate, row_number() OVER (ORDER BY rate_count DESC, item_id) AS hot_rank FROM evcounts JOIN items USING (item_id)),
b AS (SELECT ev.*, gender, users.age AS uage, occupation, title, genres, rate_count, avg_rate, hot_rank FROM ev LEFT JOIN users USING (user_id) LEFT JOIN evstats USING (item_id)),
st AS (SELECT ev.sample_id, w, count(h_rating) AS n, sum(h_rating) AS t, sum(h_rating * h_rating) AS q FROM ev CROSS JOIN {days} LEFT JOIN hist ON hist.sample_id = ev.sample_id AND hist.age <= w * 86400 GROUP BY 1, 2),
g AS (SELECT sample_id, w, genre, count(*) AS c, avg(h_rating) AS a FROM gh CROSS JOIN {days} WHERE gh.age <= w * 86400 GROUP BY 1, 2, 3),
same AS (SELECT b.sample_id, coalesce(avg(a), 3.0) AS m FROM b LEFT JOIN g ON g.sample_id = b.sample_id AND w = 9999 AND list_contains(genres, genre) GROUP BY 1),
tok AS ({" UNION ALL ".join(rows)})
SELECT field_name, field_index, field_type, key, count(*) AS cnt, round(sum(value), 3) AS "sum" FROM tok GROUP BY 1, 2, 3, 4"""


@query(_all_features_sql())
def feature_value_stats_all(spark, sf_dir):
    """Values of all default features, from samples with profile, item statistics and history."""
    return vocab.feature_stats(_registry(spark, sf_dir, None), _samples(spark, sf_dir)).select("field_name", "field_index", "field_type", "key", "cnt", F.round("sum", 3).alias("sum"))


@query(TOKENS_SQL + "SELECT field_index, field_type, key, pos, cnt FROM pos_map")
def pos_map(spark, sf_dir):
    return vocab.build_pos_map(_stats(spark, sf_dir), 3).select("field_index", "field_type", "key", "pos", "cnt")


@query(TOKENS_SQL + "SELECT field_index, key, pos, cnt, n_names FROM pos_map JOIN (SELECT field_index, key, count(*) AS n_names FROM vstats WHERE cnt >= 3 GROUP BY 1, 2) USING (field_index, key) WHERE n_names > 1")
def pos_map_shared(spark, sf_dir):
    s = written(_stats(spark, sf_dir), "stats")
    names = s.where("cnt >= 3").groupBy("field_index", "key").agg(F.count(F.lit(1)).alias("n_names")).where("n_names > 1")
    return vocab.build_pos_map(s, 3).join(names, ["field_index", "key"]).select("field_index", "key", "pos", "cnt", "n_names")


@query(TOKENS_SQL + "SELECT field_name, field_index, field_type, coalesce(max(pos) + 1, 1) AS dim FROM (SELECT DISTINCT field_name, field_index, field_type FROM tokens) LEFT JOIN pos_map USING (field_index, field_type) GROUP BY 1, 2, 3")
def pos_dim(spark, sf_dir):
    s = written(_stats(spark, sf_dir), "stats")
    return vocab.pos_dim(vocab.build_pos_map(s, 3), s.select("field_name", "field_index", "field_type").distinct())


INCREMENTAL = """,
s1 AS (SELECT field_index, field_type, key, sum(c) AS cnt FROM (SELECT field_name, field_index, field_type, key, count(*) AS c FROM tokens WHERE sample_id % 2 = 0 GROUP BY 1, 2, 3, 4) WHERE c >= 3 GROUP BY 1, 2, 3),
m1 AS (SELECT *, CASE WHEN field_type = 0 THEN 1 ELSE row_number() OVER (PARTITION BY field_index, field_type ORDER BY cnt DESC, key) END AS pos FROM s1),
n2 AS (SELECT field_name, field_index, field_type, key, count(*) AS c FROM tokens WHERE sample_id % 2 = 1 GROUP BY 1, 2, 3, 4),
all2 AS (SELECT field_index, field_type, key, sum(c) AS cnt FROM n2 GROUP BY 1, 2, 3),
new2 AS (SELECT field_index, field_type, key, sum(c) AS cnt FROM n2 WHERE c >= 3 GROUP BY 1, 2, 3),
fresh AS (SELECT n.*, row_number() OVER (PARTITION BY n.field_index, n.field_type ORDER BY n.cnt DESC, n.key) AS i FROM new2 n WHERE NOT EXISTS (SELECT 1 FROM m1 WHERE m1.field_index = n.field_index AND m1.field_type = n.field_type AND m1.key = n.key))
SELECT m1.field_index, m1.field_type, m1.key, m1.pos, (m1.cnt + coalesce(a.cnt, 0))::BIGINT AS cnt FROM m1 LEFT JOIN all2 a USING (field_index, field_type, key)
UNION ALL SELECT f.field_index, f.field_type, f.key, CASE WHEN f.field_type = 0 THEN 1 ELSE f.i + coalesce((SELECT max(pos) FROM m1 WHERE m1.field_index = f.field_index AND m1.field_type = f.field_type), 0) END, f.cnt::BIGINT FROM fresh f
"""


@query(TOKENS_SQL + INCREMENTAL)
def pos_map_incremental(spark, sf_dir):
    r, rows = _registry(spark, sf_dir), _samples(spark, sf_dir)
    first = written(vocab.build_pos_map(vocab.feature_stats(r, rows.where("sample_id % 2 = 0")), 3), "positions")
    later = written(vocab.feature_stats(r, rows.where("sample_id % 2 = 1")), "stats")
    return vocab.build_pos_map(later, 3, first).select("field_index", "field_type", "key", "pos", "cnt")


@query(TOKENS_SQL + INCREMENTAL)
def pos_map_bucketed(spark, sf_dir):
    """The same from a vocabulary kept in buckets, which isn't shuffled."""
    r, rows = _registry(spark, sf_dir), _samples(spark, sf_dir)
    name, path = f"vocabulary_{uuid.uuid4().hex}", new_path(spark, "vocabulary")
    first = sinks.save_vocabulary(vocab.build_pos_map(vocab.feature_stats(r, rows.where("sample_id % 2 = 0")), 3), name, path)
    later = written(vocab.feature_stats(r, rows.where("sample_id % 2 = 1")), "stats")
    return vocab.build_pos_map(later, 3, first).select("field_index", "field_type", "key", "pos", "cnt")


@query(TOKENS_SQL + "SELECT field_index, field_type, key, pos, cnt FROM pos_map")
def vocab_json_roundtrip(spark, sf_dir):
    """The vocabulary written as JSON, a text a field, and restored."""
    made = sinks.vocabulary_json(vocab.build_pos_map(_stats(spark, sf_dir), 3))
    return sinks.vocabulary_from_json(written(made, "vocabulary")).select("field_index", "field_type", "key", "pos", "cnt")


@query(TOKENS_SQL + """, pooled AS (SELECT field_index, field_type, key, sum(cnt) AS cnt, sum("sum") AS s, sum(sum_sq) AS q FROM vstats WHERE cnt >= 3 GROUP BY 1, 2, 3)
SELECT field_index, field_type, key, pos, CASE field_type WHEN 1 THEN 0 ELSE round(s / p.cnt, 4) END AS mean, CASE field_type WHEN 1 THEN 1 ELSE round(sqrt(greatest(q / p.cnt - (s / p.cnt) * (s / p.cnt), 0) + 1e-6), 4) END AS std FROM pooled p JOIN pos_map USING (field_index, field_type, key)""")
def vocab_exported(spark, sf_dir):
    out = vocab.exported(vocab.build_pos_map(_stats(spark, sf_dir), 3))
    return out.withColumns({"mean": F.round("mean", 4), "std": F.round("std", 4)})


@query(TOKENS_SQL + """SELECT count(*) AS total, count(*) FILTER (WHERE NOT k AND cnt >= 3) AS "new", count(*) FILTER (WHERE k) AS existing, count(*) FILTER (WHERE NOT k AND cnt < 3) AS below, sum(cnt)::BIGINT AS occurrences
FROM (SELECT v.*, p.key IS NOT NULL AS k FROM vstats v LEFT JOIN (SELECT * FROM pos_map WHERE pos <= 10) p USING (field_index, field_type, key))""")
def vocab_report(spark, sf_dir):
    s = written(_stats(spark, sf_dir), "stats")
    return vocab.build_report(s, 3, vocab.build_pos_map(s, 3).where("pos <= 10"))


@query("SELECT item_id::INT AS target, row_number() OVER (ORDER BY count(*) DESC, item_id::INT) - 1 AS idx, count(*) AS cnt FROM ev GROUP BY item_id HAVING count(*) >= 100")
def target_map(spark, sf_dir):
    return vocab.build_target_map(_ev(spark, sf_dir).select(clean.target("multi").alias("target")), 100)


@query("""SELECT t AS target, i AS idx, c1 + coalesce(c2, 0) AS cnt FROM (SELECT item_id::INT AS t, count(*) AS c1, row_number() OVER (ORDER BY count(*) DESC, item_id::INT) - 1 AS i FROM ev WHERE sample_id % 2 = 0 GROUP BY item_id HAVING count(*) >= 52)
LEFT JOIN (SELECT item_id::INT AS t, count(*) AS c2 FROM ev WHERE sample_id % 2 = 1 GROUP BY 1) USING (t)
UNION ALL SELECT t, row_number() OVER (ORDER BY c DESC, t) - 1 + (SELECT count(*) FROM (SELECT item_id FROM ev WHERE sample_id % 2 = 0 GROUP BY item_id HAVING count(*) >= 52)), c FROM (SELECT item_id::INT AS t, count(*) AS c FROM ev WHERE sample_id % 2 = 1 GROUP BY 1) WHERE c >= 52 AND t NOT IN (SELECT item_id::INT FROM ev WHERE sample_id % 2 = 0 GROUP BY item_id HAVING count(*) >= 52)""")
def target_map_incremental(spark, sf_dir):
    ev = _ev(spark, sf_dir).withColumn("target", clean.target("multi"))
    first = written(vocab.build_target_map(ev.where("sample_id % 2 = 0").select("target"), 52), "targets")
    return vocab.build_target_map(ev.where("sample_id % 2 = 1").select("target"), 52, first)


@query(TOKENS_SQL + "SELECT a.sample_id, '203:' || a.key || '__xx__' || '14:' || b.key || '__xx__' || '22:' || c.key AS key FROM tokens a JOIN tokens b ON a.sample_id = b.sample_id AND b.field_name = 'user_rate_avg' JOIN tokens c ON c.sample_id = a.sample_id AND c.field_name = 'user_movie_rate_cnt' WHERE a.field_name = 'context_time_week' UNION ALL SELECT a.sample_id, '103:' || a.key || '__xx__204:' || b.key FROM tokens a JOIN tokens b USING (sample_id) WHERE a.field_name = 'movie_genres' AND b.field_name = 'context_is_weekend'")
def cross_tokens(spark, sf_dir):
    r = _registry(spark, sf_dir)
    r.cross("week_xx_avg_xx_cnt", 460, ["context_time_week", "user_rate_avg", "user_movie_rate_cnt"], True)
    r.cross("movie_genres_xx_is_weekend", 450, ["movie_genres", "context_is_weekend"], True)
    r.cross("skipped", 451, ["movie_genres", "absent"], True)
    return r.tokens(_samples(spark, sf_dir), only=[f.name for f in r.features if f.depends]).where("field_index in (450, 460)").select("sample_id", "key")


@query(TOKENS_SQL + "SELECT cnt, n_keys, round(n_keys / sum(n_keys) OVER (), 6) AS share, round(sum(n_keys) OVER (ORDER BY cnt) / sum(n_keys) OVER (), 6) AS cum_share FROM (SELECT cnt, count(*) AS n_keys FROM pos_map GROUP BY 1)")
def vocab_frequency_hist(spark, sf_dir):
    return vocab.frequency_histogram(vocab.build_pos_map(_stats(spark, sf_dir), 3))


@query(TOKENS_SQL + "SELECT count(*) AS n_keys, min(cnt) AS min_cnt, max(cnt) AS max_cnt, round(avg(cnt), 4) AS mean_cnt, quantile_cont(cnt, 0.5) AS median_cnt, count(*) FILTER (WHERE cnt = 1) AS singletons FROM pos_map")
def vocab_frequency_summary(spark, sf_dir):
    return vocab.frequency_summary(vocab.build_pos_map(_stats(spark, sf_dir), 3)).withColumn("mean_cnt", F.round("mean_cnt", 4))


@query()
def hash_index(spark, sf_dir):
    return encode.hashed_keys(_tokens(spark, sf_dir).where("field_type = 1"))


# ---- encoding, sinks, records


def _encoded_rows(spark, sf_dir, **how) -> DataFrame:
    rows, r = written(_samples(spark, sf_dir), "samples"), _registry(spark, sf_dir)
    pos = written(vocab.build_pos_map(vocab.feature_stats(r, rows), 3), "positions")
    return encode.encode_rows(rows, pos, r, **how)


@query(TOKENS_SQL + """SELECT sample_id, field_name, string_agg(pos::VARCHAR, ',' ORDER BY ord) AS indexes, string_agg((round(v)::INT)::VARCHAR, ',' ORDER BY ord) AS vals FROM
(SELECT sample_id, field_name, 1.0 AS v, -1 AS ord, 0 AS pos FROM (SELECT DISTINCT sample_id FROM tokens), (SELECT DISTINCT field_name FROM tokens) UNION ALL
 SELECT t.sample_id, t.field_name, 1.0 * t.value, t.ord, CASE WHEN t.field_type = 0 THEN 1 ELSE p.pos END FROM tokens t LEFT JOIN pos_map p USING (field_index, field_type, key) WHERE t.field_type = 0 OR p.pos IS NOT NULL) WHERE field_name NOT LIKE '%continue' GROUP BY 1, 2""")
def encode_vocab(spark, sf_dir):
    e = _encoded_rows(spark, sf_dir)
    names = [n for n in TOKENS if not n.endswith("continue")]
    lists = [F.struct(F.lit(n).alias("field_name"), F.col(f"{n}_index").alias("i"), F.col(f"{n}_value").alias("v")) for n in names]
    one = e.select("sample_id", F.explode(F.array(*lists)).alias("f"))
    return one.select("sample_id", "f.field_name", F.concat_ws(",", F.transform("f.i", lambda x: x.cast("string"))).alias("indexes"), F.concat_ws(",", F.transform("f.v", lambda x: x.cast("int").cast("string"))).alias("vals"))


ENCODED_SQL = """, known AS (SELECT t.sample_id, t.field_name, t.ord, t.key, t.value, CASE WHEN t.field_type = 0 THEN 1 ELSE p.pos END AS pos FROM tokens t LEFT JOIN pos_map p USING (field_index, field_type, key) WHERE t.field_type = 0 OR p.pos IS NOT NULL),
listed AS (SELECT sample_id, field_name, string_agg(key, '|' ORDER BY ord) AS raws, string_agg(pos::VARCHAR, '|' ORDER BY ord) AS indexes, string_agg((round(1.0 * value, 3)::DECIMAL(12,3))::VARCHAR, '|' ORDER BY ord) AS vals FROM known GROUP BY 1, 2)
SELECT s.sample_id, f.field_name, concat_ws('|', 'R:', raws) AS raws, concat_ws('|', '0', indexes) AS indexes, concat_ws('|', '1.000', vals) AS vals, EXISTS (SELECT 1 FROM known k WHERE k.sample_id = s.sample_id) AS has_feature
FROM (SELECT DISTINCT sample_id FROM ev) s CROSS JOIN (SELECT DISTINCT field_name FROM tokens) f LEFT JOIN listed l ON l.sample_id = s.sample_id AND l.field_name = f.field_name"""


def _encoded_flat(e: DataFrame) -> DataFrame:
    """A row for each sample and field, its three arrays as text."""
    texts = {"raws": lambda n: F.col(f"{n}_raw"), "indexes": lambda n: F.transform(f"{n}_index", lambda x: x.cast("string")), "vals": lambda n: F.transform(f"{n}_value", lambda x: F.round(x.cast("double"), 3).cast("decimal(12,3)").cast("string"))}
    lists = [F.struct(F.lit(n).alias("field_name"), *[F.array_join(f(n), "|").alias(t) for t, f in texts.items()]) for n in TOKENS]
    return e.select("sample_id", "has_feature", F.explode(F.array(*lists)).alias("f")).select("sample_id", "f.*", "has_feature")


@query(TOKENS_SQL + ENCODED_SQL)
def encode_rows(spark, sf_dir):
    """Raw, index and value arrays of categorical and continuous fields, and whether a row has any value."""
    return _encoded_flat(_encoded_rows(spark, sf_dir))


@query(TOKENS_SQL + ENCODED_SQL)
def encode_rows_rare(spark, sf_dir):
    """The same where only the 50 most frequent values are looked up in place and all others by a join."""
    return _encoded_flat(_encoded_rows(spark, sf_dir, near_values=50))


@query()
def encode_hash_only(spark, sf_dir):
    r = _registry(spark, sf_dir, ["user_id", "movie_genres", "context_time_hour", "user_rate_avg_continue"])
    return encode.encode_hash(r.tokens(_samples(spark, sf_dir)), r)


@query(TOKENS_SQL + "SELECT sample_id, field_name, field_name || ':' || string_agg(pos::VARCHAR, ',' ORDER BY ord) AS text FROM tokens JOIN pos_map USING (field_index, field_type, key) WHERE field_type = 1 GROUP BY 1, 2")
def encode_text(spark, sf_dir):
    return encode.encoded_text(_encoded_rows(spark, sf_dir), training.default_registry(TOKENS))


@query("SELECT sample_id, idx AS target, CASE WHEN rating >= 4 THEN 1 ELSE 0 END AS label, rating FROM ev JOIN (SELECT item_id AS i, row_number() OVER (ORDER BY count(*) DESC, item_id::INT) - 1 AS idx FROM ev GROUP BY item_id HAVING count(*) >= 100) ON i = item_id")
def encoded_targets(spark, sf_dir):
    ev = clean.labelled(_ev(spark, sf_dir)).withColumn("target", clean.target("multi"))
    return encode.with_targets(ev, vocab.build_target_map(ev.select("target"), 100)).select("sample_id", "target", "label", "rating")


@query("SELECT p_partkey, p_name, p_brand, p_size, round(p_retailprice::FLOAT, 2) AS price, string_split(p_name, ' ')[1] AS first_word, 2 AS n_words FROM part")
def tfrecord_roundtrip(spark, sf_dir):
    p = views.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size", F.col("p_retailprice").cast("float").alias("price"), F.split("p_name", " ").alias("words"))
    path = new_path(spark, "tfrecords")
    tfrecord.write_tfrecord(p, path, codec="gzip", tasks=spark.sparkContext.defaultParallelism)
    back = tfrecord.read_tfrecord(spark, path, "p_partkey long, p_name string, p_brand string, p_size int, price float, words array<string>")
    return back.select("p_partkey", "p_name", "p_brand", "p_size", F.round("price", 2).alias("price"), F.get("words", F.lit(0)).alias("first_word"), F.size("words").alias("n_words"))


@query("SELECT * FROM (VALUES ('p_brand', 'string'), ('p_name', 'string'), ('p_partkey', 'bigint'), ('p_retailprice', 'float'), ('sizes', 'array<array<bigint>>'), ('words', 'array<string>')) v(name, type)")
def tfrecord_infer_schema(spark, sf_dir):
    p = views.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_retailprice", F.split("p_name", " ").alias("words"), F.array(F.array("p_size"), F.array("p_size", "p_size")).alias("sizes"))
    path = new_path(spark, "tfrecords")
    tfrecord.write_tfrecord(p, path, record_type="SequenceExample", tasks=spark.sparkContext.defaultParallelism)
    return tfrecord.infer_columns(spark, path, "SequenceExample")


@query()
def example_bytes(spark, sf_dir):
    p = views.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    return tfrecord.as_example(p).select("p_partkey", "example")


@query("SELECT day, count(*) AS n, min(CASE WHEN day = '2024-01-05' THEN 1 ELSE 0 END) AS replaced FROM ev GROUP BY 1")
def partition_overwrite(spark, sf_dir):
    ev, path = _ev(spark, sf_dir).withColumn("replaced", F.lit(0)), new_path(spark, "days")
    sinks.write_partition(ev, path, ["day"])
    sinks.write_partition(ev.where("day = '2024-01-05'").withColumn("replaced", F.lit(1)), path, ["day"])
    return spark.read.schema(ev.schema).parquet(path).groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.min("replaced").alias("replaced"))


# ---- quality, drift, evaluation


def _report_sql(table: str, where: str, cols: list[tuple[str, bool]]) -> str:
    return " UNION ALL ".join(
        f"SELECT 'clean' AS stage, count(*) AS total_count, '{c}' AS name, '{'numeric' if num else 'string'}' AS type, count(*) - count({c}) AS null_count, round((count(*) - count({c})) / count(*), 6) AS null_ratio, "
        + (f"NULL::BIGINT AS cardinality, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev" if num else f"count(DISTINCT {c}) AS cardinality, NULL::DOUBLE AS min, NULL::DOUBLE AS max, NULL::DOUBLE AS mean, NULL::DOUBLE AS stddev")
        + f" FROM {table} {where}"
        for c, num in cols
    )


_IX_COLS = [("user_id", False), ("item_id", False), ("rating", True), ("time_stamp", True), ("day", False)]


@query(_report_sql("ix", "", _IX_COLS))
def quality_report(spark, sf_dir):
    return quality.quality_report(_ix(spark, sf_dir), "clean").withColumns({"mean": F.round("mean", 6), "stddev": F.round("stddev", 6)})


@query("SELECT total_count, name, type, null_count, null_ratio, min, max, round(mean, 3) AS mean, round(stddev, 3) AS stddev, CASE WHEN type = 'string' THEN true END AS near FROM (" + _report_sql("ix", "", [c for c in _IX_COLS if c[0] != "day"]) + ")")
def quality_report_merged(spark, sf_dir):
    """The report of all days from the profiles of each; ``near`` tells that a cardinality is within 5% of the exact one."""
    ix = _ix(spark, sf_dir)
    days = written(profiles.column_profiles(ix, ["day"]), "profiles")
    whole = profiles.report(profiles.merged_profiles(days), "clean")
    exact = quality.quality_report(ix.drop("day"), "clean").select("name", F.col("cardinality").alias("exact"))
    near = F.abs(F.col("cardinality") - F.col("exact")) <= 0.05 * F.col("exact")
    return whole.join(exact, "name").select("total_count", "name", "type", "null_count", "null_ratio", "min", "max", F.round("mean", 3).alias("mean"), F.round("stddev", 3).alias("stddev"), near.alias("near"))


@query("WITH " + COMMON + ", a AS (" + _report_sql("ix", "WHERE rating >= 3", _IX_COLS) + "), b AS (" + _report_sql("ix", "WHERE day < '1997-01-01'", _IX_COLS) + """)
SELECT name, m AS metric, round(prev, 6) AS prev, round(curr, 6) AS curr, coalesce(CASE m WHEN 'count' THEN abs(curr - prev) / greatest(prev, 1) > 0.2 WHEN 'null_ratio' THEN abs(curr - prev) > 0.05 ELSE prev <> 0 AND abs(curr - prev) / abs(prev) > 0.5 END, false) AS warn FROM (
SELECT name, 'count' AS m, b.total_count::DOUBLE AS prev, a.total_count::DOUBLE AS curr FROM a JOIN b USING (name) UNION ALL SELECT name, 'null_ratio', b.null_ratio, a.null_ratio FROM a JOIN b USING (name)
UNION ALL SELECT name, 'mean', b.mean, a.mean FROM a JOIN b USING (name) WHERE a.mean IS NOT NULL)""")
def drift_report(spark, sf_dir):
    ix = _ix(spark, sf_dir)
    d = quality.drift_report(quality.quality_report(ix.where("rating >= 3"), "clean"), quality.quality_report(ix.where("day < '1997-01-01'"), "clean"))
    return d.withColumns({"prev": F.round("prev", 6), "curr": F.round("curr", 6)})


@query("SELECT 'orders' AS stage, count(*) AS total, count(*) FILTER (WHERE o_orderkey % 7 <> 0) AS valid, round(count(*) FILTER (WHERE o_orderkey % 7 <> 0) / count(*), 6) AS valid_share, count(DISTINCT CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 5 END) AS n_targets FROM orders")
def stage_report(spark, sf_dir):
    return quality.stage_report(parse_samples(spark, sf_dir).withColumn("target", F.col("rating")), "orders")


@query("SELECT rating AS label, count(*) AS cnt, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM ev GROUP BY 1")
def label_distribution(spark, sf_dir):
    return quality.label_distribution(_ev(spark, sf_dir).withColumnRenamed("rating", "label"))


@query("SELECT rating AS target, count(*) AS cnt FROM ev GROUP BY 1 ORDER BY cnt DESC, target LIMIT 3")
def top_targets(spark, sf_dir):
    return quality.top_targets(_ev(spark, sf_dir).withColumns({"target": F.col("rating"), "parse_ok": F.lit(True)}), 3)


@query("SELECT c AS \"column\", n AS filled, round(n / t, 6) AS coverage FROM (SELECT 'genre_raw' AS c, count(rating) FILTER (WHERE rating > 2) AS n, count(*) AS t FROM ev UNION ALL SELECT 'genre_index', count(rating) FILTER (WHERE rating > 3), count(*) FROM ev UNION ALL SELECT 'genre_value', count(*), count(*) FROM ev)")
def feature_coverage(spark, sf_dir):
    r = F.col("rating")
    return quality.feature_coverage(_ev(spark, sf_dir).select(F.when(r > 2, F.array("item_id")).alias("genre_raw"), F.when(r > 3, F.array(r)).alias("genre_index"), F.array(r).alias("genre_value")))


AUC_SQL = "sum(pos * (below + neg / 2.0)) / (sum(pos)::DOUBLE * sum(neg))"


@query("SELECT round(" + AUC_SQL + ", 9) AS auc FROM (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM preds GROUP BY 1))")
def auc(spark, sf_dir):
    return evaluate.auc(views.predictions(spark, sf_dir))


def _gauc(group: str) -> str:
    return f"(SELECT {group} AS g, sum(pos + neg)::BIGINT AS n, sum(pos)::BIGINT AS clicks, round(coalesce(CASE WHEN sum(pos) * sum(neg) > 0 THEN {AUC_SQL} END, 0.5), 9) AS auc FROM (SELECT *, coalesce(sum(neg) OVER (PARTITION BY {group} ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM (SELECT {group}, score, sum(label) AS pos, sum(1 - label) AS neg FROM preds GROUP BY 1, 2)) GROUP BY 1)"


@query("SELECT round(sum(auc * clicks) / sum(clicks), 6) AS gauc, count(*) AS n_groups FROM " + _gauc("grp") + " WHERE clicks > 0 AND clicks < n")
def gauc_two_class(spark, sf_dir):
    return evaluate.gauc(views.predictions(spark, sf_dir), ["grp"])


@query("SELECT round(sum(auc * n) / sum(n), 6) AS gauc, count(*) AS n_groups FROM " + _gauc("grp"))
def gauc_all_groups(spark, sf_dir):
    return evaluate.gauc(views.predictions(spark, sf_dir), ["grp"], "all_groups")


@query("SELECT g AS lang, n, clicks, auc FROM " + _gauc("lang"))
def auc_by_segment(spark, sf_dir):
    return evaluate.group_auc(views.predictions(spark, sf_dir), ["lang"])


@query("SELECT g AS grp, n, clicks, auc FROM " + _gauc("grp") + " ORDER BY auc DESC, g LIMIT 5")
def top_groups(spark, sf_dir):
    return evaluate.top_groups(views.predictions(spark, sf_dir), ["grp"], 5)


# ---- analysis


@query("SELECT count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items, round((SELECT avg(n) FROM (SELECT count(DISTINCT item_id) AS n FROM ix GROUP BY user_id)), 6) AS items_per_user FROM ix")
def an_overview(spark, sf_dir):
    ix = _ix(spark, sf_dir)
    per = ix.groupBy("user_id").agg(F.count_distinct("item_id").alias("n")).agg(F.count(F.lit(1)).alias("n_users"), F.round(F.avg("n"), 6).alias("items_per_user"))
    return per.crossJoin(ix.agg(F.count_distinct("item_id").alias("n_items")))  # one row each


_RATES = "SELECT item_id, min(rating) AS min_rate, max(rating) AS max_rate, round(avg(rating), 6) AS avg_rate, count(*) AS cnt FROM ix GROUP BY 1"


def _rates(spark, sf_dir) -> DataFrame:
    g = _ix(spark, sf_dir).groupBy("item_id")
    return g.agg(F.min("rating").alias("min_rate"), F.max("rating").alias("max_rate"), F.round(F.avg("rating"), 6).alias("avg_rate"), F.count(F.lit(1)).alias("cnt"))


def _ends(rates: DataFrame, by: str, items: DataFrame) -> DataFrame:
    most = rates.orderBy(F.col(by).desc(), "item_id").limit(10).withColumn("which", F.lit("top"))
    least = rates.orderBy(F.col(by), "item_id").limit(10).withColumn("which", F.lit("bottom"))
    return most.unionByName(least).join(items.select("item_id", "title"), "item_id")


def _ends_sql(by: str) -> str:
    return f"r AS ({_RATES}) SELECT x.*, title FROM (SELECT * FROM (SELECT *, 'top' AS which FROM r ORDER BY {by} DESC, item_id LIMIT 10) UNION ALL SELECT * FROM (SELECT *, 'bottom' AS which FROM r ORDER BY {by}, item_id LIMIT 10)) x JOIN items USING (item_id)"


@query("WITH " + COMMON + "," + _ends_sql("cnt"))
def an_most_least_rated(spark, sf_dir):
    return _ends(_rates(spark, sf_dir), "cnt", views.items(spark, sf_dir))


@query("WITH " + COMMON + "," + _ends_sql("avg_rate"))
def an_highest_lowest(spark, sf_dir):
    return _ends(_rates(spark, sf_dir), "avg_rate", views.items(spark, sf_dir))


@query("SELECT occupation, age, count(*) AS cnt, round(avg(rating), 6) AS avg_rate FROM ix JOIN users USING (user_id) GROUP BY 1, 2")
def an_by_segment(spark, sf_dir):
    j = _ix(spark, sf_dir).join(views.users(spark, sf_dir), "user_id")
    return j.groupBy("occupation", "age").agg(F.count(F.lit(1)).alias("cnt"), F.round(F.avg("rating"), 6).alias("avg_rate"))


@query("SELECT day, count(DISTINCT item_id) AS n_items, count(DISTINCT user_id) AS n_users FROM ix GROUP BY 1")
def an_by_day(spark, sf_dir):
    return _ix(spark, sf_dir).groupBy("day").agg(F.count_distinct("item_id").alias("n_items"), F.count_distinct("user_id").alias("n_users"))


RUN_ROWS = "SELECT sample_id, CASE WHEN i <= floor(n * 0.8) THEN 'train' WHEN i <= floor(n * 0.8) + floor(n * 0.1) THEN 'val' ELSE 'test' END AS split, label FROM (SELECT *, row_number() OVER (ORDER BY time_stamp, sample_id) AS i, count(*) OVER () AS n FROM (SELECT sample_id, time_stamp, CASE WHEN rating >= 4 THEN 1 ELSE 0 END AS label FROM ev WHERE rating >= 4 OR " + U.format("'42', sample_id::VARCHAR") + " < 0.5))"


@query(RUN_ROWS)
def pipeline_end_to_end(spark, sf_dir):
    rows = clean.labelled(_samples(spark, sf_dir))
    return training.run(rows, _registry(spark, sf_dir), mode="binary", keep_negatives=0.5, feature_threshold=3).encoded.select("sample_id", "split", "label")


RUN_SQL = ", kept AS (" + RUN_ROWS + """),
counted AS (SELECT field_name, field_index, field_type, key, count(*) AS cnt FROM tokens JOIN kept USING (sample_id) WHERE split = 'train' GROUP BY ALL HAVING count(*) >= 3),
learned AS (SELECT field_index, field_type, key, CASE WHEN field_type = 0 THEN 1 ELSE row_number() OVER (PARTITION BY field_index, field_type ORDER BY sum(cnt) DESC, key) END AS pos FROM counted GROUP BY 1, 2, 3),
found AS (SELECT t.*, CASE WHEN t.field_type = 0 THEN 1 ELSE p.pos END AS pos FROM tokens t JOIN kept USING (sample_id) LEFT JOIN learned p USING (field_index, field_type, key) WHERE t.field_type = 0 OR p.pos IS NOT NULL),
fields AS (SELECT sample_id, field_name, string_agg(key, '|' ORDER BY ord) AS raws, string_agg(pos::VARCHAR, '|' ORDER BY ord) AS indexes, string_agg((round(1.0 * value, 3)::DECIMAL(12,3))::VARCHAR, '|' ORDER BY ord) AS vals FROM found GROUP BY 1, 2)
SELECT k.sample_id, k.split, k.label, e.rating, e.rating AS target, f.field_name, concat_ws('|', 'R:', raws) AS raws, concat_ws('|', '0', indexes) AS indexes, concat_ws('|', '1.000', vals) AS vals
FROM kept k JOIN ev e USING (sample_id) CROSS JOIN (SELECT DISTINCT field_name FROM tokens) f LEFT JOIN fields l ON l.sample_id = k.sample_id AND l.field_name = f.field_name
WHERE EXISTS (SELECT 1 FROM found x WHERE x.sample_id = k.sample_id)"""


@query(TOKENS_SQL + RUN_SQL)
def training_run_encoded(spark, sf_dir):
    """All that a training run encodes: split, label, rating, target, and the arrays of every field."""
    rows = clean.labelled(_samples(spark, sf_dir))
    encoded = training.run(rows, _registry(spark, sf_dir), mode="rating", keep_negatives=0.5, feature_threshold=3).encoded
    flat = _encoded_flat(encoded).drop("has_feature")
    return encoded.select("sample_id", "split", "label", "rating", "target").join(flat, "sample_id")


@query("SELECT k.*, p.pos AS user_pos FROM (" + (LAST := "SELECT sample_id, user_id, label, rating, CASE r WHEN 1 THEN 'test' WHEN 2 THEN 'val' ELSE 'train' END AS split FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY time_stamp DESC, sample_id DESC) AS r FROM (SELECT *, CASE WHEN rating >= 4 THEN 1 ELSE 0 END AS label FROM ev))") + """) k
LEFT JOIN (SELECT user_id, row_number() OVER (ORDER BY count(*) DESC, user_id) AS pos FROM (""" + LAST + ") WHERE split = 'train' AND user_id <> '0' GROUP BY 1 HAVING count(*) >= 3) p USING (user_id)")
def training_job_by_last(spark, sf_dir):
    """A job that splits by a user's last rows, run once more over its finished stages, with the user's position in the vocabulary; number 0 is padding."""
    registry = _registry(spark, sf_dir, ["user_id", "context_time_week"])
    rows, path = clean.labelled(_samples(spark, sf_dir)), new_path(spark, "job")
    for _ in range(2):
        job = Stages(spark, path)
        done = training.run(rows, registry, mode="rating", feature_threshold=3, split_by="last", stages=job)
    if job.made:
        raise RuntimeError(f"stages {job.made} were made again")
    return done.encoded.select("sample_id", "label", "rating", "split", F.get("user_id_index", F.lit(1)).alias("user_pos")).join(rows.select("sample_id", "user_id"), "sample_id")
