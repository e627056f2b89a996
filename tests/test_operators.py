import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from recspark.functions.hashing import hash_bytes, hash_keys
from recspark.operators import clean, encode, evaluate, history_stats, indexing, point_in_time, quality, registry, sampling, sequences, split, vocab, windows
from recspark.operators.indexing import global_index, running_sums
from recspark.operators.registry import load
from recspark.plans import training
from recspark.plans.stages import Stages, source_digest


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_clean_ratings(spark):
    raw = spark.createDataFrame([("1", "2", " 5 ", "978300760"), ("1", "2", "5", "978300760"), ("x", "2", "5", "1"), ("1", "2", "6", "1"), ("1", "2", None, "1"), ("1", "2", "5", "t"), ("-1", "2", "5", "1")], "user_id string, item_id string, rating string, time_stamp string")
    assert [tuple(r) for r in clean.clean_ratings(raw).collect()] == [("1", "2", 5, 978300760, "2000-12-31")]


def test_other_cleaning(spark):
    apps = spark.createDataFrame([("u", "a", "3", "7", 1), ("", "a", "3", "7", 1), ("u", "a", "9", "7", 1)], "user_id string, item_id string, rating string, time_stamp string, votes int")
    assert clean.clean_app_interactions(apps).count() == 1
    ads = spark.createDataFrame([("u", "a", 1, 86400), (None, "a", 1, 2)], "user_id string, item_id string, label int, time_stamp long")
    assert [r.day for r in clean.clean_impressions(ads).collect()] == ["1970-01-02"]
    cast = clean.cast_columns(spark.createDataFrame([("1", "x"), (None, "2")], "a string, b string"), "k", {"k": ("a", "int"), "v": ("b", "int")})
    assert [tuple(r) for r in cast.collect()] == [(1, None)]
    parsed = clean.parse_samples(spark.createDataFrame([("u", "i", "4", "100"), ("u", "i", "bad", "100")], "user_id string, item_id string, rating string, time_stamp string"))
    assert rows(parsed, "parse_ok", "rating", "millis") == [(False, 0, 100000), (True, 4, 100000)]


@pytest.mark.parametrize("n", [0, 1, 7, 1000])
def test_global_index(spark, n):
    df = spark.range(n).withColumns({"v": F.pmod(F.xxhash64("id"), F.lit(5)), "g": F.col("id") % 3})
    got = [r.idx for r in global_index(df, [F.col("v").desc(), F.col("id")], "idx").orderBy(F.col("v").desc(), "id").collect()]
    assert got == list(range(n))
    grouped = global_index(df, [F.col("v"), F.col("id")], "idx", within=("g",)).groupBy("g").agg(F.count("*").alias("n"), F.max("idx").alias("m"), F.count_distinct("idx").alias("d")).collect()
    assert all(r.n == r.d == r.m + 1 for r in grouped)


def test_sequences(spark):
    ix = spark.createDataFrame([("u", "a", 3, 10), ("u", "a", 4, 20), ("u", "b", 5, 20), ("u", "c", 1, 5), ("v", "a", 2, 1)], "user_id string, item_id string, rating int, time_stamp long")
    assert rows(sequences.sequence_text(sequences.user_sequences(ix, 2)), "user_id", "seq") == [("u", "a:4:20,b:5:20"), ("v", "a:2:1")]
    items = spark.createDataFrame([("a", "A", ["g"]), ("b", "B", ["h", "i"]), ("z", "Z", ["g"])], "item_id string, title string, genres array<string>")
    assert rows(sequences.item_stats(ix, items), "item_id", "rate_count", "avg_rate", "hot_rank") == [("a", 2, 3.0, 1), ("b", 1, 5.0, 2)]
    assert ("z", 0, 0.0) in rows(sequences.item_stats_left(ix, items), "item_id", "rate_count", "avg_rate")
    users = spark.createDataFrame([("u", "M", "25", "1", "0")], "user_id string, gender string, age string, occupation string, zip_code string")
    joined = sequences.join_samples(ix, users, sequences.user_sequences(ix), sequences.item_stats(ix, items))
    assert joined.count() == 5 and joined.where("user_profile is null").count() == 1
    assert joined.where("item_feature is null").count() == 1
    assert sequences.as_json(joined).where("user_profile = '{}'").count() == 1


def test_splits(spark):
    df = spark.range(100).withColumns({"time_stamp": F.pmod(F.xxhash64("id"), F.lit(50)), "user": F.col("id") % 7})
    got = split.time_ratio_split(df, [F.col("time_stamp"), F.col("id")], 0.8, 0.1)
    assert dict(rows(got.groupBy("split").count(), "split", "count")) == {"train": 80, "val": 10, "test": 10}
    assert split.time_ratio_split(df, [F.col("id")], 1.0, 0.0).where("split <> 'train'").count() == 0
    few = spark.createDataFrame([(1, i) for i in range(5)] + [(2, 0), (2, 1), (3, 0)], "u int, t int")
    by = split.leave_one_out_split(few, "u", [F.col("t").desc()]).groupBy("u", "split").count()
    assert rows(by, "u", "split", "count") == [(1, "test", 1), (1, "train", 3), (1, "val", 1), (2, "test", 1), (2, "val", 1), (3, "test", 1)]
    labelled = spark.range(2000).withColumn("label", (F.col("id") % 2).cast("int"))
    kept = split.downsample_negatives(labelled, 0.3, F.col("id")).groupBy("label").count().collect()
    assert {r.label: r["count"] for r in kept}[1] == 1000 and 230 < {r.label: r["count"] for r in kept}[0] < 370


def test_candidates(spark):
    history = spark.createDataFrame([("u", "2"), ("u", "4"), ("u", "3"), ("w", "1"), ("w", "5")], "user_id string, item_id string")
    pool = sampling.popularity(history)
    positives = history.where("user_id = 'u' and item_id = '3'")
    assert rows(sampling.candidates(positives, pool, history), "cand") == [("1",), ("5",)]
    full = spark.createDataFrame([("u", str(i)) for i in (1, 2, 3)], "user_id string, item_id string")
    assert sampling.candidates(full.where("item_id = '3'"), sampling.popularity(full), full).count() == 0


@pytest.mark.parametrize("strategy", ["uniform", "popular", "mixed"])
@pytest.mark.parametrize("large", [False, True])
def test_negatives(spark, strategy, large, monkeypatch):
    monkeypatch.setattr(sampling, "RANK_LIMIT", 0 if large else 10**9)
    ix = spark.range(600).select((F.col("id") % 20).cast("string").alias("user_id"), (F.pow(F.rand(1), 3) * 60).cast("int").cast("string").alias("item_id")).distinct()
    ix = spark.createDataFrame(ix.collect(), ix.schema)
    got = sampling.sample_negatives(ix, sampling.popularity(ix), ix, 4, strategy)
    assert got.groupBy("user_id", "item_id", "cand").count().where("count > 1").count() == 0
    assert got.join(ix.withColumnRenamed("item_id", "cand"), ["user_id", "cand"], "left_semi").count() == 0
    assert got.groupBy("user_id", "item_id").count().where("count > 4").count() == 0
    both = sampling.with_negatives(ix.withColumn("rating", F.lit(5)), got)
    assert both.where("label = 0 and rating <> 0").count() == 0 and both.where("label = 1").count() == ix.count()


def _hot_users(spark):
    """Users who have seen all but 2 or 6 of 100 items, or 3 of them only, and items of very unequal popularity."""
    seen = [(u, i) for u, n in (("a", 98), ("b", 94), ("c", 3)) for i in range(n)] + [(f"x{j}", i) for i in (0, 1, 98, 99) for j in range(50 if i < 2 else 1)] + [("y", i) for i in range(100)]
    ix = spark.createDataFrame([(u, str(i)) for u, i in seen], "user_id string, item_id string")
    return ix, ix.where("user_id in ('a', 'b', 'c', 'y')")


@pytest.mark.parametrize("strategy", ["uniform", "popular", "mixed"])
def test_negatives_do_not_depend_on_size(spark, strategy, monkeypatch):
    ix, positives = _hot_users(spark)
    got = []
    for limit in (10**9, 0):
        monkeypatch.setattr(sampling, "RANK_LIMIT", limit)
        got.append(rows(sampling.sample_negatives(positives, sampling.popularity(ix), ix, 4, strategy), "user_id", "item_id", "cand", "rk"))
    assert got[0] == got[1] and len(got[0]) == 98 * 2 + 94 * 4 + 3 * 4


@pytest.mark.parametrize("strategy", ["uniform", "popular"])
def test_drawing_finds_all_there_are(spark, strategy):
    ix, positives = _hot_users(spark)
    got = sampling.drawn(positives, sampling.popularity(ix), ix, 4, strategy)
    per = {(r.user_id, r.item_id): (r.n, r.d, r.most) for r in got.groupBy("user_id", "item_id").agg(F.count("*").alias("n"), F.count_distinct("cand").alias("d"), F.max("rk").alias("most")).collect()}
    assert per == {(u, str(i)): (k, k, k) for u, n, k in (("a", 98, 2), ("b", 94, 4), ("c", 3, 4)) for i in range(n)}
    assert got.join(ix.withColumnRenamed("item_id", "cand"), ["user_id", "cand"], "left_semi").count() == 0


def _selected(positives, pool, history, k, strategy, seed=42):
    """The selection replayed item by item on lists of what is unseen."""
    weight = {i: max(1, math.floor(round(max(p or 1, 1) ** 0.75 * (1 << 20), 6))) for i, p in pool}
    known = {}
    for u, i in [*history, *positives]:
        known.setdefault(u, set()).add(i)
    bits = lambda what, u, i, d: int(hashlib.md5("|".join(str(x) for x in (seed, what, u, i, d) if x is not None).encode()).hexdigest()[:15], 16)
    out = set()
    for u, i in set(positives):
        left = [x for x in sorted(weight) if x not in known[u]]
        for d in range(1, k + 1):
            if not left:
                break
            if d <= {"uniform": 0, "popular": k, "mixed": k // 2}[strategy]:
                at = bits("popular", u, i, d) % sum(weight[x] for x in left)
                pick = next(x for n, x in enumerate(left) if sum(weight[y] for y in left[: n + 1]) > at)
            else:
                pick = left[bits("uniform", u, i, d) % len(left)]
            left.remove(pick)
            out.add((u, i, pick, d))
    return out


@pytest.mark.parametrize("strategy", ["uniform", "popular", "mixed"])
def test_selection_equals_its_replay(spark, strategy):
    rng = random.Random(3)
    pool = [(f"i{n:02d}", rng.choice([None, 0, 1, 1, 2, 50, 9000])) for n in range(30)]
    history = [("heavy", i) for i, _ in pool[:28]] + [("all", i) for i, _ in pool] + [(None, "i03"), ("x", "unknown")]
    history += [(f"u{rng.randrange(6)}", f"i{rng.randrange(30):02d}") for _ in range(60)]
    positives = [("heavy", f"i{n:02d}") for n in range(28)] + [("all", "i05"), (None, "i03"), ("x", "unknown")] + [h for h in history if h[0] and h[0][0] == "u"] * 2
    frames = [spark.createDataFrame(r, c) for r, c in ((positives, "user_id string, item_id string"), (pool, "item_id string, pop long"), (history, "user_id string, item_id string"))]
    got = sampling.drawn(*frames, 4, strategy).collect()
    assert len(got) == len({tuple(r) for r in got})
    assert {(r.user_id, r.item_id, r.cand, r.rk) for r in got} == _selected(positives, pool, history, 4, strategy)
    assert {r.cand for r in got if r.user_id == "heavy"} == {"i28", "i29"}
    assert sampling.drawn(frames[0].limit(0), *frames[1:], 4, strategy).collect() == []
    assert sampling.drawn(frames[0], frames[1].limit(0), frames[2], 4, strategy).collect() == []


def test_running_sums_of_a_giant_group(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["g"] * 9 + ["h", None]), rng.randrange(50), rng.randrange(9), n) for n in range(600)]
    df = spark.createDataFrame(rows, "g string, o int, v int, n int")
    got = running_sums(df, [F.col("o"), F.col("n")], {"v_before": F.col("v"), "before": F.lit(1)}, within=("g",), partitions=5)
    for r in got.collect():
        earlier = [x for x in rows if x[0] == r.g and (x[1], x[3]) < (r.o, r.n)]
        assert (r.v_before, r.before) == (sum(x[2] for x in earlier), len(earlier))


def test_popular_draws_follow_the_weights(spark):
    pool = spark.createDataFrame([("hot", 100_000)] + [(f"i{k}", 1) for k in range(40)], "item_id string, pop long")
    positives = spark.range(4000).select(F.col("id").cast("string").alias("user_id"), F.lit("own").alias("item_id"))
    got = sampling.drawn(positives, pool, positives, 1, "popular")
    hot = got.where("cand = 'hot'").count() / 4000
    want = 100_000**0.75 / (100_000**0.75 + 40)
    assert abs(hot - want) < 0.005
    assert got.count() == 4000


def test_merge_of_statistics(spark):
    df = spark.createDataFrame([(3, 12.0, 56.0)], "n long, s double, q double")
    stored = vocab.from_sums(F.col("n"), F.col("s"), F.col("q"))
    new = {"cnt": F.lit(2), "sum": F.lit(18.0), "sum_sq": F.lit(164.0), "mean": F.lit(9.0), "m2": F.lit(2.0)}
    m = vocab.merged(stored, new)
    got = df.select(m["cnt"].alias("n"), m["mean"].alias("mean"), vocab.std(m["m2"], m["cnt"]).alias("std")).first()
    assert got.n == 5 and got.mean == 6 and math.isclose(got.std, math.sqrt(8 + 1e-6))
    assert df.select(vocab.std(F.lit(0.0), F.lit(0))).first()[0] == 1.0


def _tokens(spark, pairs):
    return spark.createDataFrame([(i, n, x, 1, 0, k, k, None, 1.0) for i, (n, x, k) in enumerate(pairs)], "sample_id long, field_name string, field_index int, field_type int, ord int, raw string, key string, fea long, value double")


def test_vocabulary(spark):
    first = _tokens(spark, [("a", 1, "x")] * 3 + [("a", 1, "y")] * 2 + [("b", 1, "x")] * 2 + [("b", 1, "z")])
    stats = vocab.value_stats(first)
    one = vocab.build_pos_map(stats, 2)
    assert rows(one, "key", "pos", "cnt") == [("x", 1, 5), ("y", 2, 2)]
    second = _tokens(spark, [("a", 1, "z")] * 4 + [("a", 1, "y")] * 9 + [("a", 1, "w")])
    two = vocab.build_pos_map(vocab.value_stats(second), 2, one)
    assert rows(two, "key", "pos", "cnt") == [("x", 1, 5), ("y", 2, 11), ("z", 3, 4)]
    fields = first.select("field_name", "field_index", "field_type").distinct()
    assert rows(vocab.pos_dim(two, fields), "field_name", "dim") == [("a", 4), ("b", 4)]
    report = vocab.build_report(vocab.value_stats(second), 2, one).first()
    assert (report.total, report.new, report.existing, report.below, report.occurrences) == (3, 1, 1, 1, 14)
    targets = spark.createDataFrame([(5,), (5,), (7,), (8,)], "target int")
    first_map = vocab.build_target_map(targets, 1)
    assert rows(first_map, "target", "idx") == [(5, 0), (7, 1), (8, 2)]
    more = spark.createDataFrame([(9,), (9,), (7,)], "target int")
    assert rows(vocab.build_target_map(more, 1, first_map), "target", "idx", "cnt") == [(5, 0, 2), (7, 1, 2), (8, 2, 1), (9, 3, 2)]


def _samples(spark):
    ix = spark.createDataFrame([(1, "1", "10", 5, 100), (2, "1", "11", 3, 90000), (3, "1", "12", 4, 900000), (4, "2", "10", 2, 50)], "sample_id long, user_id string, item_id string, rating int, time_stamp long")
    items = spark.createDataFrame([("10", "Toy Story (1995)", ["animation", "comedy"]), ("11", "Heat (1985)", ["action"])], "item_id string, title string, genres array<string>")
    users = spark.createDataFrame([("1", "M", "25", "0", "48067")], "user_id string, gender string, age string, occupation string, zip_code string")
    return training.samples(ix, items, users)


def test_registry_and_encoding(spark):
    r = training.default_registry()
    assert len(r.active()) == 69
    r.cross("genre_gender", 417, ["movie_genres", "user_gender"], True)
    r.cross("lost", 418, ["movie_genres", "nothing"], True)
    assert [f.name for f in r.active() if f.depends] == ["genre_gender"]
    s = _samples(spark)
    t = r.tokens(s)
    assert rows(t.where("sample_id = 1 and field_name = 'movie_title'"), "ord", "raw") == [(0, "Toy"), (1, "Story")]
    assert rows(t.where("sample_id = 1 and field_name = 'genre_gender'"), "raw") == [("103:animation__xx__3:1",), ("103:comedy__xx__3:1",)]
    assert t.where("field_name = 'user_occupation'").count() == 0  # number 0 is padding
    assert rows(t.where("sample_id = 3 and field_name = 'user_movie_rate_ids'"), "ord", "raw", "value") == [(0, "11", 3.0), (1, "10", 5.0)]
    assert rows(t.where("sample_id = 3 and field_name = 'user_movie_rate_id_1days'"), "raw") == []
    small = training.default_registry(["user_id", "movie_genres", "movie_rate_avg_continue"])
    tokens = small.tokens(s)
    pos = vocab.build_pos_map(vocab.value_stats(tokens), 2)
    e = {x.sample_id: x for x in encode.encode_vocab(tokens, pos, small).collect()}
    assert e[1].user_id_raw == ["R:", "1"] and e[1].user_id_index == [0, 1] and e[1].movie_genres_index == [0, 1, 2]
    assert e[2].movie_genres_index == [0] and e[2].has_feature and e[1].movie_rate_avg_continue_value == [1.0, 3.5]
    h = {x.sample_id: x for x in encode.encode_hash(tokens, small).collect()}
    assert h[1].user_id_index == [0, 150436848691021846]
    assert small.output_columns()[:3] == ["user_id_raw", "user_id_index", "user_id_value"]


def test_cross_hashes_and_kept_rows(spark):
    r = training.default_registry(["user_gender", "user_age", "movie_genres"], ["movie_genres_xx_user_gender"])
    r.cross("gender_xx_age", 499, ["user_gender", "user_age"], True)
    s = _samples(spark).unionByName(_samples(spark).limit(1).withColumns({"sample_id": F.lit(9).cast("long"), "item_id": F.lit("none")}).withColumn("user_id", F.lit("none")))
    s = s.withColumn("user_profile", F.struct(F.when(F.col("sample_id") == 1, "M").alias("gender"), F.lit("25").alias("age"), F.lit("0").alias("occupation"), F.lit("0").alias("zip_code")))
    tokens = r.tokens(s)
    h = {x.sample_id: x for x in encode.encode_hash(tokens, r, keys=spark.range(77, 78).withColumnRenamed("id", "sample_id")).collect()}
    assert h[77].user_gender_index == [0] and set(h) == {1, 2, 3, 4, 9, 77}
    crossed = tokens.where("sample_id = 1 and field_name = 'gender_xx_age'").first()
    pairs = [v for p in crossed.parts for v in (p.field_index, p.fea)]
    assert crossed.fea is None and list(h[1].gender_xx_age_index)[1:] == hash_keys(np.array([pairs])).tolist()
    genre = tokens.where("sample_id = 1 and field_name = 'movie_genres_xx_user_gender' and ord = 0").first()
    ids = [(p.field_index, p.fea if p.fea is not None else hash_bytes([p.key.encode()])[0]) for p in genre.parts]
    assert list(h[1].movie_genres_xx_user_gender_index)[1] == hash_keys(np.array([[v for p in ids for v in p]]))[0]
    # the known answer for the pairs (2, 25) and (3, 1), through the encoder
    parts = F.array(*[F.struct(F.lit(i).alias("field_index"), F.lit(str(k)).alias("key"), F.lit(k).cast("long").alias("fea")) for i, k in ((2, 25), (3, 1))])
    one = spark.range(1).select(F.lit(1).alias("sample_id"), F.lit("gender_xx_age").alias("field_name"), F.lit(499).alias("field_index"), F.lit(1).alias("field_type"), F.lit(0).alias("ord"), F.lit("2:25__xx__3:1").alias("raw"), F.lit("2:25__xx__3:1").alias("key"), F.lit(None).cast("long").alias("fea"), F.lit(1.0).alias("value"), parts.alias("parts"))
    assert encode.encode_hash(one, r).first().gender_xx_age_index == [0, 762837220344613912]
    # samples whose values are all unknown come back with sentinels
    few = vocab.build_pos_map(vocab.value_stats(tokens.where("sample_id = 1 and field_name = 'user_gender'")))
    e = {x.sample_id: x for x in encode.encode_vocab(tokens, few, r).collect()}
    assert set(e) >= {1, 2, 3, 4} and e[1].has_feature and not e[3].has_feature and e[3].user_age_raw == ["R:"]


def test_continuous_values_count_as_features(spark):
    r = training.default_registry(["movie_rate_avg_continue"])
    tokens = r.tokens(_samples(spark))
    empty = vocab.build_pos_map(vocab.value_stats(tokens.limit(0)))
    assert all(x.has_feature for x in encode.encode_vocab(tokens, empty, r).collect())


def test_default_crosses_and_configuration():
    r = training.default_registry(None, list(training.CROSSES))
    assert len(training.CROSSES) == 22 and len(r.active()) == 69 + 22
    config = {"features": [{"field_name": "user_id", "field_index": 1, "field_type": 1}, {"field_name": "unheard", "field_index": 2, "field_type": 1}], "cross_features": None}
    with pytest.warns(UserWarning, match="unheard"):
        assert [f.name for f in load(config, {"user_id": lambda: F.lit(None)}).active()] == ["user_id"]


def test_yaml_configuration(tmp_path):
    pytest.importorskip("yaml")
    whole = training.default_registry(None, ["movie_genres_xx_user_gender"])
    (tmp_path / "features.yaml").write_text(registry.as_yaml(whole))
    back = registry.load_yaml((tmp_path / "features.yaml").read_text(), registry.default_builders(), registry.with_windows)
    described = [[(f.name, f.index, f.kind, f.enabled, f.depends) for f in r.features] for r in (whole, back)]
    assert described[0] == described[1] and [f.name for f in back.active()] == [f.name for f in whole.active()] and len(back.active()) == 70
    own = "features:\n  - {field_name: user_id, field_index: 1, field_type: 1}\n  - {field_name: movie_id, field_index: 101, field_type: 1, enabled: false}\ncross_features:\n"
    assert [f.name for f in registry.load_yaml(own, registry.default_builders()).active()] == ["user_id"] and registry.load_yaml("", {}).features == []


def test_run_with_previous_vocabulary(spark):
    r = training.default_registry(["user_id", "movie_id"])
    first = training.run(_samples(spark), r, train=0.5, val=0.25, feature_threshold=1)
    old = {(x.field_index, x.key): x.pos for x in first.pos_map.collect()}
    second = training.run(_samples(spark), r, train=1.0, val=0.0, feature_threshold=1, previous_vocab=first.pos_map, previous_targets=first.target_map)
    new = {(x.field_index, x.key): x.pos for x in second.pos_map.collect()}
    assert old.items() <= new.items() and len(new) > len(old)
    assert {x.target: x.idx for x in first.target_map.collect()}.items() <= {x.target: x.idx for x in second.target_map.collect()}.items()


def test_training_run(spark):
    out = training.run(_samples(spark), training.default_registry(["user_id", "movie_id"]), train=0.5, val=0.25, feature_threshold=1)
    # items that only later splits have are no targets
    assert rows(out.encoded, "sample_id", "split") == [(1, "train"), (4, "train")]
    assert rows(out.report, "stage", "total") == [("test", 1), ("train", 2), ("val", 1)]


def test_run_by_last_rows(spark):
    out = training.run(_samples(spark), training.default_registry(["user_id", "movie_id"]), mode="rating", feature_threshold=1, split_by="last")
    got = {x.sample_id: x.split for x in out.encoded.collect()}
    by_user = {}
    for x in _samples(spark).select("sample_id", "user_id", "time_stamp").collect():
        by_user.setdefault(x.user_id, []).append((x.time_stamp, x.sample_id))
    want = {s: name for v in by_user.values() for name, (_, s) in zip(["test", "val", *["train"] * len(v)], sorted(v, reverse=True))}
    assert got.items() <= want.items() and set(got.values()) >= {"test"}
    with pytest.raises(ValueError):
        training.run(_samples(spark), training.default_registry(["user_id"]), split_by="day")


def test_a_killed_job_goes_on(spark, tmp_path, monkeypatch):
    r, path, rows_ = training.default_registry(["user_id", "movie_id"]), f"{tmp_path}/in", _samples(spark)
    rows_.write.parquet(path)
    args = {"train": 0.5, "val": 0.25, "feature_threshold": 1}
    fresh = lambda: spark.read.schema(rows_.schema).parquet(path)
    with monkeypatch.context() as m, pytest.raises(RuntimeError, match="killed"):
        m.setattr(training.encode, "encode_rows", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
        training.run(fresh(), r, stages=Stages(spark, f"{tmp_path}/job"), **args)
    again = Stages(spark, f"{tmp_path}/job")
    with monkeypatch.context() as m:
        # nothing that the vocabulary is built with is called again
        m.setattr(training.vocab, "build_pos_map", None)
        m.setattr(training.vocab, "build_target_map", None)
        out = training.run(fresh(), r, stages=again, **args)
    assert again.taken == ["samples", "targets", "positions"] and again.made == ["encoded", "report"]
    plain = training.run(rows_, r, **args)
    for a, b in ((out.encoded, plain.encoded), (out.pos_map, plain.pos_map), (out.target_map, plain.target_map), (out.report, plain.report)):
        assert sorted(map(str, a.select(sorted(a.columns)).collect())) == sorted(map(str, b.select(sorted(b.columns)).collect()))
    # another threshold of targets leaves samples and positions, other features leave samples and targets
    third = Stages(spark, f"{tmp_path}/job")
    training.run(fresh(), r, stages=third, target_threshold=2, **args)
    assert third.taken == ["samples", "positions", "report"] and third.made == ["targets", "encoded"]
    # a half-written table without its manifest is made anew, other input is other stages
    rows_.limit(1).write.mode("append").parquet(path)
    fourth = Stages(spark, f"{tmp_path}/job")
    training.run(fresh().dropDuplicates(["sample_id"]), r, stages=fourth, **args)
    assert fourth.taken == []
    # outputs by split, and the next run's vocabulary by path
    for fmt in ("parquet", "tfrecords"):
        training.write_run(out, r, f"{tmp_path}/{fmt}", fmt)
        if fmt == "parquet":
            sizes = {n: spark.read.parquet(f"{tmp_path}/{fmt}/{n}").count() for n in training.SPLITS}
        else:
            assert sizes == {n: spark.read.format("tfrecords").schema("sample_id long").load(f"{tmp_path}/{fmt}/{n}").count() for n in training.SPLITS}
    assert sizes == {n: out.encoded.where(F.col("split") == n).count() for n in training.SPLITS}
    second = training.run(rows_, r, train=1.0, val=0.0, feature_threshold=1, **training.previous_run(spark, f"{tmp_path}/parquet"))
    old, new = ({(x.field_index, x.key): x.pos for x in v.collect()} for v in (out.pos_map, second.pos_map))
    assert old.items() <= new.items()
    with pytest.raises(ValueError, match="version"):
        source_digest(spark.createDataFrame([(1,)], "x int"))


@pytest.mark.parametrize(("labels", "scores", "want"), [("0011", [0.1, 0.2, 0.9, 0.8], 1.0), ("0011", [0.9, 0.8, 0.1, 0.2], 0.0), ("0101", [0.3, 0.4, 0.5, 0.6], 0.75), ("1100", [0.9, 0.4, 0.6, 0.3], 0.75), ("11", [0.1, 0.2], 0.5), ("01", [0.5, 0.5], 0.5), ("", [], 0.5)])
def test_auc(spark, labels, scores, want):
    df = spark.createDataFrame([(float(a), b, "g") for a, b in zip(labels, scores, strict=True)], "label double, score double, g string")
    assert evaluate.auc(df).first().auc == want
    assert [r.auc for r in evaluate.group_auc(df, ["g"]).collect()] == ([want] if labels else [])


def test_gauc(spark):
    df = spark.createDataFrame([(1.0, 0.9, "a"), (0.0, 0.1, "a"), (1.0, 0.2, "b"), (1.0, 0.3, "b"), (0.0, 0.9, "b"), (0.0, 0.5, "c")], "label double, score double, g string")
    assert tuple(evaluate.gauc(df, ["g"]).first()) == (round(1 / 3, 6), 2)
    assert tuple(evaluate.gauc(df, ["g"], "all_groups").first()) == (round((2 * 1 + 3 * 0 + 0.5) / 6, 6), 3)
    segs = spark.createDataFrame([("a", "old", "2024-01-01"), ("a", "new", "2024-01-02")], "g string, seg string, day string")
    assert rows(evaluate.with_segments(df, segs, "g", "2024-01-02").where("seg is not null"), "seg") == [("old",), ("old",)]


def test_quality(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", 3.0), (3, None, 5.0)], "i int, s string, d double")
    got = {r.name: r for r in quality.quality_report(df, "x").collect()}
    assert got["s"].cardinality == 1 and got["s"].null_count == 1 and got["d"].mean == 4.0 and got["i"].max == 3.0
    assert quality.quality_report(df.limit(0), "x").count() == 0
    later = quality.quality_report(df.withColumn("d", F.col("d") * 3).unionByName(df), "x")
    warned = rows(quality.drift_report(later, quality.quality_report(df, "x")).where("warn"), "name", "metric")
    assert ("d", "mean") in warned and ("i", "count") in warned


def test_grouped_auc_against_brute_force(spark):
    import random

    from recspark.operators import evaluate

    rnd = random.Random(3)
    rows = [(rnd.choice(["big", "big", "big", "small", None]), rnd.randrange(2), rnd.randrange(40) / 40) for _ in range(400)] + [("one", 1, 0.5)]
    df = spark.createDataFrame(rows, "s string, label int, score double")

    def area(own):
        pos, neg = [x[2] for x in own if x[1]], [x[2] for x in own if not x[1]]
        return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg)) if pos and neg else 0.5

    want = {g: round(area([r for r in rows if r[0] == g]), 9) for g in ("big", "small", None, "one")}
    assert {r.s: r.auc for r in evaluate.group_auc(df, ["s"]).collect()} == want
    assert evaluate.auc(df).first().auc == round(area(rows), 9) and evaluate.auc(df.limit(0)).first().auc == 0.5
    assert abs(evaluate.auc_check(df) - area(rows)) < 1e-6


def test_global_index_of_ties_and_clashing_names(spark):
    from recspark.operators.indexing import global_index

    df = spark.createDataFrame([(1, i % 3, i) for i in range(60)] + [(None, None, None)], "part int, start int, at int")
    runs = [{tuple(r) for r in global_index(df, [F.col("start")], "n", partitions=k).collect()} for k in (3, 3, 7)]
    assert runs[0] == runs[1] == runs[2] and sorted(r[3] for r in runs[0]) == list(range(61))
    within = global_index(df, [F.col("at")], "idx", within=["start"]).collect()
    assert all(r.idx == (0 if r.at is None else r.at // 3) for r in within)


def test_genre_statistics_of_windows(spark):
    from recspark.functions import scalars as X

    el = "array<struct<item_id string, rating int, ts long, genres array<string>>>"
    rows = [(10 * 86400, [("a", 4, 10 * 86400 - 5, ["x", "y"]), ("b", 1, 8 * 86400, ["y"]), ("c", 5, 86400, None), ("d", 2, 10 * 86400, ["z"])]), (5, [])]
    df = spark.createDataFrame(rows, f"t long, h {el}")
    h = X.within(F.col("h"), F.col("t"), None)
    for d in (None, 1, 3):
        two = df.select(X.genre_stats(X.within(F.col("h"), F.col("t"), d)).alias("a"), X.stats_within(X.genre_elements(h), F.col("t"), d).alias("b")).collect()
        assert all(r.a == r.b for r in two)
    assert [tuple(x) for x in two[0].b] == [("x", 1, 4.0), ("y", 2, 2.5)]


def test_segments_and_flat_columns(spark):
    from recspark.operators import encode, evaluate

    seg = spark.createDataFrame([("u", "2024-01-01", "new"), ("u", "2024-01-02", "old")], "user_id string, day string, age_level string")
    preds = spark.createDataFrame([("u", 0.5), ("v", 0.1)], "user_id string, score double")
    assert sorted((r.user_id, r.age_level) for r in evaluate.with_segments(preds, seg, "user_id", "2024-01-02").collect()) == [("u", "new"), ("v", None)]
    flat = encode.flat_columns(spark.createDataFrame([(1, ["R:"], [0], [1.0])], "id int, f_raw array<string>, f_index array<long>, f_value array<float>"))
    assert flat.first().asDict(True) == {"id": 1, "f": {"raw": ["R:"], "index": [0], "value": [1.0]}}


@pytest.mark.parametrize("fetched", [1, 40, 20_000])
@pytest.mark.parametrize("spread", [1, 4, 10**6])
def test_ratio_split_is_exact_with_ties(spark, monkeypatch, fetched, spread):
    monkeypatch.setattr(indexing, "FETCHED_ROWS", fetched)
    rng = random.Random(spread)
    data = [(rng.randrange(spread), rng.randrange(3), rng.choice([None, "x"])) for _ in range(997)]
    df = spark.createDataFrame(data, "t long, id int, note string")
    order = [F.col("t"), F.col("id")]
    for train, val in ((0.8, 0.1), (0.0, 0.5), (0.999999, 0.0), (0.3, 0.7)):
        got = split.time_ratio_split(df, order, train, val).collect()
        a, b = int(997 * train), int(997 * val)
        parts = {s: sorted((r.t, r.id) for r in got if r.split == s) for s in ("train", "val", "test")}
        want = sorted((t, i) for t, i, _ in data)
        assert (parts["train"], parts["val"], parts["test"]) == (want[:a], want[a : a + b], want[a + b :])
        assert sorted((r.t, r.id, r.note or "") for r in got) == sorted((t, i, x or "") for t, i, x in data)


def test_ratio_split_of_nulls_text_and_no_rows(spark):
    data = [(None, "a"), (None, "b"), (3, None), (1, "c"), (2, "d"), (2, "d"), (2, "d"), (2, "d"), (9, "e"), (5, "f")]
    df = spark.createDataFrame(data, "t long, s string")
    for order in (["t"], ["s"], ["t", "s"]):
        got = split.time_ratio_split(df, [F.col(c) for c in order], 0.5, 0.2)
        assert {r.split: r["count"] for r in got.groupBy("split").count().collect()} == {"train": 5, "val": 2, "test": 3}
        first = [tuple(r) for r in df.orderBy(*order).limit(5).select(*order).collect()]
        assert sorted(map(str, first)) == sorted(str(tuple(r)) for r in got.where("split = 'train'").select(*order).collect())
    assert split.time_ratio_split(df.limit(0), [F.col("t")], 0.8, 0.1).collect() == []


def test_ratio_split_writes_and_shuffles_no_row(spark):
    df = spark.range(100_000).select((F.col("id") * 7919 % 100_003).alias("t"))
    out = split.time_ratio_split(df, [F.col("t")], 0.8, 0.1)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Scan parquet" not in plan and "Window" not in plan
    assert out.groupBy("split").count().where("split = 'train'").first()["count"] == 80_000


def _plain_registry():
    r = registry.Registry()
    r.register("ids", 1, registry.CATEGORICAL, lambda: registry.id_list(F.col("history")))
    r.register("same_ids", 1, registry.CATEGORICAL, lambda: registry.number(F.col("item")))
    r.register("words", 2, registry.CATEGORICAL, lambda: registry.string_list(F.col("words")))
    r.register("mean", 3, registry.CONTINUOUS, lambda: registry.continuous(F.col("mean")))
    r.cross("both", 9, ["same_ids", "words"], True)
    return r


@pytest.mark.parametrize("near", [1, 2, 7, 500])
def test_rows_are_encoded_as_their_tokens_are(spark, near):
    rng = random.Random(near)
    data = []
    for i in range(60):
        history = [(str(rng.randrange(9)), float(rng.randrange(1, 6))) for _ in range(rng.randrange(5))] if i % 7 else None
        words = [rng.choice(["a", "b", "ä b", "", None]) for _ in range(rng.randrange(4))] if i % 5 else None
        data.append((i, rng.choice([None, "0", "3", "8", "x"]), history, words, rng.choice([None, 0.5, 2.25]), "kept", "pos"))
    df = spark.createDataFrame(data, "sample_id long, item string, history array<struct<item_id:string,rating:double>>, words array<string>, mean double, c0 string, far string")
    r = _plain_registry()
    tokens = r.tokens(df)
    pos_map = vocab.build_pos_map(vocab.value_stats(tokens), 2)
    # what is unknown is left out
    pos_map = pos_map.where("key not in ('4', 'b')")
    want = {row["sample_id"]: row for row in encode.encode_vocab(tokens, pos_map, r, keys=df.select("sample_id")).collect()}
    got = encode.encode_rows(df, pos_map, r, keep=["c0", "far"], near_values=near).collect()
    assert len(got) == 60 and {(x["c0"], x["far"]) for x in got} == {("kept", "pos")}
    for x in got:
        assert {c: x[c] for c in want[x["sample_id"]].asDict()} == want[x["sample_id"]].asDict()
    assert encode.encode_rows(df.limit(0), pos_map, r, near_values=near).collect() == []
    nothing = encode.encode_rows(df, pos_map.limit(0), r, near_values=near).first()
    assert nothing["ids_raw"] == ["R:"] and nothing["words_index"] == [0] and len(nothing["mean_value"]) == 2 and nothing["has_feature"]


def test_encoding_of_a_common_value_shuffles_nothing(spark):
    df = spark.range(1000).select(F.col("id").alias("sample_id"), F.lit("1").alias("item"), F.array().cast("array<struct<item_id:string,rating:double>>").alias("history"), F.array(F.lit("w")).alias("words"), F.lit(1.0).alias("mean"))
    r = _plain_registry()
    out = encode.encode_rows(df, vocab.build_pos_map(vocab.value_stats(r.tokens(df)), 2), r)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.where("same_ids_index = array(0L, 1L) and words_index = array(0L, 1L)").count() == 1000


def test_defaults_labels_and_item_features(spark):
    df = spark.createDataFrame([("a", None), (None, 2), ("b", 3)], "s string, n long")
    assert rows(clean.defaults(df, {"s": "none", "n": 0}), "s", "n") == [("a", 0), ("b", 3), ("none", 2)]
    labels = spark.createDataFrame([(x,) for x in "aaabbc"], "label string")
    assert [tuple(r) for r in quality.label_distribution(labels, k=2).collect()] == [("a", 3, 0.5), ("b", 2, 0.333333)]
    assert quality.label_distribution(labels).count() == 3
    assert quality.label_distribution(labels.limit(0)).collect() == []
    positives = spark.createDataFrame([("u", "i", 5, "old"), ("v", "j", 4, "old")], "user_id string, item_id string, rating int, title string")
    negatives = spark.createDataFrame([("u", "i", "k", 1), ("u", "i", "unknown", 2)], "user_id string, item_id string, cand string, rk int")
    items = spark.createDataFrame([("k", "new"), ("i", "own")], "item_id string, title string")
    got = sampling.with_negatives(positives, negatives, items)
    assert rows(got.fillna("-"), "user_id", "item_id", "rating", "title", "label") == [("u", "i", 5, "old", 1), ("u", "k", 0, "new", 0), ("u", "unknown", 0, "-", 0), ("v", "j", 4, "old", 1)]


def test_profiles_merge(spark):
    from recspark.operators import profiles

    df = spark.range(20000).select(
        (F.col("id") % 7).cast("string").alias("day"), F.concat(F.lit("u"), F.col("id") % 3000).alias("name"),
        F.when(F.col("id") % 10 > 0, (F.col("id") * 37 % 1000).cast("double")).alias("total"), F.lit(None).cast("int").alias("empty"), F.col("id").cast("decimal(12,2)").alias("d"),
    )
    df = df.unionByName(spark.createDataFrame([(None, None, None, None, None)], df.schema))
    days = profiles.column_profiles(df, ["day"])
    assert days.count() == 8 * 4
    got = {r.name: r for r in profiles.report(profiles.merged_profiles(days), "x").collect()}
    want = {r.name: r for r in quality.quality_report(df.drop("day"), "x").collect()}
    assert set(got) == set(want)
    for name, w in want.items():
        g = got[name]
        assert (g.total_count, g.type, g.null_count, g.null_ratio, g.min, g.max) == (w.total_count, w.type, w.null_count, w.null_ratio, w.min, w.max)
        assert (g.mean, g.stddev) == (w.mean, w.stddev) or (g.mean == pytest.approx(w.mean) and g.stddev == pytest.approx(w.stddev))
        assert g.cardinality == w.cardinality or abs(g.cardinality - w.cardinality) < 0.04 * w.cardinality
    # in two steps as in one, and quantiles within their error
    halves = profiles.merged_profiles(days.withColumn("half", F.col("day") < "3"), ["half"])
    assert {r.name: r.mean for r in profiles.merged_profiles(halves).collect()} == pytest.approx({r.name: r.mean for r in profiles.merged_profiles(days).collect()})
    for r in profiles.quantiles(profiles.merged_profiles(days), [0.1, 0.5, 0.9]).collect():
        assert r.name in ("total", "d") and abs(r.value / (1000 if r.name == "total" else 20000) - r.share) < 0.02
    assert profiles.column_profiles(df.limit(0), ["day"]).count() == 0 == profiles.merged_profiles(days.limit(0)).count()


def test_drift_of_distributions(spark):
    from recspark.operators import profiles

    df = spark.range(5000).select(F.col("id").cast("double").alias("same"), (F.col("id") % 100).alias("moved"), F.lit(None).cast("double").alias("none"))
    now = df.withColumn("moved", F.when(F.col("moved") < 50, F.col("moved")).otherwise(F.col("moved") + 100))
    late = df.withColumn("moved", F.col("moved") + 30)
    a, b, c = (profiles.column_profiles(x) for x in (df, now, late))
    got = {r.name: (r.distance, r.warn) for r in profiles.distribution_drift(b, a).collect()}
    assert set(got) == {"same", "moved"} and not got["same"][1] and got["same"][0] < 0.03 and got["moved"][1] and abs(got["moved"][0] - 0.5) < 0.06
    assert abs({r.name: r.distance for r in profiles.distribution_drift(c, a).collect()}["moved"] - 0.3) < 0.04


def _events(n, seed):
    """Rows of a heavy user, of some others and of none, with ties, repeats and nulls."""
    rnd = random.Random(seed)
    day = 86400
    made = [(i, rnd.choice(["h"] * 6 + ["a", "b", None]), rnd.choice("xyzw"), rnd.choice([1, 2, 3, 4, 5, 5, None]), rnd.choice([None, 5 * day, *[rnd.randrange(60 * day) for _ in range(20)]])) for i in range(n)]
    return made + [(n + k, *r[1:]) for k, r in enumerate(made[:20])]


EVENTS = "sample_id int, user_id string, item_id string, rating int, time_stamp long"


def _before(events, user, t, days=None):
    return [] if t is None else [e for e in events if e[1] == user and e[4] is not None and e[4] < t and (days is None or e[4] >= t - days * 86400)]


def _close(got, want):
    assert got.keys() == want.keys()
    for k, w in want.items():
        assert got[k] == pytest.approx(w, abs=1e-9), k


def test_stats_before_by_brute_force(spark):
    data = _events(300, 1)
    df = spark.createDataFrame(data, EVENTS)
    # other samples than the events, with a user who has no events, and columns of the helpers' and the results' names
    asked = [(i, r[1] if i % 5 else "new", r[4] and r[4] + i % 3) for i, r in enumerate(data)]
    samples = spark.createDataFrame(asked, "sample_id int, user_id string, time_stamp long").withColumns({"at": F.lit(1), "kind": F.lit("k"), "w": F.lit(2), "cnt_all": F.lit(9)})
    want = {}
    for i, user, t in asked:
        row = []
        for d in (None, 3, 30):
            own = _before(data, user, t, d)
            rated = [e[3] for e in own if e[3] is not None]
            row += [len(own), np.mean(rated) if rated else 3.0, np.std(rated) if rated else 0.0]
        want[i] = tuple(row)
    out = point_in_time.stats_before(samples, df, days=(3, 30))
    assert set(samples.columns) <= set(out.columns) and len(out.columns) == len(set(out.columns))
    names = [f"{c}_{d}" for d in ("all", 3, 30) for c in ("cnt", "avg", "std")]
    got = {r.sample_id: tuple(r[n] for n in names) for r in out.collect()}
    _close(got, want)
    halves = df.withColumn("rating", F.col("rating") / 2)
    half = {r.sample_id: r.avg_30 for r in point_in_time.stats_before(samples, halves, days=(30,), unit=0.5).collect()}
    _close(half, {i: w[7] if not w[6] or w[7] == 3.0 and not any(e[3] is not None for e in _before(data, asked[i][1], asked[i][2], 30)) else w[7] / 2 for i, w in want.items()})
    assert point_in_time.stats_before(samples.limit(0), df).count() == 0
    assert {r.cnt_all for r in point_in_time.stats_before(samples, df.limit(0)).collect()} == {0}


def test_stats_before_agree_with_range_windows(spark):
    data = [(i, *r[1:]) for i, r in enumerate(r for r in _events(200, 2) if r[4] is not None)]
    df = spark.createDataFrame(data, EVENTS)
    names = [f"{c}_{d}" for d in ("all", *windows.DAYS) for c in ("cnt", "avg", "std")]
    a, b = ({r.sample_id: tuple(r[n] for n in names) for r in x.collect()} for x in (windows.as_of_stats(df), point_in_time.stats_before(df, df)))
    _close(a, b)


@pytest.mark.parametrize("n, chunk", [(3, 4), (5, 5), (7, 2), (50, 1000)])
def test_sequences_before_by_brute_force(spark, n, chunk):
    data = _events(250, n)
    df = spark.createDataFrame(data, EVENTS).withColumns({"part": F.lit("p"), "e": F.lit(1), "history": F.lit(0)})
    out = point_in_time.sequences_before(df, n, chunk=chunk)
    assert len(out.columns) == len(df.columns)
    got = {r.sample_id: [tuple(x) for x in r.history] for r in out.collect()}
    assert len(got) == len(data)
    for i, user, _, _, t in data:
        own = sorted(_before(data, user, t), key=lambda e: (-e[4], e[2], -(e[3] or 0)))
        assert got[i] == [(e[2], e[3], e[4]) for e in own[:n]]
    assert point_in_time.sequences_before(df.limit(0), n).count() == 0


def test_sequences_before_make_lists_after_the_last_shuffle_and_split_a_user(spark):
    df = spark.range(4000).select(F.col("id").alias("sample_id"), F.lit("u").alias("user_id"), F.col("id").cast("string").alias("item_id"), F.lit(3).alias("rating"), F.col("id").alias("time_stamp"))
    coalesced = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesced, "false")
    try:
        out = point_in_time.sequences_before(df, 10, chunk=100)
        lines = out._jdf.queryExecution().executedPlan().toString().split("\n")
        made = next(i for i, x in enumerate(lines) if "collect_list" in x)
        assert not any("Exchange" in x for x in lines[:made])
        # the lists are read, or they and the shuffle before them would be pruned
        sizes = [r.n for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.sum(F.size("history"))).collect()]
    finally:
        spark.conf.unset(coalesced)
    assert sum(sizes) == 4000 and len(sizes) > 1 and max(sizes) < 3000


def test_genre_windows_need_no_rows_of_their_own(spark, monkeypatch):
    dealt, own = [], point_in_time.running_sums

    def counted(df, *args, **more):
        dealt.append(df.count())
        return own(df, *args, **more)

    monkeypatch.setattr(point_in_time, "running_sums", counted)
    df = spark.createDataFrame([(i, "u", "a", 3, i * 86400) for i in range(10)], "sample_id long, user_id string, item_id string, rating int, time_stamp long")
    items = spark.createDataFrame([("a", ["x"])], "item_id string, genres array<string>")
    got = {r.sample_id: (r.hit_all, r.hit_1, r.hit_15) for r in point_in_time.same_genre_before(df, df, items).collect()}
    assert got == {i: (2, 2, 2) if i else (1, 1, 1) for i in range(10)}
    assert dealt == [20]


def test_same_genre_before_by_brute_force(spark):
    data = _events(200, 3)
    genres = {"x": ["g", "h"], "y": ["h"], "z": None, "w": ["i", "g", "g", None]}
    items = spark.createDataFrame([*genres.items(), ("v", ["g"])], "item_id string, genres array<string>")
    df = spark.createDataFrame(data, EVENTS)
    got = {r.sample_id: (r.hit_all, r.hit_3, r.same_genre_rate) for r in point_in_time.same_genre_before(df, df, items, (3,)).collect()}
    want = {}
    for i, user, item, _, t in data:
        own = set(genres[item] or [])
        of = {d: [(e, g) for e in _before(data, user, t, d) for g in set(genres[e[2]] or []) & own] for d in (None, 3)}
        rates = []
        for g in own:
            seen = [e for e, x in of[None] if x == g]
            if seen:
                rated = [e[3] for e in seen if e[3] is not None]
                rates.append(np.mean(rated) if rated else 3.0)
        want[i] = (2 if of[None] else 1, 2 if of[3] else 1, np.mean(rates) if rates else 3.0)
    _close(got, want)


def test_samples_with_histories_as_of_each_sample(spark):
    ix = spark.createDataFrame([("u", "a", 3, 10), ("u", "a", 4, 20), ("u", "b", 5, 30), ("v", "a", 2, 1)], "user_id string, item_id string, rating int, time_stamp long")
    items = spark.createDataFrame([("a", "A (1990)", ["g"]), ("b", "B (1991)", ["h", "i"])], "item_id string, title string, genres array<string>")
    users = spark.createDataFrame([("u", "M", "25", "1", "0")], "user_id string, gender string, age string, occupation string, zip_code string")
    snapshot, as_of = (training.samples(ix, items, users, 2, as_of=x) for x in (False, True))
    assert sorted(snapshot.columns) == sorted(as_of.columns) and dict(snapshot.dtypes)["history"] == dict(as_of.dtypes)["history"]
    seen = lambda df: {(r.user_id, r.time_stamp): [(h.item_id, h.rating, h.genres) for h in r.history] for r in df.collect()}
    assert seen(as_of) == {("u", 10): [], ("u", 20): [("a", 3, ["g"])], ("u", 30): [("a", 4, ["g"]), ("a", 3, ["g"])], ("v", 1): []}
    assert seen(snapshot)["u", 20] == [] and seen(snapshot)["u", 30] == [("a", 4, ["g"])]
    tokens = training.default_registry().tokens(as_of.withColumn("sample_id", F.monotonically_increasing_id()))
    assert tokens.where("field_name = 'user_movie_rate_cnt_continue'").agg(F.sum("value")).first()[0] == 3


def test_window_stats_of_a_long_history_take_linear_time(spark):
    import math
    import time

    from recspark.operators.windows import snapshot_stats

    n = 8000
    history = "transform(sequence(0, {}), i -> named_struct('item_id', string(i), 'rating', int(1 + i % 5), 'ts', 100 * 86400L - i))".format(n - 1)
    df = spark.range(1).selectExpr("id AS sample_id", "100 * 86400L + 1 AS time_stamp", f"{history} AS history")
    began = time.time()
    row = snapshot_stats(df).first()
    assert time.time() - began < 60  # the mean was made anew at each element: minutes
    assert row.cnt_all == row.cnt_1 == n and row.avg_all == row.avg_30 == 3.0
    assert math.isclose(row.std_all, math.sqrt(2)) and math.isclose(row.std_1, math.sqrt(2))


def test_genre_counts_and_means_of_own_genres_are_those_of_genre_stats(spark):
    from recspark.functions import scalars as X

    el = "array<struct<item_id string, rating int, ts long, genres array<string>>>"
    h = [("a", 4, 5, ["x", "y"]), ("b", 1, 4, ["y", "y"]), ("c", 5, 3, None), ("d", 2, 2, ["z"]), ("e", 3, 1, [])]
    df = spark.createDataFrame([(h, ["y", "z", "q"]), (h, ["y", "y"]), (h, []), ([], ["x"]), (h[2:3], ["x"])], f"h {el}, own array<string>")
    stats = X.genre_stats(F.col("h"))
    got = df.select(X.top_genres(stats).alias("a"), X.top_genres(X.genre_counts(F.col("h"))).alias("b"), X.same_genre_mean(stats, F.col("own")).alias("c"), X.same_genre_mean_of(F.col("h"), F.col("own")).alias("d")).collect()
    assert all(r.a == r.b and r.c == r.d for r in got)
    assert [r.d for r in got] == [2.25, 2.5, 3.0, 3.0, 3.0] and [tuple(g) for g in got[0].b] == [("y", 2), ("x", 1), ("z", 1)]


def test_joined_samples_carry_no_sequence_through_a_shuffle(spark):
    ix = spark.createDataFrame([("1", "10", 5, 100)], "user_id string, item_id string, rating int, time_stamp long")
    users = spark.createDataFrame([("1", "M", "25", "0", "48067")], "user_id string, gender string, age string, occupation string, zip_code string")
    stats = spark.createDataFrame([("10", "t", ["a"], 1, 1, 5.0, 1)], "item_id string, title string, genres array<string>, genre_cnt int, rate_count long, avg_rate double, hot_rank long")
    seqs = spark.createDataFrame([("1", [("10", 5, 100)])], "user_id string, seq array<struct<item_id string, rating int, ts long>>")
    out = sequences.join_samples(ix, users, seqs, stats)
    assert out.columns == ["item_id", "user_id", "rating", "time_stamp", "user_profile", "user_behavior", "item_feature"] and out.first().item_feature.title == "t"
    joins = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join LeftOuter" in line]
    assert len(joins) == 3 and "user_id" in joins[0] and "item_id" in joins[2]


def test_histories_come_where_features_are_made(spark):
    ix = spark.createDataFrame([(1, "1", "10", 5, 100), (2, "1", "11", 3, 200), (3, "1", "10", 4, 300), (4, "2", "11", 2, 50)], "sample_id long, user_id string, item_id string, rating int, time_stamp long")
    items = spark.createDataFrame([("10", "Toy Story (1995)", ["animation", "comedy"]), ("11", "Heat (1985)", ["action"])], "item_id string, title string, genres array<string>")
    users = spark.createDataFrame([("1", "M", "25", "0", "48067")], "user_id string, gender string, age string, occupation string, zip_code string")
    thin = training.plain_samples(ix, items, users)
    assert "history" not in thin.columns
    r = training.default_registry(["user_id", "movie_id", "user_movie_rate_ids", "user_rate_avg"])
    late = training.reading_histories(r, training.histories(ix, items))
    want = rows(r.tokens(training.samples(ix, items, users)), "sample_id", "field_name", "ord", "key", "value")
    assert rows(late.tokens(thin), "sample_id", "field_name", "ord", "key", "value") == want
    pos = vocab.build_pos_map(vocab.value_stats(late.tokens(thin)), 2)
    texts = encode.encode_text(encode.vocab_tokens(late.tokens(thin), pos).where("field_type = 1"), "sample_id")
    for near in (1, 500):
        assert rows(encode.encoded_text(encode.encode_rows(thin, pos, late, near_values=near), late), "sample_id", "field_name", "text") == rows(texts, "sample_id", "field_name", "text")
    only = late.tokens(thin, only=["movie_id"])
    assert {x.field_name for x in only.collect()} == {"movie_id"}


def _with_odd_histories(spark):
    """Samples and histories with ties in time, later and missing times, number 0, unknown genres, and users of one side only."""
    kind = "user_id string, seq array<struct<item_id:string,rating:int,ts:bigint,genres:array<string>>>"
    a = [("3", 5, 30, ["x", "y"]), ("0", 1, 20, ["y"]), ("9", None, 20, [None]), ("3", 2, 10, None), ("4", 4, 5, []), ("5", 3, None, ["x"])]
    seqs = spark.createDataFrame([("a", a), ("b", [("3", 1, 7, ["x"])]), ("c", []), ("d", None), (None, [("8", 1, 1, ["z"])])], kind)
    rows = [(i, u, t) for i, (u, t) in enumerate([("a", 30), ("a", 31), ("a", 20), ("a", 21), ("a", 5), ("a", 6), ("a", None), ("b", 8), ("b", 8), ("b", 7), ("c", 9), ("d", 9), ("e", 9), (None, 9)])]
    return spark.createDataFrame(rows, "sample_id long, user_id string, time_stamp long"), seqs


@pytest.mark.parametrize("genres", [4, 900])
def test_default_features_are_counted_without_tokens_of_rows(spark, genres):
    """Feature statistics of all default features made some 300 tokens a row. Here times lie half days apart, so that windows end at elements."""
    rng, day, names = random.Random(genres), 86400, [*[f"g{i}" for i in range(genres)], None]
    some = lambda: None if rng.random() < 0.1 else [rng.choice(names) for _ in range(rng.randrange(4))]
    when = lambda: None if rng.random() < 0.05 else rng.randrange(80) * day // 2
    seqs = [(str(u), [(rng.choice(["0", "007", "x", *"123456"]), None if rng.random() < 0.02 else rng.randrange(8) / 2, when(), some()) for _ in range(2 * u)]) for u in range(12)]
    seqs = spark.createDataFrame([*[(u, sorted(seq, key=lambda e: -(e[2] or 0))) for u, seq in seqs], ("none", None)], "user_id string, seq array<struct<item_id:string,rating:double,ts:bigint,genres:array<string>>>")
    users = [*[str(u) for u in range(12)], "none", "unknown", None]
    profile = lambda: None if rng.random() < 0.1 else (rng.choice(["M", "F", None]), rng.choice(["0", "25", "x", None]), rng.choice(["0", "3"]), "z")
    item = lambda: None if rng.random() < 0.1 else (rng.choice(["A b (1999)", "A", "", None]), some(), rng.choice([0, 7, None]), rng.choice([2.5, 0.0, None]), rng.choice([1, 300, None]))
    rows = [(i, rng.choice(users), rng.choice(["0", "1", "02", "x", None]), when(), profile(), item()) for i in range(150)]
    kind = "sample_id long, user_id string, item_id string, time_stamp long, user_profile struct<gender:string,age:string,occupation:string,zip_code:string>,"
    df = spark.createDataFrame(rows, kind + "item_feature struct<title:string,genres:array<string>,rate_count:long,avg_rate:double,hot_rank:long>")
    plain, late = (training.reading_histories(training.default_registry(), seqs, *n) for n in ((), (200,)))
    assert not plain.by_history() and len(late.by_history()) == 50

    def near(stats):
        return sorted(((*r[:5], *[x if x is None else round(x, 7) + 0.0 for x in r[5:]]) for r in stats.collect()), key=repr)

    want = near(vocab.value_stats(plain.tokens(df)))
    assert {r[0] for r in want} == {f.name for f in late.active()}
    counted = {f.name for f in late.by_history()}
    narrow = vocab._pooled(history_stats.partial_stats(df, seqs, late.by_history(), 5))
    assert near(narrow) == [r for r in want if r[0] in counted]
    for f in late.by_history():
        f.build = lambda: F.lit("their rows are made").try_cast("array<int>")
    assert near(vocab.feature_stats(late, df)) == want
    assert vocab.feature_stats(late, df.limit(0)).count() == 0


def test_features_of_single_elements_are_counted_once_an_element(spark):
    df, seqs = _with_odd_histories(spark)
    names = ["user_id", "context_time_hour", "user_rate_avg_continue", "user_movie_rate_ids", "user_movie_rate_genres"]
    plain, once = (training.reading_histories(training.default_registry(names), seqs, *n) for n in ((), (200,)))
    assert not plain.by_element() and [f.name for f in once.by_element()] == names[3:]
    assert not training.reading_histories(training.default_registry(names), seqs, 201).by_element()  # longer than what id_list reads

    def near(stats):
        return sorted(((*r[:5], *[x if x is None else round(x, 9) for x in r[5:]]) for r in stats.collect()), key=repr)

    want = near(vocab.value_stats(plain.tokens(df)))
    assert sum(r[4] for r in want if r[0] == "user_movie_rate_ids") == 15
    assert near(vocab.feature_stats(once, df)) == want == near(vocab.feature_stats(plain, df))
    assert vocab.feature_stats(once, df.limit(0)).count() == 0
    for f in once.by_element():
        f.build = lambda: F.lit("their rows are made").try_cast("array<int>")
    only = training.reading_histories(training.default_registry(names[3:]), seqs, 200)
    assert near(vocab.feature_stats(only, df)) == [r for r in want if r[0] in names[3:]]
    # large values of small deviation don't cancel out
    big = spark.createDataFrame([("a", [(1, 1e9 + i % 2, i, ["x"]) for i in range(9, -1, -1)])], "user_id string, seq array<struct<item_id:int,rating:double,ts:bigint,genres:array<string>>>")
    late = training.reading_histories(training.default_registry(names[3:]), big, 200)
    assert {round(r["m2"], 6) for r in vocab.feature_stats(late, spark.createDataFrame([(1, "a", 99)], "sample_id long, user_id string, time_stamp long")).collect()} == {2.5}
