import numpy as np
import pytest
from pyspark.sql import functions as F

from recspark.functions import hashing, scalars


# Known answers of the hash.
@pytest.mark.parametrize(("text", "want"), [("drama", 8777457710180681631), ("action", 206703141730408514), ("children's", -973156381079144742), ("sci-fi", -6650108276474973562), ("film-noir", 8908857926935910255), ("Toy", -8730465843384341787), ("10001", 5553958342748052043)])
def test_string_hash(text, want):
    assert hashing.hash_bytes([text.encode()]).tolist() == [want]


def test_key_hashes():
    drama = int(hashing.hash_bytes([b"drama"])[0])
    got = hashing.hash_keys(np.array([[2, 25], [3, 1], [3, 2], [101, 1193], [1, 1], [103, drama]])).tolist()
    assert got == [880261039419908939, 88799376391689173, 475592809992177890, 588200793609881586, 150436848691021846, 791854417100329393]
    assert hashing.hash_keys(np.array([[2, 25, 3, 1]])).tolist() == [762837220344613912]


def test_hash_agrees_with_guava(spark):
    guava = spark._jvm.com.google.common.hash.Hashing.murmur3_128(hashing.SEED)
    for text in ["", "a", "x" * 15, "x" * 16, "x" * 17, "é" * 20, "y" * 100]:
        assert hashing.hash_bytes([text.encode()]).tolist() == [guava.hashBytes(bytearray(text.encode())).asLong()]


def test_hash_columns(spark):
    df = spark.createDataFrame([("drama",), (None,)], "s string")
    assert [r[0] for r in df.select(hashing.string_id(F.col("s"))).collect()] == [8777457710180681631, None]


def test_times(spark):
    df = spark.createDataFrame([("978300760",), ("978300760000",), ("20010101120000",), ("2001-01-01 12:00:00",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(scalars.to_millis(F.col("t"))).collect()] == [978300760000, 978300760000, 20010101120000, 978350400000, None, None]
    one = spark.range(1).select(scalars.day_of(F.lit(978300760)), scalars.hour_of(F.lit(978300760)), scalars.weekday_of(F.lit(978300760)), scalars.shift_day(F.lit("2024-03-01"), -1)).first()
    assert tuple(one) == ("2000-12-31", 22, 7, "2024-02-29")


def test_titles(spark):
    df = spark.createDataFrame([("Toy Story (1995)",), ("Plain",), (" A  B (x) (2001) ",)], "t string")
    got = df.select(scalars.release_year(F.col("t")).alias("y"), scalars.title_tokens(F.col("t")).alias("k")).collect()
    assert [(r.y, r.k) for r in got] == [(1995, ["Toy", "Story"]), (1990, ["Plain"]), (2001, ["A", "B", "(x)"])]
    assert spark.range(1).select(scalars.genre_list(F.lit("Sci-Fi| Drama |"))).first()[0] == ["sci-fi", "drama"]


@pytest.mark.parametrize(
    ("rule", "values", "want"),
    [
        (scalars.rate_std_bucket, [0.0, 0.5, 1.0, 2.0, 2.1], [1, 2, 2, 3, 4]),
        (scalars.rate_avg_bucket, [0.0, 2.9, 3.0, 3.9, 4.0], [1, 2, 3, 3, 4]),
        (scalars.rate_count_bucket, [0.0, 10.0, 11.0, 100.0, 101.0], [1, 2, 3, 5, 6]),
        (scalars.item_count_bucket, [0.0, 2.0, 3.0, 1000.0, 1001.0], [1, 2, 3, 10, 11]),
        (scalars.item_avg_bucket, [0.0, 2.5, 4.5, 5.0], [1, 4, 8, 9]),
        (scalars.hot_rank_bucket, [100.0, 101.0, 2000.0, 2001.0], [4, 3, 2, 1]),
        (scalars.year_bucket, [0.0, 1969.0, 1970.0, 1999.0, 2010.0], [1, 2, 3, 5, 7]),
        (scalars.genre_avg_bucket, [1.0, 1.5, 4.0, 4.1], [1, 2, 4, 5]),
    ],
)
def test_buckets(spark, rule, values, want):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    assert [r[0] for r in df.orderBy("i").select(rule(F.col("v"))).collect()] == want


def test_history_statistics(spark):
    h = "array<struct<item_id:string,rating:int,ts:bigint,genres:array<string>>>"
    day = scalars.DAY
    df = spark.createDataFrame([(10 * day, [("a", 5, 10 * day - 1, ["x", "y"]), ("b", 2, 9 * day, ["x"]), ("c", 1, 2 * day, None), ("d", 4, 10 * day, ["z"])]), (5, [])], f"now bigint, h {h}")
    w = lambda d: scalars.within(F.col("h"), F.col("now"), d)
    got = df.select(F.size(w(None)), F.size(w(1)), F.size(w(15)), scalars.mean_rating(w(1)), scalars.std_rating(w(1)), scalars.genre_stats(w(None)), scalars.top_genres(scalars.genre_stats(w(None)), 1)).collect()
    assert tuple(got[0][:5]) == (3, 2, 3, 3.5, 1.5)
    assert [tuple(x) for x in got[0][5]] == [("x", 2, 3.5), ("y", 1, 5.0)]
    assert [tuple(x) for x in got[0][6]] == [("x", 2)]
    assert tuple(got[1][:5]) == (0, 0, 0, 3.0, 0.0)
