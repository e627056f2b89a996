import gzip

import pytest
from pyspark.sql import functions as F

from recspark.operators import vocab
from recspark.sources import sinks, text, tfrecord
from recspark.sources.scratch import written


def test_delimited(spark, tmp_path):
    (tmp_path / "r.dat").write_text("1::2::5::9\nbroken::line\n1:: 3 ::4::8\n")
    df = text.read_delimited(spark, str(tmp_path / "r.dat"), "::", ["u", "i", "r", "t"])
    assert sorted(tuple(x) for x in df.collect()) == [("1", "2", "5", "9"), ("1", "3", "4", "8")]
    df = text.read_by_pattern(spark, str(tmp_path / "r.dat"), r"(\d+)::\s*(\d+)\s*::(\d)::(\d)", ["u", "i", "r", "t"])
    assert df.count() == 2


def test_prediction_log(spark, tmp_path):
    (tmp_path / "p.txt").write_text("u:i:d:r:dev:cn:1|0.5\nbad\nu:i:d:r:dev:cn:0|x\n")
    assert [(r.user_id, r.label, r.score) for r in text.read_prediction_log(spark, str(tmp_path / "p.txt")).collect()] == [("u", 1.0, 0.5)]


def test_scored_table_and_days(spark):
    df = spark.createDataFrame([("2024-01-01", "s", "a", '{"score": "0.5"}'), ("2024-01-02", "s", "a", "{}")], "day string, scene_id string, algo string, extra string")
    assert [r.score for r in text.scored_table(df, "2024-01-01", "s", "a").collect()] == [0.5]
    assert text.latest_day(df, "2024-01-01").first().day == "2024-01-01" and text.latest_day(df, "2023-01-01").first().day is None


SCHEMA = "id int, big long, f float, d double, flag boolean, s string, b binary, ls array<long>, fs array<float>, ss array<string>"
ROWS = [(1, 2**40, 0.5, 0.25, True, "é", b"\x00\xff", [1, -2], [0.5], ["a", "b"]), (2, -1, -1.0, 2.0, False, "", b"", [], None, ["x"]), (None,) * 10]


@pytest.mark.parametrize("codec", ["", "gzip"])
def test_tfrecord_roundtrip(spark, tmp_path, codec):
    df, path = spark.createDataFrame(ROWS, SCHEMA), f"file://{tmp_path}/t"
    tfrecord.write_tfrecord(df, path, codec=codec)
    back = tfrecord.read_tfrecord(spark, path, SCHEMA)
    assert sorted(map(tuple, back.collect()), key=str) == sorted([(*r[:5], r[5], r[6] and bytearray(r[6]) if r[6] is not None else None, *r[7:]) for r in ROWS], key=str)


def test_rows_of_one_task_are_dealt_to_files(spark, tmp_path):
    path = f"file://{tmp_path}/dealt"
    tfrecord.write_tfrecord(spark.range(0, 100, 1, 1), path, record_type="SequenceExample", tasks=4)
    files = [f for f, _ in tfrecord.listing(path)[0]]
    assert len(files) == 4
    assert sorted(r.id for r in tfrecord.read_tfrecord(spark, path, "id long", "SequenceExample").collect()) == list(range(100))
    assert [tuple(r) for r in tfrecord.infer_columns(spark, path, "SequenceExample").collect()] == [("id", "bigint")]


def test_sequence_example_and_inference(spark, tmp_path):
    df = spark.createDataFrame([(1, [[1.5], [2.0, 3.0]], ["a"]), (2, [[]], ["b", "c"])], "id long, ff array<array<float>>, ss array<string>")
    path = f"file://{tmp_path}/s"
    tfrecord.write_tfrecord(df, path, record_type="SequenceExample")
    assert tfrecord.infer_schema(spark, path, "SequenceExample").simpleString() == "struct<ff:array<array<float>>,id:bigint,ss:array<string>>"
    assert sorted(map(tuple, tfrecord.read_tfrecord(spark, path, record_type="SequenceExample").select("id", "ff", "ss").collect())) == [(1, [[1.5], [2.0, 3.0]], ["a"]), (2, [[]], ["b", "c"])]
    with pytest.raises(Exception):
        tfrecord.write_tfrecord(df, f"file://{tmp_path}/x")


def test_modes(spark, tmp_path):
    df, path = spark.createDataFrame([(1,)], "id long"), f"file://{tmp_path}/m"
    tfrecord.write_tfrecord(df, path)
    with pytest.raises(FileExistsError):
        tfrecord.write_tfrecord(df, path)
    tfrecord.write_tfrecord(df.limit(0), path, mode="ignore")
    assert tfrecord.read_tfrecord(spark, path, "id long").count() == 1
    tfrecord.write_tfrecord(df.union(df), path, mode="overwrite")
    assert tfrecord.read_tfrecord(spark, path, "id long").count() == 2
    with pytest.raises(ValueError):
        tfrecord.write_tfrecord(df, path, mode="append")
    with pytest.raises(TypeError):
        tfrecord.write_tfrecord(df.select(F.current_date().alias("d")), f"{path}2")


def test_frames():
    data = tfrecord.framed(b"abc") + tfrecord.framed(b"")
    assert list(tfrecord.records(data)) == [b"abc", b""] == list(tfrecord.records(gzip.compress(data)))
    assert tfrecord.crc32c(b"123456789") == 0xE3069283
    for bad in (data[:-1], data[:5], b"\x01" + data[1:], data[:13] + b"x" + data[14:]):
        with pytest.raises(ValueError):
            list(tfrecord.records(bad))


def test_example_bytes(spark):
    df = tfrecord.as_example(spark.createDataFrame([(1, "a")], "id long, s string"))
    m = tfrecord.message("Example")()
    m.ParseFromString(bytes(df.first().example))
    assert list(m.features.feature["id"].int64_list.value) == [1] and list(m.features.feature["s"].bytes_list.value) == [b"a"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(i, "train" if i % 2 else "test", i > 2) for i in range(10)], "id int, split string, parse_ok boolean")
    sinks.write_splits(df, f"{tmp_path}/splits")
    assert spark.read.parquet(f"{tmp_path}/splits").count() == 7
    sinks.write_partition(df, f"{tmp_path}/days", ["split"])
    sinks.write_partition(df.where("split = 'test'").limit(1), f"{tmp_path}/days", ["split"])
    assert spark.read.parquet(f"{tmp_path}/days").count() == 6
    mixed = [r.id for r in sinks.shuffled(df, "id", 3).collect()]
    assert sorted(mixed) == list(range(10)) and mixed == [r.id for r in sinks.shuffled(df, "id", 3).collect()]
    sinks.write_tsv(df.select("id", "split"), f"{tmp_path}/tsv")
    assert text.read_csv(spark, f"{tmp_path}/tsv", "id int, split string", header=False, sep="\t").count() == 10


def test_predictions_and_reports(spark, tmp_path):
    df = spark.createDataFrame([("u", 0.5, 1), ("v", 0.25, 0)], "user string, score float, label int")
    df.write.parquet(f"{tmp_path}/p")
    df.write.csv(f"{tmp_path}/c", header=True)
    for back in (text.read_predictions(spark, f"{tmp_path}/p", "parquet"), text.read_predictions(spark, f"{tmp_path}/c", "csv", header="true")):
        assert sorted((r.user, r.score, r.label) for r in back.collect()) == [("u", 0.5, 1.0), ("v", 0.25, 0.0)]
    sinks.write_report(spark.createDataFrame([("clean", 3, "x", "numeric", 1, 0.25)], "stage string, total_count long, name string, type string, null_count long, null_ratio double"), f"{tmp_path}/r")
    got = text.read_reports(spark, f"{tmp_path}/r").first()
    assert (got.stage, got.total_count, got.null_ratio, got.mean) == ("clean", 3, 0.25, None)


def test_days_of_partitions(spark):
    df = spark.createDataFrame([("2024-01-01", i) for i in range(5)] + [("2024-01-03", 9)], "day string, x int")
    assert text.last_day(df).first().day == "2024-01-03" and text.latest_day(df, "2024-01-02").first().day == "2024-01-01"
    assert text.partition_sample(df, "2024-01-01", 2).count() == 2 and text.partition_sample(df, "2024-01-02", 2).count() == 0
    assert text.last_day(df.limit(0)).first().day is None


def test_days_from_the_listing_open_no_file(spark, tmp_path):
    days = ["2024-01-01", "2024-01-03", "a b/c:d%20", None]
    spark.createDataFrame([(d, 1) for d in days], "day string, x int").write.partitionBy("day").parquet(f"{tmp_path}/t")
    df = spark.read.schema("x int, day string").parquet(f"{tmp_path}/t")
    for f in (tmp_path / "t").rglob("*.parquet"):
        f.write_bytes(b"not read")
    listed = text.listed_days(df)
    assert sorted(r.day for r in listed.collect()) == sorted(d for d in days if d)
    assert text.latest_day(listed, "2024-01-02").first().day == "2024-01-01"
    with pytest.raises(Exception):
        text.last_day(df.where("x > 0")).first()
    assert text.listed_days(df.limit(0), "x").count() == 0


def test_vocabulary_files(spark, tmp_path):
    schema = "field_index int, field_type int, key string, pos long, cnt long, sum double, sum_sq double, mean double, m2 double"
    v = spark.createDataFrame([(1, 1, "é", 1, 3, 3.0, 3.0, 1.0, 0.0), (1, 1, "b", 2, 2, 2.0, 2.0, 1.0, 0.0), (7, 0, "1", 1, 2, 4.0, 10.0, 2.0, 2.0)], schema)
    dims = spark.createDataFrame([("f", 1, 1, 3)], "field_name string, field_index int, field_type int, dim long")
    targets = spark.createDataFrame([(5, 0, 2)], "target int, idx long, cnt long")
    sinks.write_vocabulary(v, targets, dims, f"{tmp_path}/v")
    got, t, d = sinks.read_vocabulary(spark, f"{tmp_path}/v")
    assert sorted(map(tuple, got.select(*v.columns).collect())) == sorted(map(tuple, v.collect())) and t.first().idx == 0 and d.first().dim == 3
    back = sinks.vocabulary_from_json(sinks.vocabulary_json(v))
    assert sorted(map(tuple, back.select(*v.columns).collect())) == sorted(map(tuple, v.collect()))
    bare = spark.createDataFrame([(7, 0, '[{"pos":1,"key":"1","cnt":2,"sum":4.0,"sum_sq":10.0}]'), (1, 1, '[{"pos":1,"key":"a","cnt":2}]'), (2, 1, "[]")], "field_index int, field_type int, json string")
    assert sorted((r.field_index, r.key, r.mean, r.m2) for r in sinks.vocabulary_from_json(bare).collect()) == [(1, "a", 1.0, 0.0), (7, "1", 2.0, 2.0)]


def test_csv_with_and_without_header(spark, tmp_path):
    (tmp_path / "h.csv").write_text('id,name\n1,"a, b"\n2,\n')
    (tmp_path / "n.tsv").write_text("1\tx\n2\ty\n")
    assert [tuple(r) for r in text.read_csv(spark, str(tmp_path / "h.csv"), "id int, name string").collect()] == [(1, "a, b"), (2, None)]
    assert [tuple(r) for r in text.read_csv(spark, str(tmp_path / "n.tsv"), "id int, name string", header=False, sep="\t").collect()] == [(1, "x"), (2, "y")]


def test_format_reads_with_and_without_schema(spark, tmp_path):
    tfrecord.register(spark)
    path = f"file://{tmp_path}/a"
    tfrecord.write_tfrecord(spark.createDataFrame([(1, [1.5], None), (2, [], "x")], "id int, f array<double>, s string").repartition(2), path)
    got = spark.read.format("tfrecords").load(path)
    assert got.schema.simpleString() == "struct<f:float,id:bigint,s:string>" == tfrecord.infer_schema(spark, path).simpleString()
    assert sorted(map(tuple, got.select("id", "f", "s").collect())) == [(1, 1.5, None), (2, None, "x")]
    assert [r.id for r in spark.read.format("tfrecords").schema("id long").load(path).orderBy("id").collect()] == [1, 2]
    # another writer's files: no manifest, folders in folders, hidden files
    one = tfrecord.message("Example")()
    one.features.feature["n"].int64_list.value.extend([7, 8])
    (tmp_path / "b" / "c").mkdir(parents=True)
    (tmp_path / "b" / "c" / "x.tfrecord").write_bytes(tfrecord.framed(one.SerializeToString(), b""))
    (tmp_path / "b" / "_hidden").write_bytes(b"no record")
    foreign = spark.read.format("tfrecords").load(f"file://{tmp_path}/b")
    assert foreign.schema.simpleString() == "struct<n:array<bigint>>" and sorted((r.n for r in foreign.collect()), key=str) == [None, [7, 8]]
    with pytest.raises(Exception, match="infer_schema"):
        spark.read.format("tfrecords").option("inferBytes", 10).load(f"file://{tmp_path}/b").schema
    with pytest.raises(Exception, match="append"):
        got.write.format("tfrecords").mode("append").save(path)


def test_damaged_files_raise(spark, tmp_path):
    tfrecord.register(spark)
    data = tfrecord.framed(b"", b"")
    for i, bad in enumerate((data[:-1], data[:17], b"\x01" + data[1:], gzip.compress(data)[:-9], gzip.compress(data)[:20])):
        (tmp_path / f"{i}.tfrecord").write_bytes(bad)
        with pytest.raises(Exception, match="TFRecord"):
            spark.read.format("tfrecords").schema("id long").load(f"{tmp_path}/{i}.tfrecord").collect()


def test_checksums_are_those_of_single_bytes():
    def plain(data):
        c = 0xFFFFFFFF
        for b in data:
            c ^= b
            for _ in range(8):
                c = c >> 1 ^ (tfrecord.POLYNOMIAL if c & 1 else 0)
        return c ^ 0xFFFFFFFF

    datas = [bytes(i * 37 % 251 for i in range(n)) for n in (0, 1, 3, 4, 5, 63, 64, 65, 127, 128, 129, 1000, 8191)]
    assert [int(x) for x in tfrecord.checksums(datas)] == [plain(d) for d in datas] and len(tfrecord.checksums([])) == 0
    # a length whose bytes begin like a gzip file
    assert list(tfrecord.records(tfrecord.framed(bytes(0x8B1F), b"x"))) == [bytes(0x8B1F), b"x"]


class Stream:
    """A file of many records that is made as it is read."""

    def __init__(self, frame, times):
        self.frame, self.left, self.at, self.most = frame, times, b"", 0

    def peek(self, n):
        return self.frame

    def read(self, n):
        self.most = max(self.most, n)
        while len(self.at) < n and self.left:
            self.at, self.left = self.at + self.frame, self.left - 1
        out, self.at = self.at[:n], self.at[n:]
        return out


def test_a_stream_is_held_batch_by_batch():
    s = Stream(tfrecord.framed(bytes(1 << 20)), 40)
    sizes = [len(b) for b in tfrecord.record_batches(s)]
    assert sum(sizes) == 40 and max(sizes) <= tfrecord.BATCH_BYTES >> 20 and s.most <= tfrecord.BATCH_BYTES
    # a damaged length doesn't ask for the memory that it names
    with pytest.raises(ValueError):
        list(tfrecord.record_batches(Stream((1 << 60).to_bytes(8, "little") + bytes(8), 1), check=False))


@pytest.mark.parametrize("commit", ["swap", "manifest"])
def test_a_failed_commit_leaves_the_old_output(spark, tmp_path, monkeypatch, commit):
    tfrecord.register(spark)
    path = f"{tmp_path}/out"
    ids = lambda: sorted(r.id for r in spark.read.format("tfrecords").schema("id long").load(path).collect())
    for n in (3, 2):
        spark.range(n).repartition(2).write.format("tfrecords").mode("overwrite").option("commit", commit).save(path)
        assert ids() == list(range(n))
        assert sum(p.name.endswith(".tfrecord") for p in (tmp_path / "out").iterdir()) == 2 and (tmp_path / "out" / "_SUCCESS").exists()
    # a task fails: nothing is left of the job
    failing = spark.range(9).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        failing.write.format("tfrecords").mode("overwrite").option("commit", commit).save(path)
    assert ids() == [0, 1] and [p.name for p in tmp_path.iterdir()] == ["out"]
    # the commit itself fails after the tasks
    schema = spark.range(1).schema
    writer = tfrecord._Writer({"path": path, "commit": commit}, schema)
    (tmp_path / "lost").mkdir()

    def put(fs, name, text):
        raise OSError("disk full")

    folder = writer._folder()[2]
    name = f"part-0-{writer.job}.tfrecord"
    tfrecord.file_system(folder)[0].create_dir(folder)
    with open(f"{folder}/{name}", "wb") as f:
        f.write(tfrecord.framed(b""))
    monkeypatch.setattr(tfrecord._Writer, "_put", staticmethod(put))
    with pytest.raises(OSError):
        writer.commit([tfrecord._Done(name, 1, {})])
    assert ids() == [0, 1]
    writer.abort([])
    assert ids() == [0, 1] and not any(writer.job in p.name for p in [*tmp_path.iterdir(), *(tmp_path / "out").iterdir()])


def test_a_failed_swap_puts_the_old_output_back(tmp_path):
    from pyarrow import fs as pafs

    class Fs(pafs.LocalFileSystem):
        pass

    writer = tfrecord._Writer({"path": f"{tmp_path}/out"}, None)
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "old").write_text("x")
    with pytest.raises(OSError):
        writer._swapped(Fs(), f"{tmp_path}/out", f"{tmp_path}/not there")
    assert (tmp_path / "out" / "old").read_text() == "x"


def test_lost_files_of_a_manifest_raise(spark, tmp_path):
    path = f"{tmp_path}/out"
    tfrecord.write_tfrecord(spark.range(4).repartition(2), path)
    (tmp_path / "out" / "part-zz.tfrecord").write_bytes(b"of an attempt that doesn't count")
    assert tfrecord.read_tfrecord(spark, path).count() == 4
    next((tmp_path / "out").glob("part-00000*")).unlink()
    with pytest.raises(ValueError, match="manifest"):
        tfrecord.listing(path)


def test_vocabulary_in_buckets_is_not_shuffled(spark, tmp_path):
    stats = lambda step, n: vocab.value_stats(spark.range(n).select(F.lit("f").alias("field_name"), (F.col("id") % 3).cast("int").alias("field_index"), F.when(F.col("id") < 0, 0).otherwise(1).alias("field_type"), F.pmod(F.col("id") * step, F.lit(97)).cast("string").alias("key"), F.lit(1.0).alias("value")))
    plain = written(vocab.build_pos_map(stats(1, 400), 2), "positions")
    kept = sinks.save_vocabulary(plain, "kept_vocabulary", f"{tmp_path}/v")
    small = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(small, "-1")
    try:
        assert sorted(map(tuple, kept.select(*plain.columns).collect())) == sorted(map(tuple, plain.collect()))
        assert len(list((tmp_path / "v").glob("*.parquet"))) <= 4
        more = stats(5, 900)
        builds = [vocab.build_pos_map(more, 1, old) for old in (plain, kept)]
        want, got = (sorted(map(tuple, x.collect())) for x in builds)
        assert got == want and len(got) > plain.count()
        shuffled = [_shuffled_scans(x, "Bucketed: true") for x in (builds[1], vocab.build_report(more, 1, kept))]
        assert shuffled[0][0] >= 1 and shuffled[0][1] == 0 and shuffled[1] == (1, 0)
        with pytest.raises(Exception):
            sinks.save_vocabulary(plain, "kept_vocabulary", f"{tmp_path}/w")
    finally:
        spark.conf.unset(small)
        spark.sql("DROP TABLE kept_vocabulary")


def _shuffled_scans(df, mark):
    """How many scans of the plan have the mark, and over how many of these whole rows are shuffled before they are joined."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = [len(x) - len(x.lstrip(" :+-*()0123456789")) for x in lines]
    seen = bad = 0
    for i, line in enumerate(lines):
        if mark not in line:
            continue
        above, now = [], depth[i]
        for j in range(i - 1, -1, -1):
            if depth[j] < now:
                above.append(lines[j])
                now = depth[j]
        upto = next((k for k, x in enumerate(above) if "Join" in x or "HashAggregate" in x), len(above))
        seen += 1
        bad += any("Exchange" in x for x in above[:upto])
    return seen, bad
