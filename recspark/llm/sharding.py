"""Sharding by a two-pass external shuffle.

Pass one scatters records to memory-sized buckets by a seeded hash; pass two shuffles each bucket by Fisher-Yates. The
buckets in order are one uniformly shuffled stream, and the shards are cut from it. No task holds more than a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recspark.functions.names import fresh
from recspark.sources.scratch import counted, new_path, written

#: Bytes of text that a bucket holds on average.
BUCKET_BYTES = 16 * 2**20

#: Buckets whose running totals one task adds up; the totals of these runs are added up in turn.
RUN = 4096


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text, 0 for null, plus 16."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long")


def bucket_starts(counts: DataFrame) -> DataFrame:
    """(bucket, start) from (bucket, n): the running total of n before each bucket, in two levels so that no task sees all buckets."""
    runs = counts.withColumn("run", F.floor(F.col("bucket") / RUN))
    inner = Window.partitionBy("run").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    totals = runs.groupBy("run").agg(F.sum("n").alias("m")).select("run", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("base"))
    within = runs.withColumn("inside", F.coalesce(F.sum("n").over(inner), F.lit(0)))
    return within.join(totals, "run").select("bucket", (F.col("base") + F.col("inside")).alias("start"))


def _fisher_yates(seed: int, bucket_name: str, place_name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def shuffled() -> Iterator[pa.RecordBatch]:
            if held:
                bucket = pa.Table.from_batches(held)
                which = bucket.column(bucket_name)[0].as_py()
                order = np.arange(bucket.num_rows)
                np.random.Generator(np.random.PCG64([seed, which])).shuffle(order)  # numpy's shuffle is Fisher-Yates
                place = pa.array(np.arange(bucket.num_rows), pa.int64())
                out = bucket.take(pa.array(order)).append_column(place_name, place)
                held.clear()
                yield from out.to_batches(max_chunksize=2000)

        # a partition's rows come sorted by bucket, and a bucket's rows in an order that only the data decide
        for batch in batches:
            ids = batch.column(bucket_name).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if held and held[-1].column(bucket_name)[0].as_py() != ids[a]:
                    yield from shuffled()
                held.append(batch.slice(a, b - a))
        yield from shuffled()

    return run


#: Rows of a few longs that may be broadcast, some 50 MB; more are joined by shuffle.
BROADCAST_ROWS = 1_000_000


def _salted(docs: DataFrame, bucket_bytes: int, salt: str) -> DataFrame:
    """``docs`` with a column ``salt``: 0, but a number of its own for each row of a hot group.

    Rows of one id and text would share a bucket; a group of more than a quarter of a bucket is hot. Hot rows are
    written with their numbers, so that all later reads see the same ones.
    """
    group = F.xxhash64("doc_id", "text")
    sizes = docs.select(group.alias("g"), record_size(F.col("text")).alias("b")).groupBy("g").agg(F.sum("b").alias("b"))
    hot, k = counted(sizes.where(F.col("b") > bucket_bytes // 4).select("g"), "hot")
    if not k:
        return docs.withColumn(salt, F.lit(0).cast("long"))
    hot = F.broadcast(hot) if k <= BROADCAST_ROWS else hot
    rest = docs.join(hot, group == hot["g"], "left_anti").withColumn(salt, F.lit(0).cast("long"))
    return rest.unionByName(written(docs.join(hot, group == hot["g"], "left_semi").withColumn(salt, F.monotonically_increasing_id() + 1), "hot-rows"))


def shuffle_into_shards(docs: DataFrame, n_shards: int, path: str, seed: int = 11, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Writes ``docs`` under ``path`` as Parquet in folders shard=0.. and returns them read back, with shard int and slot long.

    Law: row counts of any two shards differ by one at most; slots number a shard's rows from 0 without a gap. Needs
    columns doc_id and text; all others stay, those named shard or slot are replaced. Null texts and ids, empty texts,
    repeated rows and an empty table are kept as they are; rows that are equal in all columns are interchangeable. A row
    that is repeated very often is spread over buckets like any other.
    """
    own = [c for c in docs.columns if c not in ("shard", "slot")]
    docs = docs.select(*[F.col(f"`{c}`") for c in own])
    bucket_, place, start, salt = fresh([*own, "shard", "slot"], "bucket", "place", "start", "salt")
    total = docs.agg(F.sum(record_size(F.col("text"))).alias("b"), F.count(F.lit(1)).alias("n")).first()
    n_buckets = max(1, -(-(total["b"] or 0) // bucket_bytes))
    rows = _salted(docs, bucket_bytes, salt)
    bucket = F.pmod(F.xxhash64(F.lit(seed), "doc_id", F.xxhash64("text"), salt), F.lit(n_buckets)).cast("int")
    order = F.xxhash64(*[F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind])
    counts = rows.select(bucket.alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    starts = written(bucket_starts(counts), "starts").select(F.col("bucket").alias(bucket_), F.col("start").alias(start))
    scattered = rows.withColumn(bucket_, bucket).drop(salt).repartitionById(n_buckets, bucket_)
    scattered = scattered.sortWithinPartitions(bucket_, "doc_id", order)
    schema = scattered.withColumn(place, F.lit(0).cast("long")).schema
    placed = scattered.mapInArrow(_fisher_yates(seed, bucket_, place), schema)
    # shard s has the rows from s * n / n_shards, rounded so that the first n % n_shards shards have one more
    small, more = divmod(total["n"], n_shards)
    at = F.col(start) + F.col(place)
    in_large = at < more * (small + 1)
    shard = F.when(in_large, F.floor(at / F.lit(small + 1))).otherwise(more + F.floor((at - more * (small + 1)) / F.lit(max(small, 1))))
    slot = F.when(in_large, F.pmod(at, F.lit(small + 1))).otherwise(F.pmod(at - more * (small + 1), F.lit(max(small, 1))))
    out = placed.join(F.broadcast(starts) if n_buckets <= BROADCAST_ROWS else starts, bucket_)
    out = out.select(*[F.col(f"`{c}`") for c in own], shard.cast("int").alias("shard"), slot.cast("long").alias("slot"))
    out.write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(out.schema).parquet(path)


def digest(sharded: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of each record that the shards hold; a null text counts as empty."""
    return sharded.select(
        "doc_id",
        record_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def new_shard_path(docs: DataFrame) -> str:
    return new_path(docs.sparkSession, "shards")
