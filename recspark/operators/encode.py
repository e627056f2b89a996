"""Encoding of token columns into raw, index and value arrays.

``encode_rows`` encodes samples where they lie: tokens stay in their row's arrays and are looked up in a broadcast part of the vocabulary, the
most frequent values. Only values beyond that part are exploded and joined. ``encode_vocab`` and ``encode_hash`` take melted tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recspark.functions.hashing import cross_hash, feature_hash, string_id
from recspark.functions.names import fresh
from recspark.operators.registry import CATEGORICAL, Registry


def hashed_keys(tokens: DataFrame) -> DataFrame:
    """field_index, key, fea, hash of the distinct keys: string keys get their number, then every pair its hash index; a cross hashes its parents' pairs."""
    distinct = tokens.select("field_index", "key", "fea", "parts").distinct()
    named = distinct.withColumn("fea", F.coalesce("fea", string_id(F.col("key"))))
    own = feature_hash(F.col("field_index"), F.col("fea"))
    return named.select("field_index", "key", "fea", F.coalesce(cross_hash(F.col("parts")), own).alias("hash"))


def _arrays(rows: DataFrame, key: str, fields: list[tuple[str, int, int]], keys: DataFrame | None) -> DataFrame:
    """One row a key with {field}_raw, _index, _value; every field begins with its sentinel, which is all it has where no index is known.

    ``keys`` names keys that may have no row in ``rows``.
    """
    rows = rows.select(key, "field_name", "ord", "raw", "index", "value")
    if keys is not None:
        rows = rows.unionByName(keys.select(key).distinct(), allowMissingColumns=True)
    element = F.when(F.col("index").isNotNull(), F.struct("ord", "raw", "index", "value"))
    per = rows.groupBy(key, "field_name").agg(F.array_sort(F.collect_list(element)).alias("list"))
    wide = per.groupBy(key).agg(F.map_from_entries(F.collect_list(F.when(F.col("field_name").isNotNull(), F.struct("field_name", "list")))).alias("m"))
    out = [F.col(key)]
    for name, _, _ in fields:
        got = F.coalesce(F.element_at("m", name), F.array().cast("array<struct<ord:int,raw:string,index:bigint,value:double>>"))
        out += [
            F.concat(F.array(F.lit("R:")), F.transform(got, lambda x: x["raw"])).alias(f"{name}_raw"),
            F.concat(F.array(F.lit(0).cast("long")), F.transform(got, lambda x: x["index"])).alias(f"{name}_index"),
            F.concat(F.array(F.lit(1.0).cast("float")), F.transform(got, lambda x: x["value"].cast("float"))).alias(f"{name}_value"),
        ]
    return wide.select(*out)


def fields_of(registry: Registry) -> list[tuple[str, int, int]]:
    return [(f.name, f.index, f.kind) for f in registry.active()]


def _looked_up(tokens: DataFrame, known: DataFrame) -> DataFrame:
    """Tokens with ``index`` of ``known`` (field_index, key, index), null where a categorical value isn't known; continuous ones have 1."""
    cat = tokens.where("field_type = 1").join(known, ["field_index", "key"], "left")
    return cat.unionByName(tokens.where("field_type = 0").withColumn("index", F.lit(1).cast("long")))


def vocab_tokens(tokens: DataFrame, pos_map: DataFrame) -> DataFrame:
    """Tokens with ``index`` from the vocabulary; unknown categorical values are dropped, continuous ones always pass."""
    return _looked_up(tokens, pos_map.where("field_type = 1").select("field_index", "key", F.col("pos").alias("index"))).where("index is not null")


def encode_vocab(tokens: DataFrame, pos_map: DataFrame, registry: Registry, key: str = "sample_id", keys: DataFrame | None = None) -> DataFrame:
    """An encoded row for each key of ``tokens``, and of ``keys`` where given; has_feature tells whether any value, categorical or continuous, is left."""
    fields = fields_of(registry)
    known = pos_map.where("field_type = 1").select("field_index", "key", F.col("pos").alias("index"))
    out = _arrays(_looked_up(tokens, known), key, fields, keys)
    has = F.lit(False)
    for name, _, _ in fields:
        has = has | (F.size(f"{name}_index") > 1)
    return out.withColumn("has_feature", has)


#: Values of a vocabulary, the most frequent first, that are looked up where the rows lie: some 50 bytes each.
NEAR_VALUES = 500_000

#: The keys of a field and the position of each.
_Near = dict[int, tuple[pa.Array, np.ndarray]]


def _near_and_far(pos_map: DataFrame, most: int) -> tuple[_Near, DataFrame | None]:
    """The ``most`` (1 at least) most frequent categorical values by field_index, and the other values as a table, if there are any."""
    known = pos_map.where(F.col("field_type") == CATEGORICAL).select("field_index", "key", "pos", "cnt")
    top = known.orderBy(F.col("cnt").desc(), "field_index", "pos").limit(most + 1).toArrow()  # NEAR_VALUES rows and one
    far = None
    if len(top) > most:
        last, top = top.slice(most - 1, 1).to_pylist()[0], top.slice(0, most)
        later = (F.col("cnt") < last["cnt"]) | ((F.col("cnt") == last["cnt"]) & ((F.col("field_index") > last["field_index"]) | ((F.col("field_index") == last["field_index"]) & (F.col("pos") > last["pos"]))))
        far = known.where(later).drop("cnt")
    near = {}
    for index in pc.unique(top["field_index"]).to_pylist():
        own = top.filter(pc.equal(top["field_index"], index))
        near[index] = (own["key"].combine_chunks(), own["pos"].to_numpy())
    return near, far


def _positions(tokens: pa.Array, index: int, near: _Near) -> np.ndarray:
    """The position of each token's key, 0 where the near part of the vocabulary doesn't hold it."""
    if index not in near or not len(tokens):
        return np.zeros(len(tokens), np.int64)
    keys, pos = near[index]
    at = pc.index_in(tokens.field("key"), value_set=keys)
    return np.where(at.is_valid().to_numpy(zero_copy_only=False), pos[at.fill_null(0).to_numpy(zero_copy_only=False)], 0)


def _tokens_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(tokens of all rows in order, row of each)."""
    return pc.list_flatten(column), pc.list_parent_indices(column).to_numpy(zero_copy_only=False).astype(np.int64)


def _lists(rows: np.ndarray, n_rows: int, first, values: pa.Array, kind: pa.DataType) -> pa.ListArray:
    """A list a row: ``first``, then the row's values; ``rows`` is in order."""
    sizes = np.bincount(rows, minlength=n_rows) + 1
    ends = np.cumsum(sizes)
    take = np.zeros(int(ends[-1]) if n_rows else 0, np.int64)
    inner = np.ones(len(take), bool)
    inner[ends - sizes] = False
    take[inner] = np.arange(1, len(rows) + 1)
    flat = pa.concat_arrays([pa.array([first], kind), values.cast(kind)]).take(pa.array(take))
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), flat)


def encode_rows(rows: DataFrame, pos_map: DataFrame, registry: Registry, key: str = "sample_id", keep: list[str] | None = None, near_values: int = NEAR_VALUES) -> DataFrame:
    """(key, ``keep``, {field}_raw, _index, _value of every active feature, has_feature) of ``rows``, one row each.

    What ``encode_vocab`` gives for the tokens of ``rows``: each field begins with its sentinel, unknown categorical values are left out, continuous ones always pass;
    has_feature tells whether any value is left. No row is shuffled while the vocabulary has ``near_values`` values at most. Of a larger one the
    rarer values are looked up by a join of the tokens that the frequent ones don't cover, and come back to their row by ``key``, which must be unique then.
    """
    keep = keep or []
    fields = fields_of(registry)
    near, far = _near_and_far(pos_map, near_values)
    shared = rows.sparkSession.sparkContext.broadcast(near)  # NEAR_VALUES keys
    made, far_name = registry.columns(rows), None
    narrow = [F.transform(f"`{name}`", lambda t: F.struct(t["raw"], t["key"], t["value"])).alias(f"t{i}") for i, (name, _, _) in enumerate(fields)]
    carried = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate([key, *keep])]
    if far is not None:
        # the rows are joined as they came, not with their tokens
        found = _far_values(made.select(carried[0], *narrow), far, fields, shared)
        key_name, far_name = fresh([*made.columns], "key", "far")
        rows = rows.join(found.select(F.col("c0").alias(key_name), F.col("far").alias(far_name)), F.col(f"`{key}`") == F.col(key_name), "left").drop(key_name)
        made = registry.columns(rows)
    made = made.select(*carried, *narrow, *([F.col(far_name).alias("far")] if far_name else []))
    has_far, own = far is not None, [f"c{i}" for i in range(len(carried))]
    names = [*own, *[f"{name}_{part}" for name, _, _ in fields for part in ("raw", "index", "value")], "has_feature"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, some = b.num_rows, np.zeros(b.num_rows, bool)
            columns = [b.column(c) for c in own]
            extra = _far_positions(b.column("far")) if has_far else None
            for i, (_, index, kind) in enumerate(fields):
                tokens, row = _tokens_of(b.column(f"t{i}"))
                pos = _positions(tokens, index, shared.value) if kind == CATEGORICAL else np.ones(len(tokens), np.int64)
                if extra is not None and kind == CATEGORICAL:
                    pos = np.where(pos > 0, pos, extra(row, index, tokens))
                known = pos > 0
                tokens, row = tokens.filter(pa.array(known)), row[known]
                some[row] = True
                columns += [_lists(row, n, "R:", tokens.field("raw"), pa.string()), _lists(row, n, 0, pa.array(pos[known]), pa.int64()), _lists(row, n, 1.0, tokens.field("value"), pa.float32())]
            yield pa.record_batch([*columns, pa.array(some)], names=names)

    lists = {"raw": T.StringType(), "index": T.LongType(), "value": T.FloatType()}
    schema = T.StructType([T.StructField(c, made.schema[c].dataType) for c in own])
    for name, _, _ in fields:
        for part, kind in lists.items():
            schema = schema.add(f"{name}_{part}", T.ArrayType(kind))
    out = made.mapInArrow(run, schema.add("has_feature", T.BooleanType()))
    return out.withColumnsRenamed({f"c{i}": c for i, c in enumerate([key, *keep])})


def _far_values(made: DataFrame, far: DataFrame, fields: list[tuple[str, int, int]], shared) -> DataFrame:
    """c0 and ``far``: (index, key, pos) of a row's values that only the rarer part of the vocabulary holds. A row lies in one batch, which tells each of its values once."""

    def missed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = []
            for i, (_, index, kind) in enumerate(fields):
                if kind == CATEGORICAL:
                    tokens, row = _tokens_of(b.column(f"t{i}"))
                    new = np.flatnonzero(_positions(tokens, index, shared.value) == 0)
                    parts.append(pa.table({"row": row[new], "field_index": np.full(len(new), index, np.int32), "key": tokens.field("key").take(pa.array(new))}))
            if parts:
                once = pa.concat_tables(parts).group_by(["row", "field_index", "key"]).aggregate([]).combine_chunks()
                ids = b.column("c0").take(once["row"].combine_chunks())
                yield pa.record_batch([ids, once["field_index"].combine_chunks(), once["key"].combine_chunks()], names=["c0", "field_index", "key"])

    schema = T.StructType([made.schema["c0"], T.StructField("field_index", T.IntegerType()), T.StructField("key", T.StringType())])
    needed = made.mapInArrow(missed, schema).join(far, ["field_index", "key"])
    return needed.groupBy("c0").agg(F.collect_list(F.struct("field_index", "key", "pos")).alias("far"))


def _far_positions(column: pa.Array):
    """A lookup of tokens in what their own rows got."""
    entries, row = _tokens_of(column)

    def keyed(rows: np.ndarray, index: pa.Array, keys: pa.Array) -> pa.Array:
        return pc.binary_join_element_wise(pa.array(rows).cast(pa.string()), index.cast(pa.string()), keys, " ")

    held = keyed(row, entries.field("field_index"), entries.field("key"))
    pos = entries.field("pos").to_numpy(zero_copy_only=False)

    def find(rows: np.ndarray, index: int, tokens: pa.Array) -> np.ndarray:
        if not len(held) or not len(tokens):
            return np.zeros(len(tokens), np.int64)
        at = pc.index_in(keyed(rows, pa.array(np.full(len(rows), index)), tokens.field("key")), value_set=held)
        return np.where(at.is_valid().to_numpy(zero_copy_only=False), pos[at.fill_null(0).to_numpy(zero_copy_only=False)], 0)

    return find


def encode_hash(tokens: DataFrame, registry: Registry, key: str = "sample_id", keys: DataFrame | None = None) -> DataFrame:
    """An encoded row for each key of ``tokens``, and of ``keys`` where given, whose index is the hash of each value; continuous fields have index 1."""
    hashes = hashed_keys(tokens.where("field_type = 1")).select("field_index", "key", F.col("hash").alias("index"))
    return _arrays(_looked_up(tokens, hashes), key, fields_of(registry), keys)


def encode_text(rows: DataFrame, key: str, sep: str = ",", between: str = ":") -> DataFrame:
    """(key, field_name, text): ``name:idx,idx,…`` of each field's indexes in order."""
    per = rows.groupBy(key, "field_name").agg(F.array_sort(F.collect_list(F.struct("ord", "index"))).alias("l"))
    return per.select(key, "field_name", F.concat(F.col("field_name"), F.lit(between), F.concat_ws(sep, F.transform("l", lambda x: x["index"].cast("string")))).alias("text"))


def encoded_text(encoded: DataFrame, registry: Registry, key: str = "sample_id", sep: str = ",", between: str = ":") -> DataFrame:
    """``encode_text`` of ``encode_rows``: a row for each categorical field in which a row has a known value. Nothing is shuffled."""
    names = [f.name for f in registry.active() if f.kind == CATEGORICAL]
    lists = [F.struct(F.lit(n).alias("field_name"), F.slice(f"{n}_index", 2, F.greatest(F.size(f"{n}_index") - 1, F.lit(0))).alias("i")) for n in names]
    one = encoded.select(key, F.explode(F.array(*lists)).alias("f")).where(F.size("f.i") > 0)
    return one.select(key, "f.field_name", F.concat(F.col("f.field_name"), F.lit(between), F.concat_ws(sep, F.transform("f.i", lambda x: x.cast("string")))).alias("text"))


def with_targets(df: DataFrame, target_map: DataFrame | None) -> DataFrame:
    """``df`` with its column target replaced by the dense index, unmapped rows dropped; without a map it stays raw."""
    if target_map is None:
        return df
    return df.join(target_map.select("target", "idx"), "target").drop("target").withColumnRenamed("idx", "target")


def flat_columns(df: DataFrame) -> DataFrame:
    """A read-back record table with the raw, index and value columns of each field side by side, as field: struct."""
    names = sorted({c.rsplit("_", 1)[0] for c in df.columns if c.endswith("_raw")})
    rest = [c for c in df.columns if c.rsplit("_", 1)[0] not in names]
    return df.select(*rest, *[F.struct(*[F.col(f"{n}_{p}").alias(p) for p in ("raw", "index", "value") if f"{n}_{p}" in df.columns]).alias(n) for n in names])
