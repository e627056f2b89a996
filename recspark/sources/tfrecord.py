"""TFRecord files of Example and SequenceExample messages, as DataFrames.

``spark.read.format("tfrecords")`` and ``df.write.format("tfrecords")`` are Python data sources (``register`` them first) that
open their files through Arrow's file systems, one partition a file, read as a stream. Types: whole numbers and booleans are
int64 lists, fractional numbers float lists (32 bits), strings and binary bytes lists; arrays are lists of more; arrays of arrays
are feature lists of a SequenceExample. Nulls are left out; other types are refused.

A commit writes a manifest of the files, their sizes and the columns seen in them; readers take the files that it names, so they
see the old output or the new one, whole.
"""

from __future__ import annotations

import gzip
import io
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

# ---- checksums: CRC-32C of many records at once

#: Fixed values of CRC-32C and of its mask.
POLYNOMIAL, MASK = 0x82F63B78, 0xA282EAD8
#: Bytes of a block; the blocks of all records are summed side by side.
BLOCK = 64

_tables: list[np.ndarray] = []


def _bytes_table() -> np.ndarray:
    if not _tables:
        t = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            t = np.where(t & 1, t >> 1 ^ np.uint32(POLYNOMIAL), t >> 1).astype(np.uint32)
        _tables.append(t)
    return _tables[0]


def _moved(op: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Sums ``c`` after as many zero bytes as ``op`` stands for; ``op`` has a row of 256 values for each byte of a sum."""
    return op[0][c & 255] ^ op[1][c >> 8 & 255] ^ op[2][c >> 16 & 255] ^ op[3][c >> 24]


def _operator(level: int) -> np.ndarray:
    """The move by BLOCK * 2^level zero bytes. Each is the one before it, applied twice."""
    t = _bytes_table()
    while len(_tables) < level + 2:
        c = (np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)
        if len(_tables) == 1:
            for _ in range(BLOCK):
                c = t[c & 255] ^ c >> 8
        else:
            c = _moved(_tables[-1], _moved(_tables[-1], c))
        _tables.append(c)
    return _tables[level + 1]


def _placed(counts: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Where ``counts`` things of each record go if each record has ``room`` places and fills the last of them."""
    return np.repeat(np.cumsum(room) - np.cumsum(counts), counts) + np.arange(counts.sum())


def checksums(datas: list[bytes]) -> np.ndarray:
    """CRC-32C of each.

    A sum that starts from zero doesn't see leading zeros, so records are filled up to whole blocks on their left, and the usual
    start from all ones is the inversion of the first four bytes. Sums of neighbours are then put together, twice as long each turn.
    """
    if not datas:
        return np.zeros(0, np.uint32)
    size = np.array([max(len(d), 4) for d in datas], np.int64)
    flat = np.frombuffer(b"".join(d if len(d) >= 4 else d + bytes(4 - len(d)) for d in datas), np.uint8).copy()
    first = np.cumsum(size) - size
    for i in range(4):
        flat[first + i] ^= 255
    blocks = -(-size // BLOCK)
    full = np.zeros(int(blocks.sum()) * BLOCK, np.uint8)
    full[_placed(size, blocks * BLOCK)] = flat
    t, columns = _bytes_table(), np.ascontiguousarray(full.reshape(-1, BLOCK).T)
    c = np.zeros(columns.shape[1], np.uint32)
    for column in columns:
        c = t[(c ^ column) & 255] ^ c >> 8
    level = 0
    while len(c) > len(datas):
        half = (blocks + 1) // 2
        pairs = np.zeros(int(half.sum()) * 2, np.uint32)
        pairs[_placed(blocks, half * 2)] = c
        c = _moved(_operator(level), pairs[::2]) ^ pairs[1::2]
        blocks, level = half, level + 1
    out = c ^ np.uint32(0xFFFFFFFF)
    for i, d in enumerate(datas):
        if len(d) < 4:
            one = 0xFFFFFFFF
            for x in d:
                one = int(t[(one ^ x) & 255]) ^ one >> 8
            out[i] = one ^ 0xFFFFFFFF
    return out


def crc32c(data: bytes) -> int:
    return int(checksums([data])[0])


def _masks(c: np.ndarray) -> np.ndarray:
    return ((c >> 15 | c << 17) + np.uint32(MASK)).astype("<u4")


# ---- framing: length, masked CRC of it, data, masked CRC of it

#: A batch of records ends with the record that passes either bound.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def framed(*datas: bytes) -> bytes:
    """The records, one behind the other, as a file holds them."""
    heads = [struct.pack("<Q", len(d)) for d in datas]
    a, b = _masks(checksums(heads)), _masks(checksums(list(datas)))
    return b"".join(x for h, i, d, j in zip(heads, a, datas, b) for x in (h, i.tobytes(), d, j.tobytes()))


def _checked(datas: list[bytes], sums: list[bytes]) -> None:
    if _masks(checksums(datas)).tobytes() != b"".join(sums):
        raise ValueError("TFRecord checksum doesn't match")


def _exactly(stream, n: int) -> bytes:
    """The next ``n`` bytes, read in pieces, so that a damaged length asks for no more memory than the file has bytes; fewer at its end."""
    pieces, left = [], n
    while left:
        piece = stream.read(min(left, BATCH_BYTES))
        if not piece:
            break
        pieces.append(piece)
        left -= len(piece)
    return b"".join(pieces)


def record_batches(stream, check: bool = True) -> Iterator[list[bytes]]:
    """The records of a stream, batch by batch; one batch is held at a time. A damaged or cut file raises ValueError."""
    stream = io.BufferedReader(stream) if not hasattr(stream, "peek") else stream
    head = stream.peek(12)[:12]
    # a length may begin like a gzip file, its checksum tells
    if head[:2] == b"\x1f\x8b" and (len(head) < 12 or _masks(checksums([head[:8]])).tobytes() != head[8:12]):
        stream = io.BufferedReader(gzip.GzipFile(fileobj=stream))
    try:
        more = True
        while more:
            heads, datas, sums, size = [], [], [], 0
            while len(datas) < BATCH_ROWS and size < BATCH_BYTES:
                head = _exactly(stream, 12)
                more = bool(head)
                if not more:
                    break
                if len(head) < 12:
                    raise ValueError("TFRecord file ends within a header")
                if check:
                    heads.append(head[:8])
                    sums.append(head[8:])
                (n,) = struct.unpack("<Q", head[:8])
                data = _exactly(stream, n + 4)
                if len(data) < n + 4:
                    raise ValueError("TFRecord file ends within a record")
                datas.append(data[:n])
                if check:
                    heads.append(datas[-1])
                    sums.append(data[n:])
                size += n
            if check:
                _checked(heads, sums)
            if datas:
                yield datas
    except (EOFError, gzip.BadGzipFile, zlib.error) as e:
        raise ValueError(f"TFRecord file is damaged: {e}") from e


def records(content: bytes, check: bool = True) -> Iterator[bytes]:
    """The records of one file's bytes; a damaged file raises ValueError."""
    for batch in record_batches(io.BytesIO(content), check):
        yield from batch


# ---- file systems and listings

MANIFEST = "_MANIFEST"


def file_system(path: str):
    """Arrow's file system of a path or URI, and the path there."""
    from pyarrow import fs

    if re.match("file:/", path):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", path))
    return fs.LocalFileSystem(), path


def _exists(fs, path: str) -> bool:
    from pyarrow.fs import FileType

    return fs.get_file_info(path).type != FileType.NotFound


def _manifest(fs, folder: str) -> dict | None:
    if not _exists(fs, f"{folder}/{MANIFEST}"):
        return None
    with fs.open_input_stream(f"{folder}/{MANIFEST}") as f:
        return json.loads(f.read())


def listing(path: str) -> tuple[list[tuple[str, int]], list[dict | None]]:
    """(path, bytes) of the data files under a path, by name, and the manifest of each folder of them.

    Hidden files and folders are passed over. Of a folder with a manifest, the files that it names count; a lost one raises an error.
    """
    from pyarrow import fs as pafs

    fs, root = file_system(path)
    info = fs.get_file_info(root)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.is_file:
        return [(root, info.size)], [None]
    files, manifests, folders = [], [], [root.rstrip("/")]
    while folders:
        folder = folders.pop()
        inside = {x.base_name: x for x in fs.get_file_info(pafs.FileSelector(folder)) if not x.base_name.startswith(("_", "."))}
        known = _manifest(fs, folder)
        folders += [f"{folder}/{n}" for n, x in inside.items() if x.type == pafs.FileType.Directory]
        here = [(n, x.size) for n, x in inside.items() if x.is_file]
        if known is not None:
            named = {f["name"]: f["bytes"] for f in known["files"]}
            here = [(n, size) for n, size in here if n in named]
            if dict(here) != named:
                raise ValueError(f"{folder} lacks files of its manifest")
        if here or known is not None:
            files += [(f"{folder}/{n}", size) for n, size in here]
            manifests.append(known)
    return sorted(files), manifests


# ---- messages, built from the public definition of Example and SequenceExample

_classes: dict[str, type] = {}


def message(name: str):
    if not _classes:
        from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

        one, many = descriptor_pb2.FieldDescriptorProto.LABEL_OPTIONAL, descriptor_pb2.FieldDescriptorProto.LABEL_REPEATED
        kind = descriptor_pb2.FieldDescriptorProto
        file = descriptor_pb2.FileDescriptorProto(name="recspark_example.proto", package="recspark", syntax="proto3")

        def add(name: str, *fields, into=None):
            m = (into or file.message_type).add(name=name) if into is None else into.nested_type.add(name=name)
            for number, (field, label, type_, of) in enumerate(fields, 1):
                m.field.add(name=field, number=number, label=label, type=type_, type_name=of and f".recspark.{of}")
            return m

        def mapped(name: str, field: str, value: str):
            entry = "".join(x.capitalize() for x in field.split("_")) + "Entry"
            m = add(name, (field, many, kind.TYPE_MESSAGE, f"{name}.{entry}"))
            add(entry, ("key", one, kind.TYPE_STRING, None), ("value", one, kind.TYPE_MESSAGE, value), into=m).options.map_entry = True

        add("BytesList", ("value", many, kind.TYPE_BYTES, None))
        add("FloatList", ("value", many, kind.TYPE_FLOAT, None))
        add("Int64List", ("value", many, kind.TYPE_INT64, None))
        f = add("Feature", ("bytes_list", one, kind.TYPE_MESSAGE, "BytesList"), ("float_list", one, kind.TYPE_MESSAGE, "FloatList"), ("int64_list", one, kind.TYPE_MESSAGE, "Int64List"))
        f.oneof_decl.add(name="kind")
        for x in f.field:
            x.oneof_index = 0
        mapped("Features", "feature", "Feature")
        add("FeatureList", ("feature", many, kind.TYPE_MESSAGE, "Feature"))
        mapped("FeatureLists", "feature_list", "FeatureList")
        add("Example", ("features", one, kind.TYPE_MESSAGE, "Features"))
        add("SequenceExample", ("context", one, kind.TYPE_MESSAGE, "Features"), ("feature_lists", one, kind.TYPE_MESSAGE, "FeatureLists"))
        pool = descriptor_pool.DescriptorPool()
        pool.Add(file)
        for n in ("Example", "SequenceExample"):
            _classes[n] = message_factory.GetMessageClass(pool.FindMessageTypeByName(f"recspark.{n}"))
    return _classes[name]


def _list_of(t: T.DataType) -> str:
    if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        return "int64_list"
    if isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "float_list"
    if isinstance(t, (T.StringType, T.BinaryType)):
        return "bytes_list"
    raise TypeError(f"{t.simpleString()} has no TFRecord form")


def _depth(t: T.DataType) -> tuple[int, T.DataType]:
    n = 0
    while isinstance(t, T.ArrayType):
        n, t = n + 1, t.elementType
    return n, t


def _fill(feature, name: str, values) -> None:
    cast = {"int64_list": int, "float_list": float, "bytes_list": lambda v: v.encode() if isinstance(v, str) else bytes(v)}[name]
    getattr(feature, name).value.extend(cast(v) for v in values)
    if not values:
        getattr(feature, name).SetInParent()


def serialized(row, schema: T.StructType, kind: str = "Example") -> bytes:
    """A row as one message. A null in a column that can't be null is an error."""
    out = message(kind)()
    for f in schema.fields:
        v, (depth, leaf) = row[f.name], _depth(f.dataType)
        name = _list_of(leaf)
        if v is None:
            if not f.nullable:
                raise ValueError(f"{f.name} is null but not nullable")
            continue
        if depth == 2:
            if kind == "Example":
                raise TypeError(f"{f.name}: arrays of arrays need SequenceExample")
            lists = out.feature_lists.feature_list[f.name]
            for inner in v:
                _fill(lists.feature.add(), name, inner)
        elif depth < 2:
            features = (out.features if kind == "Example" else out.context).feature
            _fill(features[f.name], name, v if depth else [v])
        else:
            raise TypeError(f"{f.name}: arrays nest at most twice")
    return out.SerializeToString(deterministic=True)


def _values(feature, leaf: T.DataType) -> list:
    name = feature.WhichOneof("kind")
    got = list(getattr(feature, name).value) if name else []
    if got and name != _list_of(leaf):
        raise TypeError(f"a {name} can't be read as {leaf.simpleString()}")
    if isinstance(leaf, T.StringType):
        return [v.decode() for v in got]
    if isinstance(leaf, T.BooleanType):
        return [bool(v) for v in got]
    return got


def parsed(data: bytes, schema: T.StructType, kind: str = "Example") -> dict:
    """The columns of one message; what it lacks is null, and is an error in a column that can't be null."""
    m = message(kind)()
    m.ParseFromString(data)
    features = (m.features if kind == "Example" else m.context).feature
    out = {}
    for f in schema.fields:
        depth, leaf = _depth(f.dataType)
        if depth == 2:
            lists = m.feature_lists.feature_list if kind != "Example" else {}
            out[f.name] = [_values(x, leaf) for x in lists[f.name].feature] if f.name in lists else None
        elif f.name in features:
            got = _values(features[f.name], leaf)
            out[f.name] = got if depth else (got[0] if got else None)
        else:
            out[f.name] = None
        if out[f.name] is None and not f.nullable:
            raise ValueError(f"{f.name} is missing but not nullable")
    return out


# ---- inference: kinds by rank, the larger wins

#: Rank of what one record says of a column: 0 nothing, then long, float, string, each alone or as a list, then lists of lists.
_RANKS = {"int64_list": 1, "float_list": 2, "bytes_list": 3}
_TYPES = {0: "string", 1: "bigint", 2: "float", 3: "string", 11: "array<bigint>", 12: "array<float>", 13: "array<string>", 20: "array<array<string>>", 21: "array<array<bigint>>", 22: "array<array<float>>", 23: "array<array<string>>"}


def _seen(data: bytes, kind: str) -> Iterator[tuple[str, int, int]]:
    """(column, depth, rank) of one message."""
    m = message(kind)()
    m.ParseFromString(data)
    for name, f in (m.features if kind == "Example" else m.context).feature.items():
        which = f.WhichOneof("kind")
        n = len(getattr(f, which).value) if which else 0
        yield name, int(n > 1), _RANKS[which] if n else 0
    if kind != "Example":
        for name, lists in m.feature_lists.feature_list.items():
            yield name, 2, max((_RANKS[x.WhichOneof("kind")] for x in lists.feature if x.WhichOneof("kind") and len(getattr(x, x.WhichOneof("kind")).value)), default=0)


def _merged(found: dict[str, tuple[int, int]], seen) -> None:
    for name, depth, rank in seen:
        d, r = found.get(name, (0, 0))
        found[name] = max(d, depth), max(r, rank)


def _type_of(depth: int, rank: int) -> str:
    return _TYPES[rank if depth == 0 else 10 * depth + (3 if depth == 1 and not rank else rank)]


def infer_columns(spark: SparkSession, path: str, kind: str = "Example") -> DataFrame:
    """name, type of the columns of all records, by name: each task reports what its files say, one aggregation merges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, found = file_system(path)[0], {}
        for b in batches:
            for file in b.column(0).to_pylist():
                with fs.open_input_stream(file, compression=None) as f:
                    for datas in record_batches(f):
                        for data in datas:
                            _merged(found, _seen(data, kind))
        yield pa.record_batch([pa.array(list(found), pa.string()), pa.array([d for d, _ in found.values()], pa.int32()), pa.array([r for _, r in found.values()], pa.int32())], names=["name", "depth", "rank"])

    files = spark.createDataFrame([(f,) for f, _ in listing(path)[0]], "file string")
    merged = files.mapInArrow(run, "name string, depth int, rank int").groupBy("name").agg(F.max("depth").alias("depth"), F.max("rank").alias("rank"))
    code = F.when(F.col("depth") == 0, F.col("rank")).otherwise(F.col("depth") * 10 + F.when((F.col("depth") == 1) & (F.col("rank") == 0), 3).otherwise(F.col("rank")))
    names = F.create_map(*[F.lit(x) for k, v in _TYPES.items() for x in (k, v)])
    return merged.select("name", names[code].alias("type"))


def _as_schema(columns) -> T.StructType:
    def made(t: str) -> T.DataType:
        if t.startswith("array<"):
            return T.ArrayType(made(t[6:-1]))
        return {"bigint": T.LongType(), "float": T.FloatType(), "string": T.StringType()}[t]

    return T.StructType([T.StructField(n, made(t)) for n, t in sorted(columns)])


def infer_schema(spark: SparkSession, path: str, kind: str = "Example") -> T.StructType:
    """A schema with columns in order of their names; one row a column reaches the driver."""
    return _as_schema((r["name"], r["type"]) for r in infer_columns(spark, path, kind).collect())


def register(spark: SparkSession) -> None:
    """Makes the format ``tfrecords`` known to a session."""
    spark.dataSource.register(TFRecordSource)


def read_tfrecord(spark: SparkSession, path: str, schema: T.StructType | str | None = None, record_type: str = "Example") -> DataFrame:
    """The records under a path as rows; the schema is inferred from all records, by tasks, unless given. One task reads a file."""
    register(spark)
    return spark.read.format("tfrecords").schema(schema or infer_schema(spark, path, record_type)).option("recordType", record_type).load(path)


def as_example(df: DataFrame, out: str = "example", record_type: str = "Example") -> DataFrame:
    """``df`` with its rows as serialized messages in a binary column."""
    schema = df.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = pa.array([serialized(r, schema, record_type) for r in b.to_pylist()], pa.binary())
            yield pa.record_batch([*b.columns, made], names=[*b.schema.names, out])

    return df.mapInArrow(run, T.StructType([*schema.fields, T.StructField(out, T.BinaryType())]))


# ---- source


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    """One partition a file. Only the columns of the schema are decoded, so a narrow schema makes a narrow read."""

    def __init__(self, options: dict, schema: T.StructType):
        self.path, self.schema, self.kind = options["path"], schema, _kind(options)

    def partitions(self):
        return [_File(f) for f, _ in listing(self.path)[0]] or [_File("")]

    def read(self, partition):
        from pyspark.sql.pandas.types import to_arrow_schema

        if not partition.path:
            return
        arrow = to_arrow_schema(self.schema)
        with file_system(self.path)[0].open_input_stream(partition.path, compression=None) as f:
            for datas in record_batches(f):
                yield pa.RecordBatch.from_pylist([parsed(d, self.schema, self.kind) for d in datas], arrow)


# ---- sink


class _Done(WriterCommitMessage):
    def __init__(self, name: str, rows: int, columns: dict):
        self.name, self.rows, self.columns = name, rows, columns


def _seen_row(row, schema: T.StructType) -> Iterator[tuple[str, int, int]]:
    """What ``_seen`` says of the row's message."""
    for f in schema.fields:
        v, (depth, leaf) = row[f.name], _depth(f.dataType)
        if v is not None:
            rank = _RANKS[_list_of(leaf)]
            some = depth == 0 or (len(v) > 0 if depth == 1 else any(len(x) > 0 for x in v))
            yield f.name, (2 if depth == 2 else int(depth == 1 and len(v) > 1)), rank if some else 0


class _Writer(DataSourceWriter):
    """Attempts write apart, and a commit is one step: the manifest of the files that count, and the swap of two folders.

    Where folders can't be moved (object stores), files have names of their own in the output folder, and writing the manifest is
    the commit. The old output is deleted after that, so a commit that fails leaves it whole.
    """

    def __init__(self, options: dict, schema: T.StructType):
        self.path, self.schema, self.kind, self.codec = options["path"].rstrip("/"), schema, _kind(options), options.get("codec", "")
        self.job = uuid.uuid4().hex
        self.swap = options.get("commit", "swap" if file_system(self.path)[0].type_name in ("local", "hdfs") else "manifest") == "swap"

    def _beside(self, path: str, suffix: str) -> str:
        parent, _, name = path.rpartition("/")
        return f"{parent}/.{name}-{self.job}{suffix}"

    def _folder(self):
        fs, path = file_system(self.path)
        return fs, path, self._beside(path, "") if self.swap else path

    def write(self, rows):
        from pyspark import TaskContext

        fs, _, folder = self._folder()
        context = TaskContext.get()
        name = f"part-{context.partitionId():05d}-{self.job}-{context.taskAttemptId()}.tfrecord" + (".gz" if self.codec == "gzip" else "")
        fs.create_dir(folder, recursive=True)
        columns, pending, size, n = {}, [], 0, 0
        with fs.open_output_stream(f"{folder}/{name}", compression="gzip" if self.codec == "gzip" else None) as f:
            for r in rows:
                pending.append(serialized(r, self.schema, self.kind))
                _merged(columns, _seen_row(r, self.schema))
                n, size = n + 1, size + len(pending[-1])
                if len(pending) >= BATCH_ROWS or size >= BATCH_BYTES:
                    f.write(framed(*pending))
                    pending, size = [], 0
            if pending:
                f.write(framed(*pending))
        return _Done(name, n, columns)

    def commit(self, messages):
        from pyarrow import fs as pafs

        fs, path, folder = self._folder()
        fs.create_dir(folder, recursive=True)
        done, columns = {m.name: m for m in messages if m is not None}, {}
        for m in done.values():
            _merged(columns, ((n, d, r) for n, (d, r) in m.columns.items()))
        present = {x.base_name: x for x in fs.get_file_info(pafs.FileSelector(folder))}
        files = [{"name": n, "bytes": present[n].size, "rows": m.rows} for n, m in sorted(done.items())]
        text = json.dumps({"recordType": self.kind, "files": files, "columns": columns}).encode()
        old = [x for n, x in present.items() if n not in done and n != MANIFEST]
        if self.swap:
            self._delete(fs, old)  # of attempts that don't count
            self._put(fs, f"{folder}/{MANIFEST}", text)
            self._put(fs, f"{folder}/_SUCCESS", b"")
            self._swapped(fs, path, folder)
        else:
            self._put(fs, f"{path}/{MANIFEST}", text)
            self._delete(fs, old)
            self._put(fs, f"{path}/_SUCCESS", b"")

    def _swapped(self, fs, path: str, folder: str) -> None:
        aside, had = self._beside(path, "-old"), _exists(fs, path)
        if had:
            fs.move(path, aside)
        try:
            fs.move(folder, path)
        except BaseException:
            if had:
                fs.move(aside, path)
            raise
        if had:
            self._delete(fs, [fs.get_file_info(aside)])

    @staticmethod
    def _put(fs, path: str, text: bytes) -> None:
        with fs.open_output_stream(path, compression=None) as f:
            f.write(text)

    @staticmethod
    def _delete(fs, infos) -> None:
        for x in infos:
            (fs.delete_file if x.is_file else fs.delete_dir)(x.path)

    def abort(self, messages):
        from pyarrow import fs as pafs

        fs, path, folder = self._folder()
        if not _exists(fs, folder):
            return
        if self.swap:
            fs.delete_dir(folder)
        else:
            named = {f["name"] for f in (_manifest(fs, path) or {"files": []})["files"]}
            self._delete(fs, [x for x in fs.get_file_info(pafs.FileSelector(path)) if self.job in x.base_name and x.base_name not in named])


def _kind(options: dict) -> str:
    kind = options.get("recordtype", options.get("recordType", "Example"))
    if kind not in ("Example", "SequenceExample"):
        raise ValueError(f"recordType {kind} is neither Example nor SequenceExample")
    return kind


class TFRecordSource(DataSource):
    """The format ``tfrecords``. Options: path; recordType (Example or SequenceExample); for writing codec ("" or gzip).

    Read without a schema, the columns come from the manifests that this sink writes. Files of other writers are scanned for them as the
    query is planned, which one process does: above ``inferBytes`` bytes (256 MiB unless given) that is refused, and ``infer_schema``,
    which scans in tasks, gives the schema to read with.
    """

    @classmethod
    def name(cls):
        return "tfrecords"

    def schema(self):
        options, found = dict(self.options), {}
        files, manifests = listing(options["path"])
        if manifests and all(m is not None and m["recordType"] == _kind(options) for m in manifests):
            for m in manifests:
                _merged(found, ((n, d, r) for n, (d, r) in m["columns"].items()))
        else:
            if sum(size for _, size in files) > int(options.get("inferbytes", options.get("inferBytes", 256 << 20))):
                raise ValueError("too many bytes to infer a schema in planning; read with the schema that infer_schema gives")
            fs = file_system(options["path"])[0]
            for file, _ in files:
                with fs.open_input_stream(file, compression=None) as f:
                    for datas in record_batches(f):
                        for data in datas:
                            _merged(found, _seen(data, _kind(options)))
        return _as_schema((n, _type_of(d, r)) for n, (d, r) in found.items())

    def reader(self, schema):
        return _Reader(dict(self.options), schema)

    def writer(self, schema, overwrite):
        if not overwrite:
            raise ValueError("append isn't supported for TFRecord files")
        for f in schema.fields:
            _list_of(_depth(f.dataType)[1])
        return _Writer(dict(self.options), schema)


def write_tfrecord(df: DataFrame, path: str, mode: str = "errorIfExists", record_type: str = "Example", codec: str = "", tasks: int | None = None) -> None:
    """Writes TFRecord files. Modes: overwrite, errorIfExists, ignore; append is refused.

    ``tasks`` deals the rows to so many tasks, a file each, for a table that is read in a few: records are made and read a row at a time, and a file by one task.
    """
    if mode not in ("overwrite", "errorIfExists", "error", "ignore"):
        raise ValueError(f"mode {mode} isn't supported for TFRecord files")
    exists = _exists(*file_system(path))
    if exists and mode == "ignore":
        return
    if exists and mode != "overwrite":
        raise FileExistsError(path)
    for f in df.schema.fields:
        _list_of(_depth(f.dataType)[1])
    register(df.sparkSession)
    df = df.repartition(tasks) if tasks else df
    df.write.format("tfrecords").mode("overwrite").option("path", path).option("recordType", record_type).option("codec", codec).save()
