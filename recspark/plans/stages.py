"""The stages of a job as tables in a folder, so that a job that was killed goes on where it stood."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "digest string, folder string, schema string, n_rows long, inputs string"


def digest(*parts) -> str:
    """A name for values that JSON can express."""
    return hashlib.sha256(json.dumps(parts, sort_keys=True).encode()).hexdigest()[:20]


def source_digest(df: DataFrame, version: str = "") -> str:
    """What ``df`` is computed from: its columns, the path, size and time of each file that it reads, and ``version``.

    The files are listed, not opened, and their digest is summed by Spark. The plan between files and ``df`` isn't part of it: ``version``
    stands for that, and for sources other than files, where it must be given.
    """
    files = sorted(df.inputFiles())
    if not files:
        if not version:
            raise ValueError("rows that no file holds need a version")
        return digest(df.schema.json(), version)
    listed = df.sparkSession.read.format("binaryFile").load(files).select(F.xxhash64("path", "length", "modificationTime").alias("h"))
    seen = listed.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("h")).first()
    return digest(df.schema.json(), version, seen["n"], str(seen["h"]))


class Stages:
    """Tables of one job in ``path``, a folder that all executors share. One job at a time may use it.

    A table's folder is named by its stage and a digest of its inputs. A manifest, written when the table is whole, makes the stage a
    finished one: a later run with the same inputs takes the table, and anything else, half-written tables included, is made anew. Tables
    of other inputs stay, so a job can go back to them; ``taken`` and ``made`` tell what a run did.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.taken: list[str] = []
        self.made: list[str] = []

    def finished(self, name: str, key: str) -> DataFrame | None:
        try:
            found = self.spark.read.schema(MANIFEST).json(f"{self.path}/manifests/{name}-{key}").where(F.col("digest") == key).head(1)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return self._table(found[0]["folder"], found[0]["schema"]) if found else None

    def _table(self, folder: str, schema: str) -> DataFrame:
        return self.spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(f"{self.path}/{folder}")

    def table(self, name: str, inputs: list, make: Callable[[], DataFrame], by: list[str] | None = None) -> DataFrame:
        """The table of a stage; ``make`` is called where no finished one has these inputs. ``by`` names columns that become folders."""
        key = digest(name, inputs)
        known = self.finished(name, key)
        if known is not None:
            self.taken.append(name)
            return known
        df, folder = make(), f"{name}-{key}"
        writer = df.write.mode("overwrite")
        (writer.partitionBy(*by) if by else writer).parquet(f"{self.path}/{folder}")
        schema = df.schema.json()
        row = [(key, folder, schema, self._table(folder, schema).count(), json.dumps(inputs, sort_keys=True))]
        self.spark.createDataFrame(row, MANIFEST).coalesce(1).write.mode("overwrite").json(f"{self.path}/manifests/{folder}")
        self.made.append(name)
        return self._table(folder, schema)
