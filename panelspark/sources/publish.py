"""Publishing a table: written aside, checked, then made visible by one rename.

A published table is a folder with ``data/<version>`` (Parquet) and ``manifest/<number>.json``.  Readers take the data folder that the
manifest of the largest number names, so they see the version before or the one after, never a part of one.

``publish_table`` writes the frame to its version's folder, counting rows and summing a hash of every row as they are written, reads
the files back, and compares.  Only then a manifest is written aside and renamed to the next number; a rename does not
replace a file, so of two writers with the same number one fails.  A retry with the same ``version`` writes the same folder anew, or,
if that version is already published, writes nothing.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class _Folder:
    """Small files of a store, by Hadoop's file system interface (any store that Spark reads)."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.root = path.rstrip("/")
        self.fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        at = self._path(folder)
        return [f.getPath().getName() for f in self.fs.listStatus(at)] if self.fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put(self, name: str, text: str) -> bool:
        """Makes a whole file appear under a name; False if the name is taken."""
        aside = self._path(f"{name}.{uuid.uuid4()}.tmp")
        self.fs.mkdirs(aside.getParent())
        stream = self.fs.create(aside, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        done = not self.fs.exists(self._path(name)) and self.fs.rename(aside, self._path(name))
        if not done:
            self.fs.delete(aside, False)
        return done


def _manifests(folder: _Folder) -> list[int]:
    return sorted(int(m[1]) for n in folder.names("manifest") if (m := re.fullmatch(r"(\d+)\.json", n)))


def _name(number: int) -> str:
    return f"manifest/{number:010}.json"


def _totals(columns: Sequence[str]) -> list[Column]:
    """Rows, and two sums over a hash of each whole row: they do not depend on order or partitioning."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in columns])
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0)).cast("string").alias("hash_sum"), F.coalesce(F.bit_xor(row), F.lit(0).cast("long")).alias("hash_xor")]


def published_versions(spark: SparkSession, path: str) -> list[dict]:
    """The manifests of a published table, oldest first."""
    folder = _Folder(spark, path)
    return [json.loads(folder.read(_name(n))) | {"number": n} for n in _manifests(folder)]


def publish_table(df: DataFrame, path: str, version: str | None = None, partition_by: Sequence[str] = ()) -> dict:
    """Publishes ``df`` as the newest version of the table at ``path``; returns its manifest.

    ``version`` names the attempt (letters, digits, ``-_.``): the same name again is the same version.  A frame whose written rows differ from
    those read back raises, and readers go on seeing the version before.
    """
    spark, version = df.sparkSession, version or str(uuid.uuid4())
    if not re.fullmatch(r"[\w.-]+", version):
        raise ValueError(f"not a version name: {version!r}")
    for m in published_versions(spark, path):
        if m["version"] == version:
            return m
    folder, data = _Folder(spark, path), f"{path.rstrip('/')}/data/{version}"
    seen = Observation()
    writer = df.observe(seen, *_totals(df.columns)).write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(data)
    written = seen.get
    back = spark.read.schema(df.schema).parquet(data).agg(*_totals(df.columns)).first().asDict()
    if written != back:
        raise RuntimeError(f"{data}: wrote {written}, read back {back}")
    numbers = _manifests(folder)
    manifest = {"version": version, "data": data, "schema": df.schema.json(), **back}
    number = (numbers[-1] if numbers else 0) + 1
    if not folder.put(_name(number), json.dumps(manifest)):
        raise RuntimeError(f"another writer published number {number} at {path}; publish again")
    return manifest | {"number": number}


def read_published(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """The newest published version of a table, or the named one."""
    found = [m for m in published_versions(spark, path) if version in (None, m["version"])]
    if not found:
        raise FileNotFoundError(f"nothing published at {path}" + (f" as {version!r}" if version else ""))

    schema = StructType.fromJson(json.loads(found[-1]["schema"]))
    return spark.read.schema(schema).parquet(found[-1]["data"]).select(*[f"`{c}`" for c in schema.names])
