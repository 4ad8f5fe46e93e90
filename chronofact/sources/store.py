"""Storage: write-once objects with hash manifests (W1, S7), tables replaced by partition (W2-W5), small tables swapped."""

from __future__ import annotations

import datetime
import hashlib
import json
import os
import shutil
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_sha256(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


class LocalFiles:
    """Files of a mounted folder."""

    def read(self, path: str) -> str | None:
        if not os.path.exists(path):
            return None
        with open(path) as f:
            return f.read()

    def write(self, path: str, text: str) -> None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        part = f"{path}.{uuid.uuid4().hex}"
        with open(part, "w") as f:
            f.write(text)
        os.replace(part, path)

    def copy_in(self, local: str, path: str) -> None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        part = f"{path}.{uuid.uuid4().hex}"
        shutil.copyfile(local, part)
        os.replace(part, path)

    def names(self, root: str) -> list[str]:
        """All files under root, relative to it."""
        return [os.path.relpath(os.path.join(folder, n), root) for folder, _, names in os.walk(root) for n in names]


class HadoopFiles:
    """The same on any file system that Spark reads (hdfs, object stores); a file appears when its stream is closed."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def read(self, path: str) -> str | None:
        fs, p = hadoop_path(self.spark, path)
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        fs, p = hadoop_path(self.spark, path)
        stream = fs.create(p, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def copy_in(self, local: str, path: str) -> None:
        fs, p = hadoop_path(self.spark, path)
        fs.copyFromLocalFile(False, True, self.spark._jvm.org.apache.hadoop.fs.Path(f"file://{os.path.abspath(local)}"), p)

    def names(self, root: str) -> list[str]:
        fs, p = hadoop_path(self.spark, root)
        if not fs.exists(p):
            return []
        top = fs.resolvePath(p).toString().rstrip("/") + "/"
        out, files = [], fs.listFiles(p, True)  # fetched piece by piece
        while files.hasNext():
            out.append(files.next().getPath().toString().removeprefix(top))
        return out


@dataclass
class ObjectStore:
    """Objects under a folder, each with a manifest that is written last: an object without one isn't there.

    A root with a scheme (hdfs://, s3a://, file://) needs a session, whose file systems are used.
    """

    root: str
    spark: SparkSession | None = None

    def __post_init__(self):
        remote = "://" in self.root
        self.files = HadoopFiles(self.spark or SparkSession.getActiveSession()) if remote else LocalFiles()

    def path(self, key: str) -> str:
        return f"{self.root.rstrip('/')}/{key}"

    def manifest(self, key: str) -> dict | None:
        text = self.files.read(self.path(key) + ".manifest.json")
        return json.loads(text) if text is not None else None

    def put_file(self, path: str, key: str, source_url: str = "", **extras) -> dict:
        """The manifest, with skipped=True if the same content was there already."""
        sha = file_sha256(path)
        old = self.manifest(key)
        if old and old["sha256"] == sha:
            return old | {"skipped": True}
        self.files.copy_in(path, self.path(key))
        new = {"key": key, "sha256": sha, "bytes": os.path.getsize(path), "source_url": source_url, "landed_at": datetime.datetime.now(datetime.UTC).isoformat(), "extras": extras}
        self.files.write(self.path(key) + ".manifest.json", json.dumps(new))
        return new | {"skipped": False}

    def manifests(self, prefix: str = "") -> Iterable[dict]:
        """Manifests of all objects whose key begins with the prefix, by key."""
        keys = sorted(n.removesuffix(".manifest.json") for n in self.files.names(self.root) if n.endswith(".manifest.json"))
        return [self.manifest(k) for k in keys if k.startswith(prefix)]


@dataclass
class PartitionedTable:
    """A parquet table of one partition column whose partitions are replaced whole."""

    spark: SparkSession
    path: str
    schema: object
    partition: str = "quarter"

    def exists(self) -> bool:
        fs, p = hadoop_path(self.spark, self.path)
        return fs.exists(p)

    def ensure(self, name: str | None = None) -> None:
        """The table is there afterwards, with its schema and partition column; under a name in the catalog if asked."""
        if not self.exists():
            fs, p = hadoop_path(self.spark, self.path)
            fs.mkdirs(p)
        if name:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
            self.spark.sql(f"create table if not exists {name} ({columns}) using parquet partitioned by (`{self.partition}`) location '{self.path}'")
            self.spark.sql(f"msck repair table {name}")

    def read(self) -> DataFrame:
        """Filters on the partition column prune folders, others reach the files."""
        if not self.exists():
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path).select(*self.schema.names)

    def replace(self, df: DataFrame, value: str, n_rows: int | None = None) -> None:
        """Exactly this partition is replaced. An empty frame empties it (a dynamic overwrite alone would leave it).
        n_rows: of this partition, if the caller has counted them."""
        rows = df.where(F.col(self.partition) == value)
        if rows.isEmpty() if n_rows is None else not n_rows:
            fs, p = hadoop_path(self.spark, f"{self.path}/{self.partition}={value}")
            fs.delete(p, True)
            return
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.partition).parquet(self.path)

    def append(self, df: DataFrame) -> None:
        df.write.mode("append").partitionBy(self.partition).parquet(self.path)


@dataclass
class SwapTable:
    """A small table: every change writes a new folder and then moves a one-line pointer to it."""

    spark: SparkSession
    path: str
    schema: str

    def _current(self) -> str | None:
        fs, p = hadoop_path(self.spark, self.path)
        if not fs.exists(p):
            return None
        names = sorted(s.getPath().getName() for s in fs.listStatus(p) if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")))
        return f"{self.path}/{names[-1]}" if names else None

    def read(self) -> DataFrame:
        now = self._current()
        return self.spark.read.schema(self.schema).parquet(now) if now else self.spark.createDataFrame([], self.schema)

    def rewrite(self, change: Callable[[DataFrame], DataFrame]) -> None:
        """The newest folder with its success mark is the table; a write that breaks off changes nothing."""
        old = self._current()
        number = int(old.rsplit("v", 1)[1]) + 1 if old else 0
        change(self.read()).coalesce(1).write.parquet(f"{self.path}/v{number:012d}")
        # the one before stays for readers that hold it; older ones go
        fs, p = hadoop_path(self.spark, self.path)
        for s in fs.listStatus(p):
            if s.getPath().getName() < f"v{number - 1:012d}":
                fs.delete(s.getPath(), True)

    def append(self, rows: list[tuple]) -> None:
        """Rows are added as a file of their own; what is there isn't read or rewritten."""
        self.append_frame(self.spark.createDataFrame(rows, self.schema))

    def append_frame(self, df: DataFrame) -> None:
        now = self._current()
        if now is None:
            self.rewrite(lambda t: t.unionByName(df))
        else:
            df.coalesce(1).write.mode("append").parquet(now)
