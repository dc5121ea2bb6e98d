"""A table kept in key buckets, of which an update rewrites only those that it touches.

Rows are dealt into buckets by a hash of their key. A version is a small
manifest that says in which folder each bucket's files are; it is written last,
so an update that fails leaves the version before, and readers of a version are
not disturbed by the next one. Folders that no kept version names are removed.
One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Merge = Callable[[DataFrame, DataFrame], DataFrame]


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share; below the warehouse where that is unset.

    A warehouse of one machine will do on that machine alone: on a cluster it is
    an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir")
        if urlparse(root).scheme in ("", "file") and not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share; the warehouse {root} is local")
    return f"{root.rstrip('/')}/paperflow-{name}-{uuid.uuid4().hex}"


#: A setting under which shuffled data go when the table made from them is written.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, folder: str) -> DataFrame:
    """A table written to a new folder within this one and read back, so that its size is known and it is worked out once."""
    spark, path = df.sparkSession, f"{folder}/{uuid.uuid4().hex}"
    before = spark.conf.get(FILE_CLEANUP, None)
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(FILE_CLEANUP) if before is None else spark.conf.set(FILE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


class Folder:
    """Files of any Hadoop file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark.sparkContext._jvm, path.rstrip("/")
        self.files = self.at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str) -> list[str]:
        path = self.at(name)
        return sorted(s.getPath().getName() for s in self.files.listStatus(path)) if self.files.exists(path) else []

    def read(self, name: str) -> str:
        stream = self.files.open(self.at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """A file that is there whole or not at all; an error if it is there already."""
        if self.files.exists(self.at(name)):
            raise FileExistsError(f"{self.path}/{name}")
        part = f"{name}.{uuid.uuid4().hex}.part"
        stream = self.files.create(self.at(part), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self.files.rename(self.at(part), self.at(name)):
            raise FileExistsError(f"{self.path}/{name}")

    def remove(self, name: str) -> None:
        self.files.delete(self.at(name), True)


@dataclass(frozen=True)
class Version:
    """number is -1 before the first update; tag is what the caller named its last update by; buckets tells the folder of each bucket that has rows."""

    number: int = -1
    tag: int = -1
    buckets: dict[int, str] | None = None


class BucketTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int = 64):
        self.spark, self.schema, self.key, self.buckets = spark, schema, key, buckets
        self.folder = Folder(spark, path)

    def bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key.cast(self.schema[self.key].dataType)), F.lit(self.buckets)).cast("int")

    def versions(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self.folder.names("versions") if n.endswith(".json"))

    def version(self, number: int | None = None) -> Version:
        """A version, the newest by default; the empty one before the first update. One that is missing is an error."""
        known = self.versions()
        if number is None:
            number = known[-1] if known else -1
        if number < 0:
            return Version(buckets={})
        if number not in known:
            raise FileNotFoundError(f"{self.folder.path} has no version {number}")
        found = json.loads(self.folder.read(f"versions/{number}.json"))
        if found["count"] != self.buckets or found["key"] != self.key:
            raise ValueError(f"{self.folder.path} has {found['count']} buckets by {found['key']}")
        return Version(number, found["tag"], {int(b): f for b, f in found["buckets"].items()})

    def read(self, version: Version | None = None, only: set[int] | None = None) -> DataFrame:
        """The rows of a version, of some buckets only if asked for."""
        version = version or self.version()
        paths = [f"{self.folder.path}/data/{f}/bucket={b}" for b, f in sorted(version.buckets.items()) if only is None or b in only]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def update(self, changes: DataFrame, merge: Merge, tag: int | None = None, keep: int = 2) -> Version:
        """A new version in which the buckets that `changes` touch hold what `merge` makes of (their rows, their changes).

        `merge` must not make rows of other keys than those it is given. An update
        whose tag is not above the newest version's has been made before and
        changes nothing. The newest `keep` versions stay.
        """
        before = self.version()
        if tag is not None and tag <= before.tag:
            return before
        dealt = changes.withColumn("bucket", self.bucket(F.col(self.key)))
        touched = {r["bucket"] for r in dealt.select("bucket").distinct().collect()}  # at most as many as there are buckets
        after = dict(before.buckets)
        if touched:
            merged = merge(self.read(before, touched), changes).select(*self.schema.names)
            name = f"{before.number + 1}-{uuid.uuid4().hex}"
            # a large bucket is more than one file; small ones are one
            files = merged.withColumn("bucket", self.bucket(F.col(self.key))).hint("rebalance", "bucket")
            files.write.partitionBy("bucket").parquet(f"{self.folder.path}/data/{name}")
            written = {int(n.removeprefix("bucket=")) for n in self.folder.names(f"data/{name}") if n.startswith("bucket=")}
            if not written <= touched:
                raise ValueError(f"rows for buckets {sorted(written - touched)} that no change touches")
            after = {b: f for b, f in after.items() if b not in touched} | {b: name for b in written}
        new = Version(before.number + 1, before.tag if tag is None else tag, after)
        self.commit(new)
        self.clean(keep)
        return new

    def commit(self, version: Version) -> None:
        manifest = {"count": self.buckets, "key": self.key, "tag": version.tag, "buckets": {str(b): f for b, f in sorted(version.buckets.items())}}
        self.folder.write(f"versions/{version.number}.json", json.dumps(manifest))

    def clean(self, keep: int) -> None:
        """Remove all but the newest versions, and buckets that none of these names."""
        known = self.versions()
        kept = [self.version(n) for n in known[-keep:]]
        used = {(f, b) for v in kept for b, f in v.buckets.items()}
        for n in known[:-keep]:
            self.folder.remove(f"versions/{n}.json")
        for name in self.folder.names("data"):
            if not any(f == name for f, _ in used):
                self.folder.remove(f"data/{name}")
                continue
            for part in self.folder.names(f"data/{name}"):
                if part.startswith("bucket=") and (name, int(part.removeprefix("bucket="))) not in used:
                    self.folder.remove(f"data/{name}/{part}")
