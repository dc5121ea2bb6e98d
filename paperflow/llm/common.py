"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of text per Arrow batch. Texts run to tens of kilobytes and more, so the defaults (10,000 rows, 64 MB) can take a worker's memory.
BATCH_ROWS, BATCH_BYTES = 500, 16 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of texts small; a session that asks for smaller ones keeps its own settings.

    The settings stay, since results are lazy: they count when a result is computed.
    """
    rows, size = (f"spark.sql.execution.arrow.max{x}PerBatch" for x in ("Records", "Bytes"))
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)
    number, unit = re.fullmatch(r"(\d+)([kmg]?)b?", spark.conf.get(size).lower()).groups()
    if int(number) << {"": 0, "k": 10, "m": 20, "g": 30}[unit] > BATCH_BYTES:
        spark.conf.set(size, BATCH_BYTES)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session's setting for the jobs within; here: shuffled data go when the table made from them is written."""
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share.

    Where that is unset, below the warehouse: on one machine, as in tests, or if
    the warehouse is on a shared file system. A local one on a cluster is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir")
        if urlparse(root).scheme in ("", "file") and not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share; the warehouse {root} is local")
    path = f"{root.rstrip('/')}/paperflow-{name}-{uuid.uuid4().hex}"
    for made in _open.get():
        made.append(path)
    return path


#: Folders made within each open `temporary` block, of this thread alone.
_open: ContextVar[tuple[list[str], ...]] = ContextVar("open", default=())


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Folders made within are removed at the end: for what has been computed and written elsewhere by then."""
    mine: list[str] = []
    token = _open.set((*_open.get(), mine))
    try:
        yield
    finally:
        _open.reset(token)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in mine:
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)


def fresh(name: str, taken: Iterable[str]) -> str:
    """A column name that is not taken, in any case."""
    known = {t.lower() for t in taken}
    while name.lower() in known:
        name += "_"
    return name


#: A setting under which shuffled data go when the table made from them is written.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage, and survives lost executors."""
    path = shared_dir(df.sparkSession, name)
    with setting(df.sparkSession, FILE_CLEANUP, "true"):
        df.write.parquet(path, **options)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str, n: int) -> Column:
    """crc32 of the key as text, modulo n; null keys fall in fold 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % n, F.lit(0))


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def replaced(batch: pa.RecordBatch, drop: str, new: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch without one column and with new ones behind the rest."""
    keep = [i for i, n in enumerate(batch.schema.names) if n != drop]
    return pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), *new.values()], names=[*(batch.schema.names[i] for i in keep), *new])


def slices(sizes: list[int], limit: int) -> Iterator[slice]:
    """Consecutive slices of at most `limit` in total size; a larger item stands alone."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield slice(start, len(sizes))
