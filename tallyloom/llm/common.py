"""What the operators share: folders that all executors see, written tables, Arrow helpers."""

from __future__ import annotations

import ctypes
import os
import threading
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text, and rows, that an operator turns into Python objects at a time.
SLICE_BYTES, SLICE_ROWS = 1 << 20, 512
#: Of tables on the way: near copies that lie side by side take little room.
CODEC = "zstd"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder (a URI) under ``spark.checkpoint.dir``, which driver and executors share.

    Where that setting is absent, the folder set by ``SparkContext.setCheckpointDir`` serves; with neither,
    in local mode alone, one under the warehouse.
    """
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or context._jsc.sc().getCheckpointDir().getOrElse(None)
    if not base:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/tallyloom/{name}-{uuid.uuid4().hex}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_switch, _writers = threading.Lock(), {}


def _writing(spark: SparkSession, more: int) -> None:
    """Count the session's writes that run: shuffle files are cleaned up while there is one, and as before after the last."""
    key = spark._jsparkSession.hashCode()
    with _switch:
        running, before = _writers.get(key, (0, None))
        if not running:
            before = spark.conf.get(CLEANUP, "false")
            spark.conf.set(CLEANUP, "true")
        if running + more:
            _writers[key] = (running + more, before)
        else:
            _writers.pop(key)
            spark.conf.set(CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage ends there, and lost executors cost nothing.

    Shuffle files of the write go with it: whoever reads the table needs them no more.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    _writing(spark, 1)
    try:
        df.write.parquet(path, compression=CODEC)
    finally:
        _writing(spark, -1)
    out = spark.read.schema(df.schema).parquet(path)
    out._folder = path
    return out


def shielded(df: DataFrame, outputs: list[str]) -> tuple[DataFrame, dict[str, str], list[Column]]:
    """``df`` under names that no scratch column has, the new name of each column, and the columns under their own names.

    A column named like an output is kept under that name with ``_input`` behind it.
    """
    inner = df.toDF(*(f"in {i}" for i in range(len(df.columns))))
    back = [F.col(f"in {i}").alias(c) for i, c in enumerate(set_aside(df, outputs).columns)]
    return inner, {c: f"in {i}" for i, c in enumerate(df.columns)}, back


def set_aside(df: DataFrame, outputs: list[str]) -> DataFrame:
    """``df`` whose columns named like an output are renamed: ``_input`` stands behind the name."""
    taken = {c.lower() for c in [*df.columns, *outputs]}
    names = []
    for c in df.columns:
        if c.lower() in {x.lower() for x in outputs}:
            c += "_input"
            while c.lower() in taken:
                c += "_"
            taken.add(c.lower())
        names.append(c)
    return df.toDF(*names)


def fresh(df: DataFrame, name: str) -> str:
    """A name that no column has."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def id_name(id_col: str, outputs: list[str]) -> str:
    """The id's name in an output: its own, with ``_input`` behind it if an output has that name."""
    return f"{id_col}_input" if id_col.lower() in {x.lower() for x in outputs} else id_col


_held: dict[Any, Any] = {}


def worker_state(key: Any, make: Callable[[], Any]) -> Any:
    """What this Python worker keeps from task to task: the state of one operator at a time, as workers outlive stages."""
    if key not in _held:
        release()
        _held[key] = make()
    return _held[key]


def release() -> None:
    """Drop the worker's state and give freed memory back to the system."""
    _held.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def slices(batch: pa.RecordBatch, column: str, rows: int = SLICE_ROWS, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``rows`` rows and about ``size`` bytes of a string column (one row at least)."""
    ends = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).cumsum()
    at = 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        to = min(at + rows, max(at + 1, int(ends.searchsorted(before + size, "right"))))
        yield batch.slice(at, to - at)
        at = to


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's estimate, from the sizes of files: no job runs."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``written`` made, once nothing that is still to run reads them."""
    for t in tables:
        removed(t.sparkSession, t._folder)


def removed(spark: SparkSession, folder: str) -> None:
    """Delete a folder in the shared store."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder's URI and the path in it; a bare path is local."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else "file://" + os.path.abspath(uri))


def local_path(uri: str) -> str | None:
    """The path to memory-map, or None if the store isn't mounted."""
    kind, path = filesystem(uri)
    return path if isinstance(kind, pafs.LocalFileSystem) else None


def publish(uri: str, name: str, data: bytes | list[bytes]) -> None:
    """Write one whole file under a private name and move it into place: a retried or doubled task does no harm."""
    store, path = filesystem(uri)
    store.create_dir(path, recursive=True)
    part = f"{path}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(part) as out:
        for piece in [data] if isinstance(data, bytes) else data:
            out.write(piece)
    store.move(part, f"{path}/{name}")


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """A column's strings, null as empty."""
    return [x or "" for x in batch.column(column).to_pylist()]


def raw(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """A column's strings as UTF-8, null as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def map_slices(
    df: DataFrame, column: str, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str
) -> DataFrame:
    """``mapInArrow``, a slice at a time, cut by the bytes of a string column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from map(function, slices(batch, column))

    return df.mapInArrow(run, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Values that are looked for as hot ones at most; no other value holds more than one in so many rows.
SHARES = 1 << 12


def hot_values(df: DataFrame, key: str, shares: int = SHARES) -> DataFrame:
    """The values of ``key`` that more than one in ``shares`` rows hold: fewer than ``shares`` rows by arithmetic.

    Counts are pre-aggregated in each task, so a hot value doesn't gather anywhere.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    total = df.count()
    return counts.where(F.col("_n") > F.lit(max(total // shares, 1000))).select(key)


def join_by_hot_key(left: DataFrame, right: DataFrame, key: str, shares: int = SHARES) -> DataFrame:
    """Left join on ``key``, where ``right`` has a row for each key at most.

    Rows of ``left`` whose key is hot meet their rows of ``right`` by a broadcast of fewer than
    ``shares`` rows (a bound by arithmetic); no other key has more than one in ``shares`` rows.
    """
    hot = hot_values(left, key, shares).collect()  # fewer than ``shares`` rows
    if not hot:
        return left.join(right, key, "left")
    keys = F.broadcast(left.sparkSession.createDataFrame(hot, left.select(key).schema))
    warm = F.broadcast(right.join(keys, key, "left_semi"))
    rest = left.join(keys, key, "left_anti").join(right.join(keys, key, "left_anti"), key, "left")
    return rest.unionByName(left.join(keys, key, "left_semi").join(warm, key, "left"))
