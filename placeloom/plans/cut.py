"""Lineage cuts, size-checked broadcasts and code shipping."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a side may be broadcast. The side is counted first; a larger one is shuffled.
BROADCAST_ROWS = 20_000


def _temporary() -> str:
    """A folder of the driver's machine that goes when Python does."""
    at = tempfile.mkdtemp(prefix="placeloom-")
    atexit.register(shutil.rmtree, at, True)
    return at


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; set only where the session has none."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        given = sc.getConf().get("spark.checkpoint.dir", None)
        if given is None and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(given or _temporary())
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """``df`` with its lineage cut by a reliable checkpoint, so that the loss of an executor costs no recomputation."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager)


class _Scopes(threading.local):
    def __init__(self) -> None:
        self.open: list[set[str]] = []


_scopes = _Scopes()
_SWEEP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _swept(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of an action inside go when it ends; otherwise they stay until the driver happens to collect its garbage."""
    before = spark.conf.get(_SWEEP, None)
    spark.conf.set(_SWEEP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_SWEEP) if before is None else spark.conf.set(_SWEEP, before)


def cut_table(df: DataFrame) -> DataFrame:
    """The same by a compressed Parquet table in the checkpoint folder, whose shuffles go at once: for wide rows of which later steps read a part, and for what would fill the disks."""
    return cut_parts([df])


def cut_parts(parts: Iterable[DataFrame]) -> DataFrame:
    """One such table of one or more ``parts`` with one schema, written one after the other: the disks hold the shuffles of one part at a time."""
    out = None
    for df in parts:
        spark, schema = df.sparkSession, df.schema
        if out is None:
            out = f"{checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
            if _scopes.open:
                _scopes.open[-1].add(out)
        with _swept(spark):
            df.write.mode("append").option("compression", "zstd").parquet(out)
    table = spark.read.schema(schema).parquet(out)
    table._table = out
    return table


def release(table: DataFrame) -> None:
    """Delete a table of :func:`cut_table` that nothing reads any more."""
    for scope in _scopes.open:
        scope.discard(table._table)
    _delete(table.sparkSession, table._table)


def _delete(spark: SparkSession, at: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


@contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables that are cut inside go at the end, but for those given to the function that this yields."""
    mine: set[str] = set()
    _scopes.open.append(mine)

    def keep(table: DataFrame) -> DataFrame:
        mine.discard(table._table)
        if len(_scopes.open) > 1:
            _scopes.open[-2].add(table._table)
        return table

    try:
        yield keep
    finally:
        _scopes.open.pop()
        for at in mine:
            _delete(spark, at)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it holds at most ``rows`` rows, else unchanged. The count stops after ``rows + 1`` rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def spread(df: DataFrame) -> DataFrame:
    """``df`` in at least as many partitions as there are cores: a single small file would otherwise be worked off by one core. Larger inputs stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, wherever they run; once per session."""
    sc = spark.sparkContext
    if getattr(sc, "_placeloom", False):
        return
    root = Path(__file__).resolve().parents[1]
    at = os.path.join(_temporary(), "placeloom.zip")
    with zipfile.ZipFile(at, "w") as z:
        for p in root.rglob("*.py"):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(at)
    sc._placeloom = True
