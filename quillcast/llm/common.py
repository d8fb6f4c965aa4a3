"""Helpers that the training-data operators share: shared-folder tables, let-bindings, global ranks."""

from __future__ import annotations

import atexit
import ctypes
import gc
import shutil
import tempfile
import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words are runs of anything but ASCII white space, as Java's regex has it.
WORD_REGEX = r"[^\x20\x09-\x0D]+"
_SET_HERE: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where unset on a local master, a temporary one of our own."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _SET_HERE:
        _SET_HERE[app] = tempfile.mkdtemp(prefix="quillcast-")
        atexit.register(shutil.rmtree, _SET_HERE[app], ignore_errors=True)
    return "file://" + _SET_HERE[app]


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage: a lost executor costs the reader nothing that was computed before.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._shared_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``materialize`` that nothing will read again (all that was computed from them is written).

    The driver's collector is asked to run, so that Spark's cleaner drops the shuffle files behind them too.
    """
    for df in tables:
        path = getattr(df, "_shared_path", None)
        if path:
            jvm = df.sparkSession._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)
    if tables:
        drop_shuffles(tables[0].sparkSession)


def drop_shuffles(spark: SparkSession) -> None:
    """Ask the driver's collector to run: Spark's cleaner then drops the shuffle files of plans that have ended."""
    spark._jvm.java.lang.System.gc()


def release() -> None:
    """Give freed memory back to the system: Python workers live on, and what they hold counts against their executor."""
    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


class Lean(partial):
    """A function of Arrow batches that sees a few rows at a time and leaves no memory behind."""

    ROWS = 256

    def __call__(self, batches):
        yield from super().__call__(b.slice(i, self.ROWS) for b in batches for i in range(0, b.num_rows, self.ROWS))
        release()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``body`` (which may hold lambdas) by reference."""
    return F.transform(F.array(value), body)[0]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that clash with none of ``df``'s (Spark ignores case)."""
    have = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in have:
            n = "_" + n
        have.add(n.lower())
        out.append(n)
    return out


def cell_of(value: Column, bounds: list) -> Column:
    """How many of the sorted ``bounds`` lie below ``value`` (0 for null)."""
    if not bounds:
        return F.lit(0)
    edges = F.array(*[F.lit(b) for b in bounds])
    return F.coalesce(F.size(F.filter(edges, lambda b: b < value)), F.lit(0))


def crc_text(col: Column) -> Column:
    """crc32 of a number written as decimal text."""
    return F.crc32(col.cast("string"))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranked(df: DataFrame, keys: list[Column], rank: str, total: str, tag: str) -> DataFrame:
    """Add the 0-based rank of each row in the order of ``keys`` and the number of rows.

    Rows are dealt by ranges of the keys, sorted inside each range and written once with their place
    there; the ranges' sizes (one row a range) are then summed up and joined. No task sees more than a range.
    """
    pid, idx, start = fresh(df, "pid", "idx", "start")
    place = F.monotonically_increasing_id()
    sorted_ = df.repartitionByRange(partitions(df.sparkSession), *keys).sortWithinPartitions(*keys)
    kept = materialize(sorted_.withColumn(idx, place), tag)
    kept = kept.withColumn(pid, F.shiftright(idx, 33)).withColumn(idx, F.col(idx).bitwiseAND(F.lit((1 << 33) - 1)))
    # one row for each range, so a single window task is bounded by the number of partitions
    w = Window.orderBy(pid)
    sizes = kept.groupBy(pid).agg(F.count(F.lit(1)).alias(start))
    offsets = sizes.select(
        pid,
        (F.sum(start).over(w) - F.col(start)).alias(start),
        F.sum(start).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias(total),
    )
    # the offsets have one row a partition: a few MB at a hundred thousand partitions
    return (
        kept.join(F.broadcast(offsets), pid)
        .withColumn(rank, F.col(start) + F.col(idx))
        .drop(pid, idx, start)
    )
