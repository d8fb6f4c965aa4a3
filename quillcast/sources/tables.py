"""Tables in and out. Schemas are declared; CSV is for the edges, Parquet between stages."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillcast.operators.sampling import ensure_columns

ASR_SEGMENTS = "start double, end double, words array<struct<word:string,start:double,end:double,score:double>>"
SPEECH_FRAGMENTS = "book_id string, path_book string, book_name string, book_author string, chunk_id bigint, chunk_text string, speech string, description string, character string"
_OWN: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder (spark.checkpoint.dir)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        if not _OWN:
            _OWN.append(tempfile.mkdtemp(prefix="quillcast-"))
            atexit.register(shutil.rmtree, _OWN[0], ignore_errors=True)
        root = "file://" + _OWN[0]
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back; cuts the lineage for good."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def read_csv(spark: SparkSession, path: str | list[str], schema: str | None = None, columns: list[str] | None = None) -> DataFrame:
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    df = reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)
    return df.select(*columns) if columns else df


def read_csv_present(spark: SparkSession, paths: list[str], schema: str | None = None) -> DataFrame | None:
    """The files that exist, as one table."""
    out = None
    for p in paths:
        if exists(spark, p):
            df = read_csv(spark, p, schema)
            out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def read_jsonl(spark: SparkSession, path: str, schema: str = SPEECH_FRAGMENTS, limit: int | None = None) -> DataFrame:
    """A folder of JSON lines in order of file name, with ``file`` and ``pos`` (the line's place in its file).

    Files are split by Spark only where a line ends; pos comes from the order inside each file's splits.
    """
    df = spark.read.schema(schema).json(path)
    df = df.withColumn("file", F.col("_metadata.file_name")).withColumn("pos", F.col("_metadata.file_block_start") * (1 << 20) + F.pmod(F.monotonically_increasing_id(), F.lit(1 << 33)))
    return df.orderBy("file", "pos").limit(limit) if limit is not None else df


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """One row a segment: path_audio, seg (its place in the file), start, end, words.

    A transcript is ``<path_audio>/raw/<title>.json``, where title is the last part of path_audio; other files are left out. A file is one
    array, read by one task in its own order.
    """
    from pyspark.sql import Window

    raw = spark.read.schema(ASR_SEGMENTS).option("multiLine", True).json(path)
    # the reader encodes its paths; plus signs stand for themselves
    whole = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    rows = raw.withColumns({"_file": F.regexp_replace(whole, "^file:/+", "/"), "_at": F.monotonically_increasing_id()})
    shape = r"^(.*/([^/]+))/raw/\2\.json$"
    rows = rows.withColumn("path_audio", F.regexp_extract("_file", shape, 1)).filter("path_audio <> ''")
    seg = F.row_number().over(Window.partitionBy("path_audio").orderBy("_at")) - 1
    return rows.select("path_audio", seg.alias("seg"), "start", "end", "words")


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def jsonl_to_csv(spark: SparkSession, source: str, target: str, schema: str) -> None:
    write_csv(spark.read.schema(schema).json(source), target)


def write_books(df: DataFrame, path: str, book: str = "book_id", order: str = "chunk_id") -> None:
    """JSON lines by book, replaced book by book; rows of a file are in order."""
    out = df.repartition(book).sortWithinPartitions(book, order)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(book).json(path)


def rewrite(spark: SparkSession, path: str, change) -> None:
    """Read a Parquet table, change it and put the result in its place; the old one stays until the new one is whole."""
    new = f"{path}.new-{uuid.uuid4().hex}"
    change(spark.read.parquet(path)).write.parquet(new)
    fs, p = _fs(spark, path)
    _, n = _fs(spark, new)
    _, old = _fs(spark, f"{path}.old-{uuid.uuid4().hex}")
    fs.rename(p, old)
    fs.rename(n, p)
    fs.delete(old, True)


def checksums(spark: SparkSession, path: str, algorithm: str = "sha256") -> DataFrame:
    """(path, length, checksum) of files, hashed where they are read."""
    files = spark.read.format("binaryFile").load(path)
    digest = F.sha2("content", 256) if algorithm == "sha256" else F.md5("content")
    return files.select("path", "length", digest.alias("checksum"))


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) without reading contents."""
    return spark.read.format("binaryFile").load(path).select("path", "length")


def to_jsonl(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))


def report(title: str, counts: DataFrame, most: int = 200) -> str:
    """A small table as Markdown text; only ``most`` rows come to the driver, and the text says so where there are more."""
    rows = counts.limit(most + 1).collect()
    head = "| " + " | ".join(counts.columns) + " |\n|" + "-|" * len(counts.columns)
    rest = f"\nThe first {most} rows; there are more.\n" if len(rows) > most else ""
    return f"# {title}\n\n{head}\n" + "\n".join("| " + " | ".join(str(v) for v in r) + " |" for r in rows[:most]) + "\n" + rest


def reindex(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    return ensure_columns(df, schema)
