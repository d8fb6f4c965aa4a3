"""Paragraph windows and chunks. Rows are (book, index, text) unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillcast.functions.text import has_dialogue


def dialogue_context(df: DataFrame, book: str, index: str, text: str, context: int = 1) -> DataFrame:
    """Add ``has_dialogue`` and ``near_dialogue``: any paragraph within ``context`` of this one has dialogue."""
    w = Window.partitionBy(book).orderBy(index).rowsBetween(-context, context)
    marked = df.withColumn("has_dialogue", F.coalesce(has_dialogue(F.col(text)), F.lit(False)))
    return marked.withColumn("near_dialogue", F.max("has_dialogue").over(w))


def context_text(df: DataFrame, book: str, index: str, text: str) -> DataFrame:
    """Add ``context``: the previous and the next paragraph with one space between, empty at the edges."""
    w = Window.partitionBy(book).orderBy(index)
    return df.withColumn("context", F.concat(F.lag(text, 1, "").over(w), F.lit(" "), F.lead(text, 1, "").over(w)))


def neighbour_flags(df: DataFrame, book: str, index: str, flags: list[str]) -> DataFrame:
    """Add prev_<f> and next_<f>, 0 at the edges."""
    w = Window.partitionBy(book).orderBy(index)
    return df.withColumns({f"{n}_{f}": fn(f, 1, 0.0).over(w) for f in flags for n, fn in (("prev", F.lag), ("next", F.lead))})


def pack_paragraphs(paragraphs: Column, max_chars: int) -> Column:
    """Greedy chunks of an array of paragraphs: a new one starts where the next paragraph would pass the limit."""
    zero = F.struct(F.array().cast("array<string>").alias("done"), F.array().cast("array<string>").alias("now"), F.lit(0).alias("n"))

    def step(acc: Column, p: Column) -> Column:
        full = (F.size(acc["now"]) > 0) & (acc["n"] + F.length(p) > max_chars)
        return F.struct(
            F.when(full, F.concat(acc["done"], F.array(F.array_join(acc["now"], "\n\n")))).otherwise(acc["done"]).alias("done"),
            F.when(full, F.array(p)).otherwise(F.concat(acc["now"], F.array(p))).alias("now"),
            (F.when(full, 0).otherwise(acc["n"]) + F.length(p)).cast("int").alias("n"),
        )

    def finish(acc: Column) -> Column:
        return F.when(F.size(acc["now"]) > 0, F.concat(acc["done"], F.array(F.array_join(acc["now"], "\n\n")))).otherwise(acc["done"])

    return F.aggregate(paragraphs, zero, step, finish)


def chunk_books(df: DataFrame, book: str, index: str, text: str, max_chars: int = 6000) -> DataFrame:
    """(book, chunk_id, chunk_text): a book is one unit of work, as its chunks depend on each other in order."""
    paragraphs = F.transform(F.array_sort(F.collect_list(F.struct(index, F.col(text).alias("_t")))), lambda x: x["_t"])
    chunks = df.filter(F.col(text).isNotNull()).groupBy(book).agg(pack_paragraphs(paragraphs, max_chars).alias("chunks"))
    return chunks.select(book, F.posexplode("chunks").alias("chunk_id", "chunk_text"))


def filter_funnel(df: DataFrame, steps: dict[str, Column]) -> DataFrame:
    """(step, n, dropped_pct) for nested conditions, from one pass."""
    row = df.agg(F.count(F.lit(1)).alias("all"), *[F.count_if(c).alias(k) for k, c in steps.items()])
    names = ["all", *steps]
    cells = [F.struct(F.lit(k).alias("step"), F.col(k).alias("n"), (100.0 * (F.col("all") - F.col(k)) / F.greatest("all", F.lit(1))).alias("dropped_pct")) for k in names]
    return row.select(F.explode(F.array(*cells)).alias("x")).select("x.*")


def containment_labels(paragraphs: DataFrame, speeches: DataFrame, book: str, text: str, speech: str) -> DataFrame:
    """Add ``label``: does any speech of the same book occur in the paragraph?

    Speeches of a book are gathered into one array (they are the book's own quotes) and searched in place, so no
    paragraph-by-speech pairs are made.
    """
    lists = speeches.filter(F.col(speech) != "").groupBy(book).agg(F.collect_set(speech).alias("_s"))
    found = F.exists("_s", lambda s: F.contains(F.col(text), s))
    return paragraphs.join(lists, book, "left").withColumn("label", F.coalesce(found, F.lit(False)).cast("int")).drop("_s")


def sample_positions(df: DataFrame, book: str, chunk: str) -> DataFrame:
    """First, middle and last of each book's distinct chunks in order (all, if there are three at most)."""
    ids = df.filter(F.col(chunk).isNotNull()).groupBy(book).agg(F.array_sort(F.collect_set(chunk)).alias("ids"))
    n = F.size("ids")
    some = F.array(F.get("ids", F.lit(0)), F.get("ids", F.floor(n / 2).cast("int")), F.get("ids", n - 1))
    return ids.select(book, F.explode(F.when(n <= 3, F.col("ids")).otherwise(some)).alias(chunk))
