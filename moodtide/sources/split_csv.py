"""CSV whose quoted fields hold line breaks, read by many tasks a file.

Whether a line lies within quotes depends on the quotes before it. A first pass counts quotes per block
of a file; the parity of the counts before a block is the state it starts in. With it, every block finds
its own records; only records that reach over the end of a block are put together between blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_BLOCK = ["file", "start", "size"]


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines with their block; ``at`` ascends within a block, as a block is read by one task in order."""
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("size"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("line"),
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"),
    )


def _blocks(lines: DataFrame) -> DataFrame:
    """State in which each block starts, from one short row a block."""
    counted = lines.groupBy(*_BLOCK).agg(F.sum("quotes").alias("quotes"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    unclosed = F.sum("quotes").over(Window.partitionBy("file")) % 2 == 1
    error = F.raise_error(F.concat(F.lit("a quote is never closed in "), F.col("file"))).cast("boolean")
    inside = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1
    return counted.select(*_BLOCK, F.when(unclosed, error).otherwise(inside).alias("inside"))


def records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, head, record): the records of CSV files as text; ``head`` marks the first of a file.

    Quotes are expected at the ends of fields and doubled within them. Blank lines between records are
    no records. A file whose last quote is never closed is an error.
    """
    lines = _lines(spark, list(paths))
    known = lines.join(_blocks(lines), _BLOCK, "left")
    # both passes see the same blocks, or else the states are of no use
    error = F.raise_error(F.lit("the files or their blocks changed while they were read")).cast("boolean")
    inside = F.when(F.col("inside").isNull(), error).otherwise(F.col("inside")).cast("int")
    so_far = Window.partitionBy(*_BLOCK).orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    odd = F.col("quotes") % 2 == 1
    stated = known.select(
        "file", "start", "size", "at", "line", odd.alias("odd"),
        ((inside + F.sum("quotes").over(so_far) - F.col("quotes")) % 2 == 1).alias("within"),
        F.sum((F.trim(F.replace("line", F.lit("\r"), F.lit(""))) != "").cast("int")).over(so_far).alias("filled"),
    )
    stated = stated.withColumn(
        "piece", F.sum((~F.col("within") & F.col("odd")).cast("int")).over(so_far)
    ).withColumn("head", (F.col("start") == 0) & (F.col("filled") <= 1) & ~F.col("within"))

    blank = F.replace("line", F.lit("\r"), F.lit("")) == ""
    single = ~F.col("within") & ~F.col("odd") & ~blank
    # no text under another condition: a later filter, moved down here, may look at rows that this one drops
    whole = stated.filter(single).select("file", "head", F.when(single, F.col("line")).alias("record"))

    pieces = (
        stated.filter(F.col("within") | F.col("odd"))
        .groupBy(*_BLOCK, "piece")
        .agg(
            F.max("head").alias("head"),
            # a piece ends outside quotes if it opens and closes, or continues and closes
            ((F.sum(F.col("odd").cast("int")) + (F.col("piece") == 0).cast("int")) % 2 == 1).alias("open"),
            _joined("at", "line").alias("record"),
        )
    )
    closed = (F.col("piece") > 0) & ~F.col("open")
    # at most two pieces a block are left: its first lines and its last record
    order = Window.partitionBy("file").orderBy("start", "piece").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    over = (
        pieces.filter(~closed)
        .withColumn("number", F.sum((F.col("piece") > 0).cast("int")).over(order))
        .groupBy("file", "number")
        .agg(F.max("head").alias("head"), _joined(F.struct("start", "piece"), "record").alias("record"))
    )
    inner = pieces.filter(closed).select("file", "head", F.when(closed, F.col("record")).alias("record"))
    out = whole.unionByName(inner)
    return out.unionByName(over.select("file", "head", "record"))


def _joined(order, text: str) -> Column:
    order = F.col(order) if isinstance(order, str) else order
    parts = F.array_sort(F.collect_list(F.struct(order.alias("at"), F.col(text).alias("text"))))
    return F.array_join(F.transform(parts, lambda p: p["text"]), "\n")


def _bare_quote(record: Column) -> Column:
    """Whether a quote stands elsewhere than at the ends of a field (or doubled within one)."""
    parts = F.split(F.replace(record, F.lit('""'), F.lit("")), '"', -1)
    last = F.size(parts) - 1

    def wrong(part: Column, i: Column) -> Column:
        left = (i == 0) | F.startswith(part, F.lit(","))
        right = (i == last) | F.endswith(part, F.lit(","))
        return (i % 2 == 0) & ~((part == "") & ((i == 0) | (i == last))) & ~(left & right)

    return F.exists(F.transform(parts, wrong), lambda w: w)


def read(spark: SparkSession, paths: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Files with a header as string columns ``columns``, by position; quotes within quotes are doubled.

    A quote in a field that is not quoted is an error here; the reader that takes a file as a whole
    accepts it.
    """
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in columns)
    found = records(spark, paths).filter(~F.col("head"))
    record = F.regexp_replace("record", r"\r\z", "")
    error = F.raise_error(F.concat(F.lit("a quote stands within an unquoted field in "), F.col("file")))
    checked = found.select(F.when(_bare_quote(record), error.cast("string")).otherwise(record).alias("record"))
    row = F.from_csv("record", schema, {"quote": '"', "escape": '"', "multiLine": "true"})
    return checked.select(row.alias("row")).select("row.*")
