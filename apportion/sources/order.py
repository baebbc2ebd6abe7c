"""Order of rows: numbers over a whole frame, and the order that lines have in their files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from apportion.functions.settle import settle


def lines(spark: SparkSession, path: str | list[str], options: dict | None = None) -> DataFrame:
    """(value, path, file, at) of each line of text files: `at` orders the lines of a file, however many tasks read it.

    It is where the split begins that holds the line, and the line's place among those of its task. Numbers of places differ
    from one way of splitting to another; their order doesn't, so what is chosen by order is the same in each reading.
    """
    raw = spark.read.options(**(options or {})).text(path)
    own = raw.select("value", "_metadata.file_path", "_metadata.file_name", F.col("_metadata.file_block_start").alias("start"))
    # The number is given right above the scan, before anything drops a line.
    placed = own.withColumn("place", F.monotonically_increasing_id())
    return placed.select("value", F.col("file_path").alias("path"), F.url_decode(F.replace("file_name", F.lit("+"), F.lit("%2B"))).alias("file"), F.struct("start", "place").alias("at"))


def fields(line: Column) -> Column:
    """Cells of a line of comma-separated values; quotes around a cell go, and doubled ones in it count once."""
    cells = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(r',("(?:[^"]|"")*"|[^,]*)'), F.lit(1))
    return F.transform(cells, lambda c: F.when(c.startswith('"') & (F.length(c) > 1), F.replace(c.substr(F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c))


def row_numbers(df: DataFrame, *order: str) -> DataFrame:
    """Adds id, from 1 in this order: a row's position in its range of rows, after the sizes of the ranges before.

    Rows that the order leaves equal go by their place in df, so they don't all fall into one range.
    """
    placed = df.withColumn("__place", F.monotonically_increasing_id())
    rows = settle(placed.repartitionByRange(*order, "__place").sortWithinPartitions(*order, "__place").withColumn("__at", F.monotonically_increasing_id()).drop("__place"))
    # The id's upper bits are the range's number, its lower 33 bits the position in it.
    ranges = rows.groupBy(F.shiftright("__at", 33).alias("__range")).agg(F.count("*").alias("n"))
    before = ranges.select("__range", F.coalesce(F.sum("n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    joined = rows.withColumn("__range", F.shiftright("__at", 33)).join(before, "__range")
    numbered = joined.withColumn("id", (F.col("__before") + F.col("__at").bitwiseAND((1 << 33) - 1) + 1).cast("int"))
    return numbered.select(*dict.fromkeys([*df.columns, "id"]))
