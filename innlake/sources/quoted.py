"""CSV files with quoted line breaks, read in as many tasks as they have byte ranges.

A line break ends a record if an even number of quotes stands before it in its file; a doubled quote counts twice and changes
nothing. So the lines of every byte range are read apart with the parity of their quotes, the parities of whole ranges are
added up in order of the ranges (one row per range), and both together tell which lines begin a record. Lines
that do not are put behind the one that does, also across ranges, and each record is parsed by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

FILE, RANGE, PLACE = "_file", "_range", "_place"


def lines_of(text: DataFrame) -> DataFrame:
    """Lines as the text source reads them (lineSep ``\\n``), with file, file time, byte range and place; to be selected right on the source."""
    return text.select(
        "value",
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("_file_time"),
        F.col("_metadata.file_block_start").alias(RANGE),
    )


def _quotes(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))


def records(lines: DataFrame) -> DataFrame:
    """(_file, _file_time, record, first): the records of every file, ``first`` for a file's first one.

    Rows of one range must come in their order, as the source gives them; they are numbered before anything else. A range
    is the most that one task orders, and a record the most that is put together.
    """
    numbered = lines.withColumn(PLACE, F.monotonically_increasing_id()).withColumn("_odd", F.pmod(_quotes(F.col("value")), F.lit(2)))
    inside = Window.partitionBy(FILE, RANGE).orderBy(PLACE)
    before = F.coalesce(F.sum("_odd").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = numbered.withColumn("_inside", before)
    # one row per range: the parity in front of it
    of_range = Window.partitionBy(FILE).orderBy(RANGE)
    ranges = lines.groupBy(FILE, RANGE).agg(F.sum(F.pmod(_quotes(F.col("value")), F.lit(2))).alias("_all"))
    ranges = ranges.withColumns({
        "_carried": F.sum("_all").over(of_range) - F.col("_all"), "_nth": F.row_number().over(of_range)}).drop("_all")
    known = numbered.join(ranges, [FILE, RANGE])
    starts = F.pmod(F.col("_inside") + F.col("_carried"), F.lit(2)) == 0
    known = known.withColumn("_starts", starts)
    own = F.last(F.when(F.col("_starts"), F.col(PLACE)), ignorenulls=True).over(inside)
    known = known.withColumn("_own", own)
    # lines in front of a range's first record belong to the last record of an earlier range
    last = known.groupBy(FILE, "_nth").agg(F.max(F.when(F.col("_starts"), F.struct(RANGE, PLACE))).alias("_last"))
    earlier = F.last("_last", ignorenulls=True).over(Window.partitionBy(FILE).orderBy("_nth").rowsBetween(Window.unboundedPreceding, -1))
    last = last.select(FILE, "_nth", earlier.alias("_earlier"))
    owned = known.join(last, [FILE, "_nth"]).withColumn(
        "_record", F.when(F.col("_own").isNotNull(), F.struct(F.col(RANGE), F.col("_own").alias(PLACE))).otherwise(F.col("_earlier")))
    put = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(RANGE, PLACE, "value"))), lambda x: x["value"]), "\n")
    built = owned.groupBy(FILE, "_file_time", "_record").agg(put.alias("record"), F.min(F.when(F.col("_starts"), F.col("_nth"))).alias("_nth"))
    heads = known.filter("_nth = 1").groupBy(FILE).agg(F.min(F.struct(RANGE, PLACE)).alias("_head"))
    return built.join(heads, FILE).select(
        FILE, "_file_time", F.regexp_replace("record", "\r$", "").alias("record"), (F.col("_record") == F.col("_head")).alias("first"))


def parsed(found: DataFrame, schema: T.StructType, options: dict[str, str]) -> DataFrame:
    """The records' fields with file and file time, without headers and empty lines."""
    rows = found.filter(~F.col("first") & (F.col("record") != ""))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    fields = rows.withColumn("_row", F.from_csv("record", F.lit(ddl), {**options, "header": "false"}))
    return fields.select("_row.*", FILE, "_file_time")
