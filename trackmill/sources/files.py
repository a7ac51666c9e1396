"""Text, delimited, JSON and trajectory files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from trackmill.functions.texts import NULL_MARK, decoded, split_on
from trackmill.functions.times import timestamp_from
from trackmill.schemas import CENSUS, EMPLOYEE_CSV, EMPLOYEE_JSON, IRIS, SALES, SALES_TEXT
from trackmill.sinks.writers import CSV_OPTIONS, PLT_NAME_LINE

#: Read as null by the CSV reader. No written field is equal to it: null has its own mark.
NOTHING = "\\-"


def read_lines(spark: SparkSession, path) -> DataFrame:
    """Lines of text files as one column ``value``."""
    return spark.read.text(path)


def read_delimited(spark: SparkSession, path, schema: StructType, sep: str = ",", **options) -> DataFrame:
    """Delimited lines without quoting: a field ends at the separator and nowhere else."""
    reader = spark.read.schema(schema).option("sep", sep).option("quote", "")
    return reader.options(**options).csv(path)


def read_sales(spark: SparkSession, path) -> DataFrame:
    return read_delimited(spark, path, SALES, sep="\t")


def read_sales_text(spark: SparkSession, path) -> DataFrame:
    return read_delimited(spark, path, SALES_TEXT, sep="\t")


def read_employees_csv(spark: SparkSession, path) -> DataFrame:
    return read_delimited(spark, path, EMPLOYEE_CSV)


def read_employees_json(spark: SparkSession, path) -> DataFrame:
    return spark.read.schema(EMPLOYEE_JSON).json(path)


def read_census(spark: SparkSession, path, **options) -> DataFrame:
    """Census rows, all text. ``comment="|"`` skips the leading remark of the test file."""
    return read_delimited(spark, path, CENSUS, sep=", ", **options)


def read_iris(spark: SparkSession, path) -> DataFrame:
    return read_delimited(spark, path, IRIS)


def frame_of(spark: SparkSession, rows: Iterable, schema: StructType | str) -> DataFrame:
    """A frame of a few rows held by the program, with types given and not guessed."""
    return spark.createDataFrame(list(rows), schema)


def typed(text: DataFrame, schema: StructType) -> DataFrame:
    """Columns of coded text as the values of a schema."""
    value = [F.when(F.col(f.name) != NULL_MARK, decoded(F.col(f.name))).cast(f.dataType).alias(f.name) for f in schema]
    return text.select(*value)


def _all_text(schema: StructType) -> StructType:
    return StructType([StructField(f.name, StringType()) for f in schema])


def read_written_csv(spark: SparkSession, path, schema: StructType) -> DataFrame:
    """What ``write_csv``, ``write_intervals`` or ``write_by_interval`` wrote, value by value.

    Partition columns of the path come as text like all others.
    """
    reader = spark.read.schema(_all_text(schema)).options(**CSV_OPTIONS).option("nullValue", NOTHING)
    return typed(reader.csv(path), schema)


def read_written_tsv(spark: SparkSession, path, schema: StructType) -> DataFrame:
    """What ``write_tsv`` wrote, value by value."""
    fields = split_on(F.col("value"), "\t")
    lines = spark.read.text(path)
    return typed(lines.select(*[fields[i].alias(f.name) for i, f in enumerate(schema)]), schema)


def _plt_points(lines: DataFrame) -> DataFrame:
    """The points among lines with ``traj_id``, ``name`` and ``seq``; header lines are told by their shape."""
    points = lines.withColumn("f", split_on(F.col("value"), ",")).filter(F.size("f") == 7).select(
        "traj_id",
        "name",
        "seq",
        timestamp_from(F.col("f")[5], F.trim(F.col("f")[6])).alias("ts"),
        F.col("f")[0].try_cast("double").alias("lat"),
        F.col("f")[1].try_cast("double").alias("lon"),
        F.col("f")[3].try_cast("double").alias("altitude"),
        F.col("f")[4].try_cast("double").alias("day_serial"),
    )
    return points.dropna(subset=["ts", "lat", "lon"])


def read_plt(spark: SparkSession, path) -> DataFrame:
    """Points of PLT files, one trajectory per file.

    ``traj_id`` is the whole path of the file, so files of equal name and folder stay
    apart; ``name`` is the file name without its extension, for reports. Header lines are
    told by their shape, so files may be split and many may be read at once. ``seq`` breaks
    ties between equal timestamps.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("traj_id"),
        F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.[^.]*)?$", 1).alias("name"),
        F.monotonically_increasing_id().alias("seq"),
        "value",
    )
    return _plt_points(lines)


def read_plt_tracks(spark: SparkSession, path) -> DataFrame:
    """Points of PLT files that hold many tracks each, as ``write_plt_tracks`` wrote them.

    ``traj_id`` and ``name`` are the name in the nearest header above the point. Lines are
    grouped by the block they were read in, whatever the size of the files and tracks; what a
    block begins with is the last name of the blocks before it. ``seq`` counts up through a file.
    """
    name = F.regexp_extract("value", PLT_NAME_LINE, 1)
    # In a struct, where null is an ordinary value; lines that name nothing have none.
    header = F.struct(F.when(name != NULL_MARK, decoded(name)).alias("name"))
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("no"),
        F.when(F.col("value").rlike(PLT_NAME_LINE), header).alias("header"),
        "value",
    )
    headed = F.when(F.col("header").isNotNull(), F.col("no"))
    blocks = lines.groupBy("file", "block").agg(F.max_by("header", headed).alias("header"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begins = blocks.select("file", "block", F.last("header", ignorenulls=True).over(earlier).alias("begins"))
    of_block = Window.partitionBy("file", "block").orderBy("no")
    # A line has a byte at least, so the place in its block never reaches the next block's start.
    placed = lines.withColumns({"header": F.last("header", ignorenulls=True).over(of_block), "seq": F.col("block") + F.row_number().over(of_block)})
    # One row per block: as many as the scan has splits, which the driver holds anyway.
    placed = placed.join(F.broadcast(begins), ["file", "block"], "left")
    track = F.coalesce("header", "begins")["name"]
    return _plt_points(placed.select(track.alias("traj_id"), track.alias("name"), "seq", "value"))


def number_lines(spark: SparkSession, path) -> DataFrame:
    """Lines with their file and 1-based ``line_no``, whatever blocks the files are read in.

    A task reads a block from start to end and numbers its rows in order, so a row's number
    less the block's smallest is its place in the block. To that the lengths of the earlier
    blocks are added. The files are read twice, the first time only to count.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("no"),
        "value",
    )
    blocks = lines.groupBy("file", "block").agg(F.min("no").alias("first"), F.count("*").alias("length"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("length").over(earlier), F.lit(0))
    starts = blocks.select("file", "block", (before - F.col("first") + 1).alias("shift"))
    # One row per block: as many as the scan has splits, which the driver holds anyway.
    number = F.col("no") + F.coalesce("shift", F.raise_error(F.lit("blocks of a file have changed")))
    numbered = lines.join(F.broadcast(starts), ["file", "block"], "left")
    return numbered.select("file", number.alias("line_no"), "value")


def skip_lines(spark: SparkSession, path, n: int) -> DataFrame:
    """Lines of every file but its first ``n``, wherever its blocks end."""
    return number_lines(spark, path).filter(F.col("line_no") > n).select("value")


def source_aggregates(spark: SparkSession, path: str, columns: Iterable[str]) -> DataFrame:
    """Row count, and count, least and greatest of columns, computed by the Parquet reader from the files' footers.

    No column is read: the plan's scan shows the aggregates as pushed. For whole numbers, floats,
    booleans and dates, whose footers are exact. The reader that can do this is chosen in a
    session of its own, so the caller's settings stay; the result is of that session.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    found = [F.count("*").alias("n_rows")]
    for c in columns:
        found += [F.count(c).alias(f"n_{c}"), F.min(c).alias(f"least_{c}"), F.max(c).alias(f"most_{c}")]
    made = session.read.parquet(path).agg(*found)
    # Files without rows have no footer counts to add up, though Spark takes a count to be never null.
    return made.select(*[F.coalesce(F.nullif(c, F.lit(-1)), F.lit(0)).alias(c) if c.startswith("n_") else c for c in made.columns])


def parse_variant(df: DataFrame, column: str, name: str = "data") -> DataFrame:
    """Add JSON texts of any shape as VARIANT values; malformed ones are null."""
    return df.withColumn(name, F.try_parse_json(column))


def variant_schema(df: DataFrame, name: str = "data") -> str:
    """The schema that fits the values of all rows, as Spark writes it; one text, merged before the shuffle."""
    return df.agg(F.schema_of_variant_agg(name)).first()[0]


def variant_columns(df: DataFrame, fields: dict[str, str], name: str = "data") -> DataFrame:
    """Fields of a VARIANT as columns of the given types; null where the field is missing or of no such type."""
    found = {c: F.try_variant_get(name, f"$.{c}", kind) for c, kind in fields.items()}
    return df.withColumns(found).drop(name)
