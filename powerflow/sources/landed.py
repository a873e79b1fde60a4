"""Landed feed files: JSON documents, CSV forecasts and user SQL over a feed."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from powerflow.functions.times import parse_date_time
from powerflow.operators.grouping import fact_join
from powerflow.schemas import EMPTY_FEED, GB_FORECAST_RECORD, RESOURCE_RECORD
from powerflow.session import written

LANDED = "landed"  # when a response was landed, which tells polls apart


def read_documents(
    spark: SparkSession,
    path: str,
    whole: bool = False,
    since: date | None = None,
    modified_after: datetime | None = None,
) -> DataFrame:
    """One row per landed response: its text as ``document``, when it ``landed``, and the partitions.

    Every line is one response, so files may have any size and are split. With ``whole`` a file is one
    response. Blank lines are none. ``since`` prunes folders by their ``request_date``, where there is
    one. ``modified_after`` is for landing folders whose files keep their time of landing: older ones
    are not opened.
    """
    reader = spark.read
    if modified_after is not None:
        stamp = modified_after.strftime("%Y-%m-%dT%H:%M:%S")
        reader = reader.option("modifiedAfter", stamp).option("timeZone", "UTC")
    rows = reader.text(path, wholetext=whole)
    others = [F.col(name) for name in rows.columns if name != "value"]
    landed = F.col("_metadata.file_modification_time").alias(LANDED)
    rows = rows.select(F.col("value").alias("document"), landed, *others)
    if since is not None and "request_date" in rows.columns:
        rows = rows.filter(F.col("request_date").cast("date") >= F.lit(since))
    return rows.filter(F.trim("document") != "")


def _envelope(path: str, record: str) -> tuple[T.DataType, list[str], list[str]]:
    """Schema of the document, the steps down to the array and the steps inside an element."""
    outer, _, inner = path.partition("[]")
    outer_steps = outer.split(".")
    inner_steps = [step for step in inner.split(".") if step]
    schema: T.DataType = T.StructType.fromDDL(record)
    for step in reversed(inner_steps):
        schema = T.StructType([T.StructField(step, schema)])
    schema = T.ArrayType(schema)
    for step in reversed(outer_steps):
        schema = T.StructType([T.StructField(step, schema)])
    return schema, outer_steps, inner_steps


def _descend(col: Column, steps: Sequence[str]) -> Column:
    for step in steps:
        col = col.getField(step)
    return col


def records_array(col: Column, path: str, record: str, strict: bool = False) -> Column:
    """Array of records inside JSON text.

    ``path`` names the way to the array and, after ``[]``, the way inside an element, e.g.
    ``hydra:member[]``, ``result.records[]`` or ``data[].0``. Text that is not JSON is an error
    when ``strict``, otherwise it has no records.
    """
    schema, outer, inner = _envelope(path, record)
    mode = "FAILFAST" if strict else "PERMISSIVE"
    array = _descend(F.from_json(col, schema, {"mode": mode}), outer)
    return F.transform(array, lambda item: _descend(item, inner)) if inner else array


def flatten_records(
    df: DataFrame,
    path: str,
    record: str,
    text: str = "document",
    keep: Sequence[str] = (),
    strict: bool = False,
) -> DataFrame:
    """One row per record, with its position in the document as ``pos``.

    A missing or empty array gives no rows; the schema is the same either way.
    """
    array = records_array(F.col(text), path, record, strict)
    exploded = df.select(*keep, F.posexplode(array).alias("pos", "_record"))
    return exploded.select(*keep, "pos", "_record.*")


def read_csv_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per data line of landed CSV files: ``header`` and ``cells`` as arrays, and ``landed``.

    Each file is one response with a header of its own, its first line that is not blank, so files may
    differ in columns and order. A file is split over tasks like any text: the headers, one small row a
    file, are found first and written, so their size decides on the join, and every line finds its own by
    the file's path. A line that repeats its file's header is no data. A cell holds no line break.
    """
    lines = spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_modification_time").alias(LANDED),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
    ).filter(F.trim("line") != "")
    # lines of a block are read in order by one task, whose row numbers ascend
    placed = lines.select("file", "line", F.struct("block", F.monotonically_increasing_id()).alias("place"))
    firsts = placed.groupBy("file").agg(F.min_by("line", "place").alias("first"))
    header = F.transform(_cells(F.regexp_replace("first", "^\ufeff", "")), F.trim)
    headers = written(firsts.select("file", "first", header.alias("header")), "csv-headers")
    # no cells for a header, so that a condition on cells may run before the filter
    data = F.when(F.col("line") != F.col("first"), F.col("line"))
    rows = fact_join(lines, headers, "file", "inner").withColumn("line", data).filter("line IS NOT NULL")
    return rows.select("header", _cells(F.col("line")).alias("cells"), LANDED)


def _cells(line: Column) -> Column:
    """Cells of a CSV line. A comma within quotes does not part cells; empty cells are NULL."""
    parts = F.split(line, ',(?=(?:[^"]*"[^"]*")*[^"]*$)')

    def plain(cell: Column) -> Column:
        text = F.trim(cell)
        quoted = F.startswith(text, F.lit('"')) & F.endswith(text, F.lit('"')) & (F.length(text) > 1)
        inner = F.replace(F.substring(text, F.lit(2), F.length(text) - 2), F.lit('""'), F.lit('"'))
        return F.nullif(F.when(quoted, inner).otherwise(cell), F.lit(""))

    return F.transform(parts, plain)


def named_cell(name: str) -> Column:
    """The cell below a column's name; a header without it is an error."""
    place = F.array_position("header", name)
    missing = F.raise_error(F.concat(F.lit(f"no column {name} in "), F.array_join("header", ",")))
    return F.when(place == 0, missing.cast("string")).otherwise(F.get("cells", (place - 1).cast("int")))


def read_feed_csv(
    spark: SparkSession, path: str, schema: str = GB_FORECAST_RECORD
) -> DataFrame:
    """CSV with a header in each file; columns are matched by name, so their order is free."""
    wanted = T.StructType.fromDDL(schema)
    rows = read_csv_documents(spark, path)
    return rows.select(*[named_cell(f.name).cast(f.dataType).alias(f.name) for f in wanted])


def latest_resource(df: DataFrame, text: str = "document") -> DataFrame:
    """Path of the first resource of a package description, which is its newest forecast."""
    resources = records_array(F.col(text), "result.resources[]", RESOURCE_RECORD)
    return df.withColumn("path", F.get(resources, F.lit(0)).getField("path")).drop(text)


def newest_path(df: DataFrame, keys: Sequence[str], path: str, modified: Sequence[str]) -> DataFrame:
    """Most recently modified path per key of a landing folder listing."""
    newest = F.max_by(F.col(path), F.struct(*modified)).alias(path)
    return df.groupBy(*keys).agg(newest)


def sql_feed(
    spark: SparkSession, feed: DataFrame, sql: str, view: str = "feed", scale: float = 1.0
) -> DataFrame:
    """User SQL over a forecast feed that it names as ``view``, then the usual date and time parse.

    SQL that cannot be analysed gives an empty feed; rows with a bad timestamp are dropped and a value
    that is no number is NULL. The value is passed on unscaled unless ``scale`` says otherwise. A view
    of the session with the same name is there again afterwards.
    """
    before = spark.table(view) if spark.catalog.tableExists(view) else None
    feed.createOrReplaceTempView(view)
    try:
        rows = spark.sql(sql)
        parsed = rows.select(
            parse_date_time(F.col("DATE_GMT"), F.col("TIME_GMT")).alias("target_datetime_utc"),
            (F.col("EMBEDDED_SOLAR_FORECAST").try_cast("double") * F.lit(scale)).alias("solar_generation_kw"),
        )
    except (AnalysisException, ParseException):
        return spark.createDataFrame([], EMPTY_FEED)
    finally:
        spark.catalog.dropTempView(view)
        if before is not None:
            before.createOrReplaceTempView(view)
    return parsed.filter(F.col("target_datetime_utc").isNotNull())
