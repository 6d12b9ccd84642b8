"""Nested API documents → one row per hourly entry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wharf.functions.columns import day_window_start, lit_ts

# --- fixed values: fields of one hourly entry (numeric ones as double) -------
HOURLY_DOUBLE_FIELDS = ["apparentTemperature", "cloudCover", "dewPoint", "humidity", "ozone",
                        "precipAccumulation", "precipIntensity", "precipProbability",
                        "pressure", "temperature", "uvIndex", "visibility", "windBearing",
                        "windGust", "windSpeed"]
HOURLY_TEXT_FIELDS = ["icon", "precipType", "summary"]
# -------------------------------------------------------------------------------

HOURLY_ENTRY = T.StructType(
    [T.StructField(f, T.DoubleType()) for f in HOURLY_DOUBLE_FIELDS]
    + [T.StructField(f, T.StringType()) for f in HOURLY_TEXT_FIELDS]
    + [T.StructField("time", T.LongType())])
HOURLY_DOC = T.StructType([
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("hourly", T.StructType([
        T.StructField("summary", T.StringType()),
        T.StructField("data", T.ArrayType(HOURLY_ENTRY)),
    ])),
])


def parse_documents(df: DataFrame, text_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """JSON document text → struct column ``doc`` (explicit schema, no inference)."""
    return df.select(*(keep or []), F.from_json(F.col(text_col), HOURLY_DOC).alias("doc"))


def flatten_hourly(docs: DataFrame, doc_col: str = "doc", keep: list[str] | None = None) -> DataFrame:
    """One row per ``hourly.data`` entry, fields sorted by name, plus a
    readable ``timestamp`` (UTC wall clock) from the epoch ``time``.
    Documents with an empty or missing array give no rows."""
    fields = sorted(HOURLY_ENTRY.fieldNames())
    entries = docs.select(*(keep or []), F.inline(F.col(f"{doc_col}.hourly.data")))
    return entries.select(*(keep or []), *fields,
                          F.timestamp_seconds("time").cast("timestamp_ntz").alias("timestamp"))


def in_day_window(ts: Column, run_ts) -> Column:
    """``ts`` within the day before ``run_ts`` (a nightly load's window)."""
    start = day_window_start(lit_ts(run_ts))
    return (ts >= start) & (ts < start + F.expr("INTERVAL 1 DAY"))


# -- landing by day ------------------------------------------------------------------

_TIMES = T.StructType([T.StructField("hourly", T.StructType([T.StructField("data", T.ArrayType(
    T.StructType([T.StructField("time", T.LongType())])))]))])
DAY = "day"


def land_by_day(raw: DataFrame, path: str, text_col: str = "value") -> None:
    """Append raw documents to ``path``, partitioned by the days of their entries: a document that spans
    two days is in both, one without entries under no day (null). Only the times are parsed."""
    times = F.from_json(F.col(text_col), _TIMES)["hourly"]["data"]["time"]
    days = F.array_distinct(F.transform(times, lambda t: F.to_date(F.timestamp_seconds(t).cast("timestamp_ntz"))))
    raw.withColumn(DAY, F.explode_outer(days)).write.mode("append").partitionBy(DAY).parquet(path)


def read_day(spark: SparkSession, path: str, run_ts, schema: T.StructType) -> DataFrame:
    """Landed documents of the day before ``run_ts``: other days' folders are not read."""
    landed = T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])
    return spark.read.schema(landed).parquet(path).where(
        F.col(DAY) == F.date_sub(lit_ts(run_ts).cast("date"), 1)).drop(DAY)
