"""CSV readers: columns bound by header name (case-insensitive), seeds as
text, and extraction of new rows since a mark."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wharf.operators.incremental import extract_since  # noqa: F401  (re-exported: S8)


def read_csv(spark: SparkSession, path: str, types: Mapping[str, str], sep: str = ",") -> DataFrame:
    """Read a CSV with a header, all columns as text, then pick the wanted
    columns by name ignoring case and order, and cast them.

    A ``schema=`` would bind columns by position, not by header name, so the
    file is read untyped and typed by name afterwards.
    """
    raw = spark.read.option("header", True).option("sep", sep).csv(path)
    by_lower = {c.lower(): c for c in raw.columns}
    missing = [c for c in types if c.lower() not in by_lower]
    if missing:
        raise ValueError(f"columns not in header of {path}: {missing}")
    return raw.select(*[F.col(f"`{by_lower[c.lower()]}`").cast(t).alias(c)
                        for c, t in types.items()])


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """Seed CSV, every column as text; JSON inside double quotes kept whole."""
    return (spark.read.option("header", True).option("quote", '"').option("escape", '"')
            .option("multiLine", False).csv(path))
