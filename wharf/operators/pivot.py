"""Dynamic pivot of daily totals into one column per day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wharf.functions.columns import lit_date


def pivot_days(daily: DataFrame, name: str, day: str, value: str, begin, end,
               fill=0, days: DataFrame | None = None) -> DataFrame:
    """One row per ``name``, one column per day in [begin, end] present in
    the data, named YYYY-MM-DD, missing cells = ``fill``.

    The caller's range bounds the columns. The days present are read from
    ``days`` (a frame with the column ``day``, e.g. the fact alone; else from
    ``daily``), sorted, and passed to ``pivot`` explicitly so Spark needs no
    extra discovery job.
    """
    b = begin if isinstance(begin, dt.date) else dt.date.fromisoformat(str(begin))
    e = end if isinstance(end, dt.date) else dt.date.fromisoformat(str(end))
    wanted = F.col(day).between(lit_date(b), lit_date(e))
    present = (daily if days is None else days).where(wanted).select(day).distinct()
    days = sorted(r[0] for r in present.collect())
    in_range = daily.where(wanted)
    labels = [d.isoformat() for d in days]
    out = (in_range.withColumn("_dat", F.date_format(F.col(day), "yyyy-MM-dd"))
           .groupBy(name).pivot("_dat", labels).agg(F.sum(value)))
    return out.fillna(fill, subset=labels) if labels else out
