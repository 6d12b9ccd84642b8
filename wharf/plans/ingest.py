"""Source queries: raw event text repaired and typed, its problem report,
and nested hourly documents flattened. The raw inputs are produced by Spark
from ``events`` (one text line or one ≤24-entry document per group of
events), so the work grows with the table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wharf.functions.columns import is_text_false, is_text_true
from wharf.operators import aggregates as agg
from wharf.plans import payments as pay
from wharf.plans import standins as si
from wharf.plans.registry import query
from wharf.plans.reports import users_transactions
from wharf.session import merge_buckets, read_table, spread, table_path, work_dir
from wharf.sources import documents as docs
from wharf.sources import events as evsrc
from wharf.sources.catalog import CatalogTable, open_database
from wharf.sources.files import read_csv, read_seed
from wharf.sources.tables import path_bytes, replace_window_partitions
from wharf.streaming.ingest import ingest_event_files, merge_event_files, read_ingested, reconcile_loads

# --- fixed values of the raw-event stand-in ----------------------------------
EVENT_FIELDS = ["event_id", "event_timestamp", "platform", "user_id", "session_id",
                "real_currency_amount", "is_premium", "player_name", "note"]
EVENT_TYPES = {"event_id": "bigint", "event_timestamp": "timestamp_ntz", "is_premium": "boolean"}
EVENT_MONEY = {"real_currency_amount": "real_currency_amount_centum"}
ENTRIES_PER_DOC = 24
NOTES = ["Mr True", "ratio 3:, ok", "flag: True, yes", "see: NULL}", r'say \"hi\"']     # by k mod 6
# -------------------------------------------------------------------------------


def _q(c: F.Column) -> F.Column:
    """Single-quoted Python-style text literal."""
    return F.concat(F.lit("'"), c, F.lit("'"))


def _event_k() -> F.Column:
    return F.get_json_object("props", "$.k").try_cast("int")


def _written_day() -> F.Column:
    """The day in an event's raw line (see ``raw_event_lines``), empty where it has none to read."""
    day = F.regexp_extract(F.date_format("ts", "yyyy-MM-dd"), r"^\d{4}-\d{2}-\d{2}$", 0)
    return F.when(_event_k().isin(0, 98), F.lit("")).otherwise(F.coalesce(day, F.lit("")))


def raw_event_lines(spark, sf_dir, events: DataFrame | None = None) -> DataFrame:
    """One almost-JSON line per event, as a game client would log it:
    single quotes, True/False/NULL words, ``'user_id': ,`` for a missing
    user, comma decimals for odd k, an apostrophe in some names, texts that
    look like structure (True, NULL, a colon before a comma), escaped quotes,
    bytes that are no UTF-8, an unreadable time for k = 0, a line without a record for
    k = 98 and a broken one for k = 99."""
    # k is a column of its own, read once a row: a dozen copies of its JSON path make a method too long to be compiled
    e = spread(read_table(spark, sf_dir, "events") if events is None else events).withColumn("_k", _event_k())
    k = F.col("_k")
    uid = F.col("user_id")
    vtext = F.col("value").cast("string")
    amount = F.when(F.pmod(k, F.lit(2)) == 1, _q(F.replace(vtext, F.lit("."), F.lit(",")))).otherwise(vtext)
    name = F.when(F.pmod(uid, F.lit(10)) == 3, F.concat(F.lit("O'p"), uid.cast("string"))) \
        .otherwise(F.concat(F.lit("p"), uid.cast("string")))
    name_txt = F.when(k == 99, F.concat(F.lit("'"), name)).otherwise(_q(name))
    ts = F.when(k == 0, _q(F.lit("n/a"))).otherwise(_q(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    turn = F.pmod(k, F.lit(len(NOTES) + 1))
    bad = F.concat(F.lit("o"), F.unhex(F.lit("FFFE")).cast("string"), F.lit("k"))
    note = F.when(turn == len(NOTES), bad).otherwise(F.lit("ok"))
    for i, text in enumerate(NOTES):
        note = F.when(turn == i, F.lit(text)).otherwise(note)
    parts = [
        F.concat(F.lit("'event_id': "), F.col("event_id").cast("string")),
        F.concat(F.lit("'event_timestamp': "), ts),
        F.concat(F.lit("'platform': "), _q(F.upper("event_type"))),
        F.concat(F.lit("'user_id': "), F.when(uid == 0, F.lit("")).otherwise(_q(uid.cast("string")))),
        F.concat(F.lit("'session_id': "), F.when(k == 1, F.lit("NULL"))
                 .otherwise(_q(F.col("event_id").cast("string")))),
        F.concat(F.lit("'real_currency_amount': "), amount),
        F.concat(F.lit("'is_premium': "), F.when(F.col("value") > 250, F.lit("True"))
                 .otherwise(F.lit("False"))),
        F.concat(F.lit("'player_name': "), name_txt),
        F.concat(F.lit("'note': "), _q(note)),
    ]
    body = F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("},"))
    line = F.when(F.col("event_id") == 0, F.concat(F.lit("["), body)).otherwise(body)
    line = F.when(k == 98, F.concat(F.lit("-- lost line "), F.col("event_id").cast("string"))).otherwise(line)
    return e.select(line.alias("value"))


_EVENTS_BASE = """
WITH e AS (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
"""


_REPAIRED_SQL = _EVENTS_BASE + """
SELECT event_id,
       CASE WHEN k = 0 THEN NULL ELSE CAST(date_trunc('second', ts) AS TIMESTAMP) END AS event_timestamp,
       upper(event_type) AS platform,
       CASE WHEN user_id = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS user_id,
       CASE WHEN k = 1 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS session_id,
       CAST(round(value * 100) AS BIGINT) AS real_currency_amount_centum,
       value > 250 AS is_premium,
       CASE WHEN user_id % 10 = 3 THEN 'O''p' ELSE 'p' END || CAST(user_id AS VARCHAR) AS player_name,
       coalesce(['Mr True', 'ratio 3:, ok', 'flag: True, yes', 'see: NULL}', 'say "hi"'][k % 6 + 1], 'ok') AS note
FROM e WHERE k NOT IN (98, 99)
"""


@query("repaired_events", covers=("S1", "S2", "P2", "F11"), sql=_REPAIRED_SQL)
def q_repaired_events(spark, sf_dir):
    raw = evsrc.parse_events(raw_event_lines(spark, sf_dir), EVENT_FIELDS)
    return evsrc.type_events(raw, EVENT_TYPES, EVENT_MONEY)


@query("repaired_events_multiline", stateful=True, covers=("S1", "S2"), sql=_REPAIRED_SQL)
def q_repaired_events_multiline(spark, sf_dir):
    """The same records written over several lines each (a break after every field), read record by
    record: the file is split at the records' end, not at line ends, and stays splittable."""
    path = work_dir(spark, "multiline")
    lines = raw_event_lines(spark, sf_dir).where(F.col("value").contains("{"))     # lost lines have no record's end
    lines.select(F.regexp_replace("value", ", '", ",\n  '").alias("value")).write.text(path)
    return evsrc.read_events(spark, path, EVENT_FIELDS, EVENT_TYPES, EVENT_MONEY, record_sep="},\n")


@query("event_problems", covers=("S3",), sql=_EVENTS_BASE + """
SELECT CAST(event_id AS VARCHAR) AS event_id, 'unparseable record' AS problem, NULL AS value
FROM e WHERE k = 99
UNION ALL
SELECT NULL, 'unparseable record', NULL FROM e WHERE k = 98
UNION ALL
SELECT CAST(event_id AS VARCHAR), 'unreadable event_timestamp', 'n/a' FROM e WHERE k = 0
""")
def q_event_problems(spark, sf_dir):
    raw = evsrc.parse_events(raw_event_lines(spark, sf_dir), EVENT_FIELDS)
    return evsrc.problem_rows(raw, EVENT_TYPES, EVENT_MONEY, "event_id")


def hourly_documents(spark, sf_dir) -> DataFrame:
    """JSON documents of ≤24 hourly entries, one per block of event ids."""
    e = read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").try_cast("int")
    entry = F.struct(
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("time"),
        F.col("value").alias("temperature"),
        F.col("event_type").alias("summary"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("icon"),
        k.cast("double").alias("uvIndex"),
        F.when(F.col("value") > 300, F.lit("rain")).alias("precipType"))
    g = (e.groupBy(F.floor(F.col("event_id") / ENTRIES_PER_DOC).alias("doc_no"))
         .agg(F.collect_list(entry).alias("data")))
    doc = F.struct(F.lit(52.52).alias("latitude"), F.lit(13.38).alias("longitude"),
                   F.struct(F.lit("hourly").alias("summary"), F.col("data").alias("data")).alias("hourly"))
    return g.select("doc_no", F.to_json(doc).alias("value"))


_NULL_DOUBLES = ",\n".join(
    f"CAST(NULL AS DOUBLE) AS {f}" for f in docs.HOURLY_DOUBLE_FIELDS
    if f not in ("temperature", "uvIndex"))


@query("hourly_doc", covers=("S4", "F20"), sql=_EVENTS_BASE + f"""
SELECT CAST(event_id // 24 AS BIGINT) AS doc_no,
{_NULL_DOUBLES},
       'u' || CAST(user_id AS VARCHAR) AS icon,
       CASE WHEN value > 300 THEN 'rain' END AS precipType,
       event_type AS summary,
       value AS temperature,
       CAST(k AS DOUBLE) AS uvIndex,
       CAST(epoch_us(ts) // 1000000 AS BIGINT) AS time,
       make_timestamp(CAST(epoch_us(ts) // 1000000 AS BIGINT) * 1000000) AS timestamp
FROM e
""")
def q_hourly_doc(spark, sf_dir):
    parsed = docs.parse_documents(hourly_documents(spark, sf_dir), keep=["doc_no"])
    return docs.flatten_hourly(parsed, keep=["doc_no"])


# -- files written by Spark from the driver's tables, read back by the readers ---

@query("nightly_event_ingest", stateful=True, covers=("S1", "S11", "I12"), sql=_REPAIRED_SQL)
def q_nightly_event_ingest(spark, sf_dir):
    """Two nights of raw event files loaded by two availableNow runs of a
    streaming query; the second run reads only the second night's files."""
    root = work_dir(spark, "nightly")
    src, tgt, bad, ckpt = (f"{root}/{n}" for n in ("incoming", "events", "problems", "_checkpoint"))
    e, first = read_table(spark, sf_dir, "events"), _written_day() < "2024-01-16"
    for night in (e.where(first), e.where(~first)):
        raw_event_lines(spark, sf_dir, night).write.mode("append").text(src)
        ingest_event_files(spark, src, tgt, bad, ckpt, EVENT_FIELDS, EVENT_TYPES, EVENT_MONEY,
                           "event_id")
    return read_ingested(spark, tgt).drop("batch_id")


DELIVERY_CUT, CORRECTED_EVERY, CORRECTED_REST = "2024-01-16", 50, 7


def event_deliveries(spark, sf_dir) -> list[dict[str, DataFrame]]:
    """Raw lines by night, in three deliveries: the first night; the first night again
    with the second, which also corrects (amount + 1) some events of the first; the first once more."""
    e = read_table(spark, sf_dir, "events")
    first = F.col("ts") < F.lit(DELIVERY_CUT).cast("timestamp_ntz")
    corrected = (e.where(first & (F.col("event_id") % CORRECTED_EVERY == CORRECTED_REST))
                 .withColumn("value", F.col("value") + 1))
    one, two = (raw_event_lines(spark, sf_dir, x) for x in (e.where(first), e.where(~first).unionByName(corrected)))
    return [{"2024-01-15": one}, {"2024-01-15": one, "2024-01-16": two}, {"2024-01-15": one}]


def merged_events(spark, sf_dir) -> tuple[CatalogTable, str]:
    """All deliveries loaded, each by a run of its own: the merged table and the landing folder."""
    root = work_dir(spark, "merge")
    db = open_database(spark, f"wharf_{root.rsplit('-', 1)[1]}", f"{root}/db")
    table = CatalogTable(spark, f"{db}.events", f"{root}/db/events", "event_id", merge_buckets(
        read_table(spark, sf_dir, "events").count(), path_bytes(spark, table_path(sf_dir, "events"))))
    night = F.regexp_extract("_metadata.file_path", "/night=([^/]+)/", 1)
    files = {}                                     # a night delivered again is a copy of its file, not made anew
    for n, nights in enumerate(event_deliveries(spark, sf_dir)):
        for name, lines in nights.items():
            path = f"{root}/incoming/delivery-{n}/night={name}"
            (spark.read.text(files[id(lines)]) if id(lines) in files else lines).write.text(path)
            files.setdefault(id(lines), path)
        merge_event_files(spark, f"{root}/incoming", table, f"{root}/landing", f"{root}/_checkpoint",
                          EVENT_FIELDS, EVENT_TYPES, EVENT_MONEY, night)
    return table, f"{root}/landing"


_MERGED_BASE = f"""
WITH d AS (
  SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, ts < TIMESTAMP '{DELIVERY_CUT}' AS early FROM events),
e AS (
  SELECT * REPLACE (CASE WHEN early AND event_id % {CORRECTED_EVERY} = {CORRECTED_REST} THEN value + 1 ELSE value END AS value)
  FROM d)
"""


@query("nightly_event_merge", stateful=True, covers=("S1", "I12"),
       sql=_MERGED_BASE + _REPAIRED_SQL[len(_EVENTS_BASE):])
def q_nightly_event_merge(spark, sf_dir):
    """A file delivered three times and events corrected by a later file: one row for each event, as last corrected."""
    table, _ = merged_events(spark, sf_dir)
    return table.read().drop("version")


@query("event_load_reconcile", stateful=True, covers=("S3", "C5", "I12"), sql=_MERGED_BASE + f"""
, lines AS (
  SELECT 0 AS batch_id, k FROM d WHERE early
  UNION ALL SELECT 1, k FROM d
  UNION ALL SELECT 1, k FROM d WHERE early AND event_id % {CORRECTED_EVERY} = {CORRECTED_REST}
  UNION ALL SELECT 2, k FROM d WHERE early)
SELECT CAST(batch_id AS BIGINT) AS batch_id, CAST(count(*) AS BIGINT) AS input_lines,
       CAST(count(*) FILTER (WHERE k NOT IN (98, 99)) AS BIGINT) AS loaded_rows,
       CAST(count(*) FILTER (WHERE k IN (98, 99)) AS BIGINT) AS quarantined_rows, true AS matches
FROM lines GROUP BY batch_id
""")
def q_event_load_reconcile(spark, sf_dir):
    """Input lines = loaded + quarantined rows, for each load."""
    _, landing = merged_events(spark, sf_dir)
    return reconcile_loads(spark, landing)


@query("category_totals_csv", stateful=True, covers=("S6", "J1", "A13", "P9"), sql="""
SELECT t.o_orderpriority AS transaction_category_id,
       CAST(sum(CAST(floor(t.o_totalprice * 100 + 0.5) AS BIGINT)) AS DOUBLE) / 100.0 AS sum_amount,
       CAST(count(DISTINCT t.o_custkey) AS BIGINT) AS num_users
FROM orders t
WHERE t.o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
  AND NOT (t.o_orderstatus = 'P')
GROUP BY t.o_orderpriority
""")
def q_category_totals_csv(spark, sf_dir):
    """users.csv / transactions.csv written by Spark (headers in other case
    and order, a duplicated user row), read back by header name."""
    root = work_dir(spark, "csv")
    users, tx = users_transactions(spark, sf_dir)
    (users.select(F.col("is_active").alias("IS_ACTIVE"), F.col("user_id").alias("User_Id"))
     .write.option("header", True).csv(f"{root}/users"))
    (tx.select(F.col("transaction_category_id"),
               (F.col("transaction_amount") / 100).cast("decimal(18,2)").alias("Transaction_Amount"),
               F.col("user_id").alias("USER_ID"), F.col("is_blocked"), F.col("transaction_id"))
     .write.option("header", True).csv(f"{root}/transactions"))
    u = read_csv(spark, f"{root}/users", {"user_id": "bigint", "is_active": "string"})
    t = read_csv(spark, f"{root}/transactions", {
        "user_id": "bigint", "is_blocked": "string", "transaction_amount": "decimal(18,2)",
        "transaction_category_id": "string"})
    out = agg.category_totals(t.where(is_text_false("is_blocked")), u.where(is_text_true("is_active")))
    return out.select("transaction_category_id", F.col("sum_amount").cast("double").alias("sum_amount"),
                      "num_users")


@query("fx_usd_seed_csv", stateful=True, covers=("S7", "P12", "F17"), sql="WITH " + si.PAYMENT_FACT_CTE.replace(
    "{run_ts}", "2024-01-01 00:00:00") + """
SELECT transaction_id, currency_code, amount, amount_usd FROM acc3
""")
def q_fx_usd_seed_csv(spark, sf_dir):
    """The acceptance seed written as CSV (JSON rates inside quotes) and read
    back as text by the seed reader."""
    root = work_dir(spark, "seed")
    (si.acceptance_seed(spark, sf_dir).write.option("header", True)
     .option("quote", '"').option("escape", '"').csv(root))
    acc = pay.clean_acceptance(read_seed(spark, root))
    return acc.select("transaction_id", "currency_code", "amount", "amount_usd")


# -- nightly load of yesterday's hourly data (S5, I12) ----------------------------
NIGHT_RUNS = ["2024-01-19 03:00:00", "2024-01-20 03:00:00", "2024-01-20 03:00:00"]   # last is a rerun


DOC_SCHEMA = T.StructType([T.StructField("doc_no", T.LongType()), T.StructField("value", T.StringType())])


def nightly_weather_load(spark, landed: str, root: str, run_ts: str) -> None:
    """Flatten the landed documents of the day before ``run_ts`` (no other day's
    are read), keep that day's entries and restate that one day of the
    date-partitioned table, so a rerun of the same night replaces its day
    instead of doubling it."""
    raw = docs.read_day(spark, landed, run_ts, DOC_SCHEMA)
    flat = docs.flatten_hourly(docs.parse_documents(raw, keep=["doc_no"]))
    day_rows = (flat.where(docs.in_day_window(F.col("timestamp"), run_ts))
                .select("time", "timestamp", "temperature", "summary",
                        F.to_date("timestamp").alias("day")))
    run_date = dt.date.fromisoformat(run_ts[:10])
    replace_window_partitions(spark, root, day_rows, "day", run_date, 1)


@query("nightly_weather", stateful=True, covers=("S4", "S5", "I11", "I12", "F20"), sql="""
SELECT CAST(epoch_us(ts) // 1000000 AS BIGINT) AS time,
       make_timestamp(CAST(epoch_us(ts) // 1000000 AS BIGINT) * 1000000) AS timestamp,
       value AS temperature, event_type AS summary, CAST(ts AS DATE) AS day
FROM events WHERE ts >= TIMESTAMP '2024-01-18 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00'
""")
def q_nightly_weather(spark, sf_dir):
    landed, root = work_dir(spark, "weather-landed"), work_dir(spark, "weather")
    docs.land_by_day(hourly_documents(spark, sf_dir), landed)
    for run_ts in NIGHT_RUNS:
        nightly_weather_load(spark, landed, root, run_ts)
    return spark.read.parquet(root).select("time", "timestamp", "temperature", "summary", "day")


@query("control_diff_events", stateful=True, covers=("C6", "A19", "S11"), sql=_EVENTS_BASE + """
, r AS (SELECT CAST(round(value * 100) AS BIGINT) AS c FROM e WHERE k NOT IN (98, 99))
SELECT 'rows_count' AS metric, CAST(count(*) AS BIGINT) AS before_value,
       CAST(count(*) AS BIGINT) AS after_value, true AS matches FROM r
UNION ALL
SELECT 'real_currency_amount_centum_sum', CAST(sum(c) AS BIGINT), CAST(sum(c) AS BIGINT), true FROM r
""")
def q_control_diff_events(spark, sf_dir):
    """Repaired events loaded into a parquet table; totals before the load
    are observed while the rows are written, totals after are read back."""
    from wharf.operators.checks import control_diff_loaded, load_with_totals
    cols = ["real_currency_amount_centum"]
    path = work_dir(spark, "loaded-events")
    before = load_with_totals(q_repaired_events(spark, sf_dir), path, cols)
    return control_diff_loaded(spark, before, spark.read.parquet(path), cols)
