"""Payment model: raw acceptance / chargeback seeds → staged tables with
change stamps → payment fact → daily, monthly, by-country and missing-
chargeback reports.

Seeds are read as text (see ``wharf.sources.files.read_seed``); staging
casts, cleans and hashes them. ``run_ts`` stands in for the load time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wharf.functions.columns import (clean_upper, lit_date, lit_ts, rates_map, ratio, record_hash,
                                     seed_bool, usd_amount)
from wharf.operators.aggregates import money_sum
from wharf.operators.incremental import (DEFAULT_SOURCE_MARK, assert_unique, combined_stamp,
                                         stamp_and_merge, upsert)

# --- fixed values ------------------------------------------------------------
ACCEPTED = "ACCEPTED"
DECLINED = "DECLINED"
DECLINED_USD_THRESHOLD = 25_000_000
# ------------------------------------------------------------------------------

ACCEPTANCE_SEED_COLS = ["external_ref", "status", "source", "ref", "date_time", "state",
                        "cvv_provided", "amount", "country", "currency", "rates"]
CHARGEBACK_SEED_COLS = ["external_ref", "status", "source", "chargeback"]


def clean_acceptance(seed: DataFrame) -> DataFrame:
    """Rename, cast and enrich the acceptance seed (no stamps yet)."""
    r = seed.select(
        F.col("external_ref").alias("transaction_id"),
        seed_bool("status").alias("report_status"),
        F.col("source").alias("payment_source"),
        F.col("ref").alias("provider_event_id"),
        F.col("date_time").cast("timestamp_ntz").alias("transaction_at"),
        clean_upper("state").alias("transaction_state"),
        seed_bool("cvv_provided").alias("is_cvv_provided"),
        F.col("amount").try_cast("double").alias("amount"),
        clean_upper("country").alias("country_code"),
        clean_upper("currency").alias("currency_code"),
        rates_map("rates").alias("rates"),
    )
    return r.select(
        "transaction_id", "report_status", "payment_source", "provider_event_id",
        "transaction_at", F.to_date("transaction_at").alias("transaction_date"),
        "transaction_state", "is_cvv_provided", "amount", "country_code", "currency_code",
        "rates",
        usd_amount("amount", "currency_code", "rates").alias("amount_usd"),
        record_hash("report_status", "transaction_state", "provider_event_id").alias("record_hash"),
    )


def clean_chargeback(seed: DataFrame) -> DataFrame:
    return seed.select(
        F.col("external_ref").alias("transaction_id"),
        seed_bool("status").alias("report_status"),
        F.col("source").alias("payment_source"),
        seed_bool("chargeback").alias("has_chargeback"),
    ).withColumn("record_hash", record_hash("report_status", "has_chargeback"))


def stage(cleaned: DataFrame, run_ts, target: DataFrame | None = None,
          check_unique: bool = True) -> DataFrame:
    """Incremental staging: merge cleaned rows into ``target`` by
    ``transaction_id``; stamps move only for new ids or a changed hash."""
    if check_unique:
        assert_unique(cleaned, "transaction_id")
    return stamp_and_merge(cleaned, target, "transaction_id", run_ts)


def fact_mark(fact: DataFrame | None):
    """Newest ``source_dw_modified_at`` of the fact, else 1900-01-01 (one scalar)."""
    if fact is None:
        return DEFAULT_SOURCE_MARK
    m = fact.select(F.max("source_dw_modified_at").alias("m")).first()["m"]
    return m if m is not None else DEFAULT_SOURCE_MARK


def join_payments(acceptance: DataFrame, chargeback: DataFrame) -> DataFrame:
    """Acceptance ⟕ chargeback on the id: keeps acceptance orphans, drops
    chargeback orphans."""
    a, c = acceptance.alias("a"), chargeback.alias("c")
    return a.join(c, F.col("a.transaction_id") == F.col("c.transaction_id"), "left").select(
        F.col("a.transaction_id"), F.col("a.provider_event_id"), F.col("a.payment_source"),
        F.col("a.transaction_at"), F.col("a.transaction_date"), F.col("a.transaction_state"),
        (F.col("a.transaction_state") == ACCEPTED).alias("is_accepted"),
        (F.col("a.transaction_state") == DECLINED).alias("is_declined"),
        F.col("a.country_code"), F.col("a.currency_code"), F.col("a.amount"),
        F.col("a.amount_usd"), F.col("a.is_cvv_provided"), F.col("c.has_chargeback"),
        (F.col("c.transaction_id").isNull() | F.col("c.has_chargeback").isNull())
        .alias("is_missing_chargeback"),
        F.col("a.report_status").alias("acceptance_report_status"),
        F.col("c.report_status").alias("chargeback_report_status"),
        F.col("a.rates"),
        combined_stamp(F.col("a.dw_modified_at"), F.col("c.dw_modified_at"))
        .alias("source_dw_modified_at"),
    )


def fact_changes(acceptance: DataFrame, chargeback: DataFrame, run_ts,
                 fact: DataFrame | None = None, run_date=None,
                 backfill_days: int | None = 0, mark=None) -> DataFrame:
    """New fact rows for this run; without ``fact`` all rows (full build).

    With it, the rows of the changed ids: those that ``changed_ids`` lists. Both
    sides are read in full and joined first, so an unchanged side is not mistaken
    for a missing one. The joined row's combined stamp is newer than ``mark``
    exactly if either side's is, so the ids need no list of their own, and staging
    tables in the same buckets are joined where they lie. ``mark`` is the fact's
    newest ``source_dw_modified_at`` if already known (else it is computed)."""
    joined = join_payments(acceptance, chargeback)
    if fact is not None:
        newer = F.col("source_dw_modified_at") > lit_ts(mark if mark is not None else fact_mark(fact))
        if backfill_days is not None:
            run_date = run_date or dt.date.fromisoformat(str(run_ts)[:10])
            newer = newer | (F.col("transaction_date") >= F.date_sub(lit_date(run_date), int(backfill_days)))
        joined = joined.where(newer)
    ts = lit_ts(run_ts)
    return joined.withColumn("dw_created_at", ts).withColumn("dw_modified_at", ts)


def changed_rows(staged: DataFrame, ids: DataFrame) -> DataFrame:
    """Staged rows of the listed ids (IN of a sub-select)."""
    return staged.join(ids, "transaction_id", "left_semi")


def merge_fact(new: DataFrame, fact: DataFrame | None) -> DataFrame:
    """MERGE by id keeping ``dw_created_at`` of existing rows."""
    return upsert(fact, new, "transaction_id", keep=["dw_created_at"])


def build_fact(acceptance: DataFrame, chargeback: DataFrame, run_ts,
               fact: DataFrame | None = None, run_date=None,
               backfill_days: int | None = 0) -> DataFrame:
    """Whole new fact table content (changes merged into ``fact``)."""
    new = fact_changes(acceptance, chargeback, run_ts, fact, run_date, backfill_days)
    return merge_fact(new, fact)


# -- reports ------------------------------------------------------------------------

def acceptance_daily(fact: DataFrame) -> DataFrame:
    """Accepted, total, rate and newest stamp per transaction date."""
    return (fact.groupBy("transaction_date")
            .agg(F.count_if("is_accepted").alias("accepted_count"),
                 F.count(F.lit(1)).alias("total_count"),
                 F.max("dw_modified_at").alias("dw_modified_at"))
            .select("transaction_date", "accepted_count", "total_count",
                    ratio("accepted_count", "total_count").alias("acceptance_rate"),
                    "dw_modified_at"))


def acceptance_monthly(daily: DataFrame) -> DataFrame:
    """Monthly roll-up of the daily view: sum/sum, not an average of rates."""
    return (daily.groupBy(F.trunc("transaction_date", "month").alias("transaction_month"))
            .agg(F.sum("accepted_count").alias("accepted_count"),
                 F.sum("total_count").alias("total_count"))
            .withColumn("acceptance_rate", ratio("accepted_count", "total_count")))


def declined_by_country(fact: DataFrame, threshold: float = DECLINED_USD_THRESHOLD) -> DataFrame:
    """Countries whose declined USD amount exceeds ``threshold`` (HAVING)."""
    agg = (fact.where(F.col("is_declined"))
           .groupBy("country_code")
           .agg(F.count(F.lit(1)).alias("declined_transaction_count"),
                money_sum("amount_usd").alias("declined_amount_usd"),
                F.max("dw_modified_at").alias("dw_modified_at")))
    return agg.where(F.col("declined_amount_usd") > F.lit(threshold))


def missing_chargeback(fact: DataFrame) -> DataFrame:
    return fact.where(F.col("is_missing_chargeback")).select(
        "transaction_id", "provider_event_id", "transaction_at", "transaction_state",
        "country_code", "currency_code", "amount_usd", "has_chargeback",
        "is_missing_chargeback", "dw_modified_at")
