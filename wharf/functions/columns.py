"""Column-level helpers: every function returns a ``Column`` built from
``pyspark.sql.functions``, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's rules) -----------------------
# Seed text accepted as boolean true / false after trim + upper-case;
# anything else is NULL.
TRUE_SPELLINGS = ["TRUE", "T", "1", "Y", "YES"]
FALSE_SPELLINGS = ["FALSE", "F", "0", "N", "NO"]
# Placeholder for NULL inside a change hash, so that (a, NULL) and (a)
# hash differently.
HASH_NULL = "__NULL__"
# Placeholder used by the profile / frequency reports for a NULL value.
NULL_TEXT = "NULL"
# Open end of a validity interval.
OPEN_END = dt.date(9999, 12, 31)
# ----------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_upper(c) -> Column:
    """``upper(trim(x))`` used for state, country and currency codes."""
    return F.upper(F.trim(_col(c)))


def seed_bool(c) -> Column:
    """Seed text to boolean: known spellings → true/false, else NULL."""
    t = F.upper(F.trim(_col(c).cast("string")))
    return (F.when(t.isin(TRUE_SPELLINGS), F.lit(True))
            .when(t.isin(FALSE_SPELLINGS), F.lit(False)))


def is_text_true(c) -> Column:
    """Exact text comparison with 'True' (any other spelling is false)."""
    return F.coalesce(_col(c) == F.lit("True"), F.lit(False))


def is_text_false(c) -> Column:
    return F.coalesce(_col(c) == F.lit("False"), F.lit(False))


def try_double(c) -> Column:
    """Lenient text → double (NULL when unreadable)."""
    return _col(c).try_cast("double")


def money_decimal(c, scale_type: str = "decimal(18,2)") -> Column:
    """Money text or number → exact decimal; comma decimals accepted."""
    return F.regexp_replace(_col(c).cast("string"), ",", ".").try_cast(scale_type)


def cents(c) -> Column:
    """Money → integer cents. NULL/missing → 0; comma or dot decimals.

    Goes through decimal(18,2) rather than binary floating point, so 19.99
    becomes 1999 (float truncation would give 1998).
    """
    return (F.coalesce(money_decimal(c), F.lit(0).cast("decimal(18,2)")) * 100).cast("bigint")


def paid_flag(amount_cents) -> Column:
    """1 when the amount is positive, else 0 (NULL amount → 0)."""
    return F.when(_col(amount_cents) > 0, F.lit(1)).otherwise(F.lit(0))


def rates_map(json_text) -> Column:
    """JSON object text → map<string,string>; broken JSON → NULL.

    A string-valued map keeps one bad rate from nulling the whole map.
    """
    return F.from_json(_col(json_text), "map<string,string>")


def usd_amount(amount, currency, rates) -> Column:
    """Settle an amount in USD: rates hold units of currency per 1 USD.

    USD → amount; missing map or rate → NULL; zero or unreadable rate → NULL.
    """
    a, cur, r = _col(amount), _col(currency), _col(rates)
    rate_text = F.try_element_at(r, cur)
    rate = rate_text.try_cast("double")
    return (F.when(cur == F.lit("USD"), a)
            .when(r.isNull() | rate_text.isNull(), F.lit(None).cast("double"))
            .when(rate == 0, F.lit(None).cast("double"))
            .otherwise(a / rate))


def record_hash(*cols) -> Column:
    """Change hash over columns; NULL is replaced by a placeholder first
    (xxhash64 skips NULL inputs, which would make (a, NULL) equal (a))."""
    return F.xxhash64(*[F.coalesce(_col(c).cast("string"), F.lit(HASH_NULL)) for c in cols])


def null_safe_text(c) -> Column:
    """Value as text with NULL shown as 'NULL' (profile / frequency keys)."""
    return F.coalesce(_col(c).cast("string"), F.lit(NULL_TEXT))


def week_bucket(ts, edges: Sequence[tuple[str, str]]) -> Column:
    """Bucket number 1..n for the inclusive date ranges ``edges``; NULL outside."""
    d = F.to_date(_col(ts))
    out = None
    for i, (lo, hi) in enumerate(edges, start=1):
        cond = d.between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))
        out = F.when(cond, F.lit(i)) if out is None else out.when(cond, F.lit(i))
    return out


def name_initial(name, occupation) -> Column:
    """``name(X)`` with X the first letter of the occupation; a NULL
    occupation gives ``name()``; a NULL name is skipped like a NULL-skipping concat."""
    return F.concat_ws("", _col(name), F.lit("("),
                       F.substring(F.coalesce(_col(occupation), F.lit("")), 1, 1), F.lit(")"))


def count_sentence(cnt, occupation) -> Column:
    """'There are a total of N xs.' with NULL parts skipped."""
    return F.concat_ws("", F.lit("There are a total of "), _col(cnt).cast("string"), F.lit(" "),
                       F.lower(_col(occupation)), F.lit("s."))


def ratio(num, den) -> Column:
    """num / den as double, NULL when den is 0 (no ANSI divide-by-zero)."""
    return _col(num).cast("double") / F.nullif(_col(den).cast("double"), F.lit(0.0))


def day_window_start(run_ts) -> Column:
    """Midnight of the day before ``run_ts`` (start of a nightly load window)."""
    return F.date_trunc("DAY", _col(run_ts)) - F.expr("INTERVAL 1 DAY")


def lit_date(d) -> Column:
    return F.lit(str(d)).cast("date")


def lit_ts(t) -> Column:
    return F.lit(str(t)).cast("timestamp_ntz")
