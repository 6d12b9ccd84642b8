"""Raw game-event text → typed rows, plus a problem report.

The raw form is a list of flat dicts in Python-literal style: single
quotes, ``True``/``False``/``NULL`` words, missing values (``'k': ,``),
comma decimals, one record per line inside ``[ ... ]``. One JVM-side regular
expression goes once over each line and marks its pairs (so apostrophes,
quotes and the words True/False *inside* values survive); fields are then cut
out at the marks. Typing happens afterwards with ``try_cast`` so a bad value
nulls one field, not the row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wharf.functions.columns import cents
from wharf.session import spread

CORRUPT = "_corrupt_record"

# --- fixed values: the form of a record ------------------------------------------
# One pass takes a record apart: every pair must start where the one before
# ended, and the last one must end the record, so text inside a value is never
# taken for structure and what does not fit is left over.
OPENS = r"[\s\[,]*\{"                                     # list bracket or separator, then the record
CLOSES = r"\}[\s\],}]*$"
NEXT_KEY = r"\s*'[^'\\]*'\s*:"
BARE = r"NULL|None|null|True|False|true|false|-?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?|"       # a missing value is null
PAIR = (rf"(?s)(?:^{OPENS}|(?!^)\G)\s*'([^'\\]+)'\s*:\s*(?:('.*?')|({BARE}))\s*(?:,(?={NEXT_KEY})|{CLOSES})")
KEY_MARK, VALUE_MARK, BARE_MARK, END_MARK = "\x01", "\x02", "\x03", "\x04"
NULL_WORDS = ["", "NULL", "None", "null"]
# -------------------------------------------------------------------------------


def take_apart(line: Column) -> Column:
    """A raw record as marked pairs (key, then quoted or bare value), or text that
    does not both begin with a key's and end with a pair's mark if it is no record."""
    marks = KEY_MARK + VALUE_MARK + BARE_MARK + END_MARK
    plain = F.translate(line, marks, " " * len(marks))
    return F.regexp_replace(plain, PAIR, f"{KEY_MARK}$1{VALUE_MARK}$2{BARE_MARK}$3{END_MARK}")


def _raw_value(pairs: Column, name: str) -> Column:
    """The value of a field as written, null if the record lacks it (twice: the last one)."""
    key = KEY_MARK + name + VALUE_MARK
    found = F.substring_index(F.substring_index(pairs, key, -1), END_MARK, 1)
    return F.when(F.contains(pairs, F.lit(key)), found)


def _text(value: Column) -> Column:
    """Text of a value: quoted ones without their quotes and escapes, bare ones as JSON would write them."""
    inner = F.substr(value, F.lit(2), F.length(value) - 3)
    json = F.concat(F.lit('["'), F.regexp_replace(inner, r'(?<!\\)"', r'\\"'), F.lit('"]'))
    unescaped = F.coalesce(F.get(F.from_json(json, "array<string>"), F.lit(0)), inner)
    bare = F.substr(value, F.lit(2))
    return (F.when(F.startswith(value, F.lit("'")), F.when(F.contains(inner, F.lit("\\")), unescaped).otherwise(inner))
            .when(bare.isin(NULL_WORDS), F.lit(None)).when(bare.isin("True", "False"), F.lower(bare)).otherwise(bare))


def drop_bad_bytes(line: Column) -> Column:
    """Replace invalid UTF-8 by U+FFFD, then drop it (undecodable bytes ignored)."""
    return F.replace(F.make_valid_utf8(line), F.lit("\ufffd"), F.lit(""))


def read_lines(spark: SparkSession, path: str, record_sep: str | None = None) -> DataFrame:
    """Raw lines as column ``value``. ``record_sep`` (e.g. ``'},'``) lets a
    record span several lines; the separator is put back as ``}``."""
    if record_sep is None:
        return spark.read.text(path)
    df = spark.read.option("lineSep", record_sep).text(path)
    closing = "}" if record_sep.startswith("}") else ""
    return df.select(F.concat(F.regexp_replace("value", r"[\r\n]+", " "), F.lit(closing)).alias("value"))


def is_record(line: Column) -> Column:
    """Whether a raw line counts: not blank and not only the list's own brackets and commas."""
    return ~line.rlike(r"^[\s\[\],]*$")


def parse_events(lines: DataFrame, fields: list[str], line_col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Take lines apart; every field comes back as text, plus ``_corrupt_record``
    holding the text of lines that failed, and the columns to ``keep``."""
    # Only blank lines and the list's own brackets are no records; any other
    # line is loaded or reported. They go inside a generator: a filter would be
    # pushed below whatever makes the lines and make them twice.
    records = spread(lines).select(*keep, F.explode(F.filter(F.array(line_col), is_record)).alias("_raw"))
    line = drop_bad_bytes(F.col("_raw"))
    apart = records.select(*keep, line.alias("_line"), take_apart(line).alias("_pairs"))
    # a key left inside a value means that a quote before it was never closed
    ok = (F.startswith("_pairs", F.lit(KEY_MARK)) & F.endswith("_pairs", F.lit(END_MARK))
          & ~F.col("_pairs").rlike(f",{NEXT_KEY}") | F.col("_pairs").rlike(rf"^{OPENS}\s*{CLOSES}"))
    names = [f"_v{i}" for i in range(len(fields))]
    values = apart.select(*keep, F.when(~ok, F.trim("_line")).alias(CORRUPT),
                          *[F.when(ok, _raw_value(F.col("_pairs"), f)).alias(n) for f, n in zip(fields, names, strict=True)])
    return values.select(*[_text(F.col(n)).alias(f) for f, n in zip(fields, names, strict=True)], CORRUPT, *keep)


def type_events(raw: DataFrame, types: Mapping[str, str], money: Mapping[str, str]) -> DataFrame:
    """Cast text fields: ``types`` maps field → Spark type (lenient casts);
    ``money`` maps text amount field → cents column name."""
    cols = []
    for c in raw.columns:
        if c == CORRUPT:
            continue
        if c in money:
            cols.append(cents(c).alias(money[c]))
        elif c in types:
            cols.append(F.col(c).try_cast(types[c]).alias(c))
        else:
            cols.append(F.col(c))
    # Keep parseable rows with a one-element array filtered inside a generator:
    # a plain Filter on the parsed struct would be pushed below the projection
    # and evaluate the repair and the JSON parse a second time.
    packed = F.array(F.struct(*[F.col(c) for c in raw.columns]))
    ok = raw.select(F.inline(F.filter(packed, lambda r: r[CORRUPT].isNull())))
    return ok.select(*cols)


def problem_rows(raw: DataFrame, types: Mapping[str, str], money: Mapping[str, str],
                 key: str) -> DataFrame:
    """One row per problem: (key, problem, value). Unparseable lines carry
    the key found in their text; typed fields whose text does not convert are listed
    with the offending value. Problem lines stay whole; nothing is dropped
    silently: ``type_events`` returns the parseable rows, this the rest."""
    probs = [F.when(F.col(CORRUPT).isNotNull(),
                    F.struct(F.lit("unparseable record").alias("problem"),
                             F.lit(None).cast("string").alias("value")))]
    for c, t in types.items():
        probs.append(F.when(F.col(CORRUPT).isNull() & F.col(c).isNotNull()
                            & F.col(c).try_cast(t).isNull(),
                            F.struct(F.lit(f"unreadable {c}").alias("problem"),
                                     F.col(c).alias("value"))))
    for c in money:
        dec = F.regexp_replace(F.col(c), ",", ".").try_cast("decimal(18,2)")
        probs.append(F.when(F.col(CORRUPT).isNull() & F.col(c).isNotNull() & dec.isNull(),
                            F.struct(F.lit(f"unreadable {c}").alias("problem"),
                                     F.col(c).alias("value"))))
    arr = F.filter(F.array(*probs), lambda x: x.isNotNull())
    # the key of an unparseable line is read from its text
    found = F.regexp_extract(F.col(CORRUPT), rf"""['"]{key}['"]\s*:\s*['"]?([^'",}}\s]*)""", 1)
    k = F.coalesce(F.col(key).cast("string"), F.nullif(found, F.lit("")))
    return raw.select(k.alias(key), F.explode(arr).alias("p")).select(key, "p.problem", "p.value")


def read_events(spark: SparkSession, path: str, fields: list[str], types: Mapping[str, str],
                money: Mapping[str, str], record_sep: str | None = None) -> DataFrame:
    """Read, repair, parse and type an event file (problem rows excluded;
    see ``problem_rows`` for the report)."""
    raw = parse_events(read_lines(spark, path, record_sep), fields)
    return type_events(raw, types, money)
