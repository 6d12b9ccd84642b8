"""Line dedup: drop lines that many documents share.

Lines are exploded, normalised and hashed; a line's hash counts each document
once (repeats within a document are removed before anything is shuffled), and
the lines that reach the threshold are dropped from every document, the rest
put together again by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wharf.llm.common import ascii_lower, materialise, pack, unpack

MIN_DOCS = 10
MIN_CHARS = 1
STRIPPED = " \t\n\x0b\x0c\r"


def line_keys(text: Column) -> Column:
    """Keys of a text's lines: A-Z lower-cased, white space stripped at both ends."""
    return F.transform(F.split(ascii_lower(text), "\n", -1), lambda x: F.trim(x, F.lit(STRIPPED)))


def digest(text: Column) -> Column:
    """128 bits in two longs: two lines never meet by chance."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))


def drop_common_lines(docs: DataFrame, text: str = "text", min_docs: int = MIN_DOCS,
                      min_chars: int = MIN_CHARS) -> DataFrame:
    """Every row with kept_text, n_lines and n_dropped.

    A document is a row; repeated rows and ids count as documents of their own.
    Null or empty text: one empty line, kept_text ''. All lines dropped: ''. A
    line shorter than ``min_chars`` as a key always stays. Empty table: no rows.
    Columns named like an added one give way to it.
    """
    keys = F.transform(line_keys(F.coalesce(F.col(text), F.lit(""))),
                       lambda x: F.when(F.length(x) >= min_chars, digest(x)))
    base = materialise(pack(docs, row=F.monotonically_increasing_id(), keys=keys), "line-dedup")
    # written, so that the join below has the lines' shuffle to itself and AQE can split a common line
    # distinct as texts: array_distinct hashes those, but compares all pairs of structs
    written = F.transform("keys", lambda k: F.concat(k["a"].cast("string"), F.lit(":"), k["b"].cast("string")))
    half = lambda n: F.substring_index("k", ":", n).cast("long")
    common = materialise(
        base.select(F.explode(F.array_distinct(written)).alias("k")).where("k is not null")
        .select(half(1).alias("a"), half(-1).alias("b"))
        .groupBy("a", "b").agg(F.count("*").alias("n_docs")).where(F.col("n_docs") >= min_docs)
        .select("a", "b"), "line-dedup-common")
    gone = (base.select("row", F.posexplode("keys").alias("at", "k"))
            .select("row", "at", "k.a", "k.b").join(common, ["a", "b"], "left_semi")
            .groupBy("row").agg(F.collect_list("at").alias("gone")))
    rows = base.join(gone, "row", "left").select(
        "_row", F.size("keys").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"), "gone")
    # the lines as a column that is used twice, so that they aren't split again for each line that stays
    whole = F.coalesce(F.col(f"_row.`{text}`"), F.lit(""))
    rows = rows.withColumn("lines", F.when(F.col("gone").isNotNull(), F.split(whole, "\n", -1)))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    kept = F.when(F.col("gone").isNull(), whole).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n"))
    return unpack(rows.withColumn("kept_text", kept), "kept_text", "n_lines", "n_dropped")
