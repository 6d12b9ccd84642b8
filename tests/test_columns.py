import datetime as dt

from pyspark.sql import functions as F

from wharf.functions import columns as C


def col_values(df, col):
    if isinstance(col, int):
        return [r[col] for r in df.collect()]
    return [r[0] for r in df.select(col).collect()]


def test_seed_bool_spellings(spark):
    df = spark.createDataFrame(
        [("TRUE",), (" t ",), ("1",), ("y",), ("Yes",), ("false",), ("F",), ("0",), ("n",), ("NO",),
         ("maybe",), ("",), (None,)], "s string")
    got = col_values(df.select(C.seed_bool("s").alias("b")), "b")
    assert got == [True] * 5 + [False] * 5 + [None] * 3


def test_text_true_is_exact(spark):
    df = spark.createDataFrame([("True",), ("true",), ("TRUE",), (None,)], "s string")
    assert col_values(df.select(C.is_text_true("s")), 0) == [True, False, False, False]


def test_cents_decimal_discipline(spark):
    df = spark.createDataFrame([("19.99",), ("4,99",), ("4.99",), (None,), ("0.1",), ("100",)], "s string")
    assert col_values(df.select(C.cents("s")), 0) == [1999, 499, 499, 0, 10, 10000]


def test_usd_amount_cases(spark):
    rows = [
        (10.0, "USD", None),                                   # USD → amount even without rates
        (9.0, "EUR", '{"EUR": 0.9}'),                          # converted
        (9.0, "GBP", '{"EUR": 0.9}'),                          # missing rate → NULL
        (9.0, "JPY", '{"JPY": 0}'),                            # zero rate → NULL
        (9.0, "EUR", '{"EUR": "n/a"}'),                        # non-numeric → NULL
        (9.0, "EUR", '{"EUR": 0.9, '),                         # broken JSON → NULL
        (9.0, "EUR", '{"EUR": "0.9", "X": "bad"}'),           # one bad rate does not null others
    ]
    df = spark.createDataFrame(rows, "amount double, cur string, rates string")
    out = col_values(df.select(C.usd_amount("amount", "cur", C.rates_map("rates"))), 0)
    assert out[0] == 10.0
    assert abs(out[1] - 10.0) < 1e-9
    assert out[2:6] == [None, None, None, None]
    assert abs(out[6] - 10.0) < 1e-9


def test_record_hash_null_sentinel(spark):
    df = spark.createDataFrame([("a", None), ("a", "")], "x string, y string")
    h = col_values(df.select(C.record_hash("x", "y")), 0)
    bare = col_values(df.select(F.xxhash64("x", "y")), 0)
    assert h[0] != h[1]                      # NULL differs from ''
    assert bare[0] == spark.range(1).select(F.xxhash64(F.lit("a"))).first()[0]   # why the sentinel


def test_week_bucket_edges(spark):
    edges = [("2013-12-01", "2013-12-08"), ("2013-12-09", "2013-12-15"),
             ("2013-12-16", "2013-12-22"), ("2013-12-23", "2013-12-31")]
    days = ["2013-11-30 23:59:00", "2013-12-08 23:59:00", "2013-12-09 00:00:00", "2013-12-15 12:00:00",
            "2013-12-16 00:00:00", "2013-12-22 23:00:00", "2013-12-23 00:00:00", "2013-12-31 23:59:00",
            "2014-01-01 00:00:00"]
    df = spark.createDataFrame([(d,) for d in days], "s string").select(
        F.col("s").cast("timestamp_ntz").alias("ts"))
    assert col_values(df.select(C.week_bucket("ts", edges)), 0) == [None, 1, 2, 2, 3, 3, 4, 4, None]


def test_name_initial_and_sentence(spark):
    df = spark.createDataFrame([("Ann", "Doctor"), ("Bo", None)], "name string, occupation string")
    assert col_values(df.select(C.name_initial("name", "occupation")), 0) == ["Ann(D)", "Bo()"]
    df2 = spark.createDataFrame([(3, "Doctor"), (2, None)], "cnt long, occupation string")
    assert col_values(df2.select(C.count_sentence("cnt", "occupation")), 0) == [
        "There are a total of 3 doctors.", "There are a total of 2 s."]


def test_ratio_zero_denominator(spark):
    df = spark.createDataFrame([(1, 4), (1, 0)], "a long, b long")
    assert col_values(df.select(C.ratio("a", "b")), 0) == [0.25, None]


def test_day_window_start(spark):
    df = spark.createDataFrame([("2024-03-01 13:45:00",)], "s string").select(
        F.col("s").cast("timestamp_ntz").alias("ts"))
    got = df.select(C.day_window_start("ts")).first()[0]
    assert got.replace(tzinfo=None) == dt.datetime(2024, 2, 29, 0, 0)


def test_size_conf_and_buckets():
    from wharf.session import MB, bucket_count, size_conf
    tb = 1024 ** 4
    conf = size_conf(100 * tb)
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * tb // (256 * MB)
    assert bucket_count(10 * tb) == 32768 and bucket_count(1) == 8
    assert bucket_count(10 * tb) * 512 * MB >= 10 * tb
