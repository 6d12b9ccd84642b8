import datetime as dt

from pyspark.sql import functions as F

from wharf.operators import aggregates as agg
from wharf.operators import checks as chk
from wharf.operators import windows as win
from wharf.operators.pivot import pivot_days
from tests import goods_fixture as gen

D = dt.date


def test_prev_days_count_edges(spark):
    rows = [(1, "a", D(2023, 1, 10)), (2, "a", D(2023, 1, 10)),   # same day: not counted
            (3, "a", D(2023, 1, 9)),                                # d-1 (sees 01-02 and 01-03)
            (4, "a", D(2023, 1, 3)),                                # d-7
            (5, "a", D(2023, 1, 2)),                                # d-8: outside
            (6, None, D(2023, 1, 10)), (7, None, D(2023, 1, 9)),   # NULL user → 0
            (8, "a", None)]                                         # NULL date → 0, not counted
    tx = spark.createDataFrame(rows, "transaction_id int, user_id string, date date")
    got = {r["transaction_id"]: r["trans_prev_7d"] for r in win.prev_days_count(tx, "user_id", "date").collect()}
    assert got == {1: 2, 2: 2, 3: 2, 4: 1, 5: 0, 6: 0, 7: 0, 8: 0}


def brute_prev7(rows):
    out = {}
    for tid, u, d in rows:
        out[tid] = 0 if u is None or d is None else sum(
            1 for _, u2, d2 in rows if u2 == u and d2 is not None and 1 <= (d - d2).days <= 7)
    return out


def test_prev_days_count_matches_brute_force(spark):
    import random
    rnd = random.Random(7)
    rows = [(i, rnd.choice(["a", "b", "c", None]), D(2023, 1, 1) + dt.timedelta(days=rnd.randint(0, 40)))
            for i in range(400)]
    tx = spark.createDataFrame(rows, "transaction_id int, user_id string, date date")
    got = {r[0]: r[1] for r in win.prev_days_count(tx, "user_id", "date")
           .select("transaction_id", "trans_prev_7d").collect()}
    assert got == brute_prev7(rows)


def test_compact_dim(spark):
    rows = [("A", D(2020, 1, 1), 1, "x", None), ("A", D(2020, 2, 1), 1, "x", ""),    # NULL ≡ '' → merged
            ("A", D(2020, 3, 1), 2, "x", ""),                                          # B
            ("A", D(2020, 5, 1), 1, "x", ""),                                          # back to A, after a gap
            ("B", D(2021, 1, 1), 5, "a/b", "c"), ("B", D(2021, 6, 1), 5, "a", "b/c"),  # '/' values differ
            ("C", D(2022, 1, 1), 9, "z", "z")]                                         # single row
    df = spark.createDataFrame(rows, "agrmnt_id string, actual_from_dt date, client_id int, "
                                     "product_id string, interest_rate string")
    out = win.compact_dim(df, "agrmnt_id", ["client_id", "product_id", "interest_rate"], "actual_from_dt")
    got = sorted((r[0], r[1], r[2], r[3]) for r in out.collect())
    assert got == [
        ("A", D(2020, 1, 1), D(2020, 2, 29), 1), ("A", D(2020, 3, 1), D(2020, 4, 30), 2),
        ("A", D(2020, 5, 1), D(9999, 12, 31), 1),
        ("B", D(2021, 1, 1), D(2021, 5, 31), 5), ("B", D(2021, 6, 1), D(9999, 12, 31), 5),
        ("C", D(2022, 1, 1), D(9999, 12, 31), 9)]


def test_top1_with_ties(spark):
    ts = lambda s: dt.datetime.fromisoformat(s)
    rows = [(1, 1, ts("2013-12-08 10:00:00"), 2), (2, 1, ts("2013-12-08 09:00:00"), 1),
            (3, 1, ts("2013-12-08 09:00:00"), 1),   # equal (date, rate, time): lowest id wins
            (4, 1, ts("2013-12-09 00:00:00"), 3)]   # next bucket
    df = spark.createDataFrame(rows, "id int, id_good int, s_date timestamp_ntz, rate int")
    df = df.withColumn("wk", F.when(F.to_date("s_date") <= F.lit("2013-12-08").cast("date"), 1).otherwise(2))
    top = win.top1_per_group(df, ["wk", "id_good"], [F.to_date("s_date").desc(), F.col("rate"),
                                                      F.col("s_date").desc(), F.col("id")])
    assert sorted(r["id"] for r in top.collect()) == [2, 4]


def test_latest_per_group(spark):
    df = spark.createDataFrame([("u", 1, "a"), ("u", 3, "c"), ("u", 2, "b"), ("v", 1, "z")],
                               "k string, t int, p string")
    got = sorted(tuple(r) for r in win.latest_per_group(df, ["k"], ["t"], ["p"]).collect())
    assert got == [("u", 3, "c"), ("v", 1, "z")]


def test_occupations(spark):
    rows = [("Zed", "Actor"), ("Amy", "Actor"), ("Kim", "Actor"), ("Lou", "Actor"),
            ("Bea", "Doctor"), ("Cal", "Doctor"), ("Dee", "Doctor"),
            ("Eli", "Professor"), ("Fay", "Professor"), ("Gus", "Professor"), ("Hal", "Professor"),
            ("Ida", "Professor"), ("Jo", "Professor"), ("Kai", "Professor"),
            ("Max", "Singer"), ("Ned", "Singer"), ("Oli", "Singer"), ("Pam", "Singer"), ("Quin", None)]
    df = spark.createDataFrame(rows, "name string, occupation string")
    counts = [(r["occupation"], r["cnt"]) for r in agg.occupation_counts(df).collect()]
    # NULL sorts first in Spark; Actor/Singer tie on 4 and go alphabetically
    assert counts == [(None, 1), ("Doctor", 3), ("Actor", 4), ("Singer", 4), ("Professor", 7)]


def test_period_totals_generated(spark):
    d = gen.dims(spark)
    sales = gen.gen_sales(spark).withColumn("amount_cents", (F.col("amount") * 100).cast("bigint"))
    out = agg.period_totals(d["ref_goods"], sales, "2016-02-29").collect()
    by_name = {r["good_name"]: r for r in out}
    # two goods share a name: rows stay distinct by (name, totals)
    assert len(out) == 7
    # brute force for one good
    rows = [(r["id_good"], r["s_date"], r["amount"]) for r in gen.gen_sales(spark).collect()]
    a = D(2016, 2, 29)
    p = D(2015, 2, 28)
    def tot(cond):
        return float(sum(am for g, t, am in rows if g == 4 and cond(t.date())))
    good = by_name["Espresso"]
    assert good["YTD"] == tot(lambda x: x.year == 2016 and x <= a)
    assert good["MTD"] == tot(lambda x: x.year == 2016 and x.month == 2 and x <= a)
    assert good["PQTD"] == tot(lambda x: x.year == 2015 and (x.month - 1) // 3 == 0 and x <= p)
    # a date after the data gives zeros
    late = agg.period_totals(d["ref_goods"], sales, "2019-06-01").collect()
    assert all(r["YTD"] == 0 and r["PYTD"] == 0 for r in late)


def test_pivot_days_missing_day(spark):
    rows = [("pen", D(2016, 12, 31), 5), ("pen", D(2017, 1, 2), 7), ("ink", D(2017, 1, 2), 1)]
    daily = spark.createDataFrame(rows, "good_name string, dat date, sum_amount long")
    out = pivot_days(daily, "good_name", "dat", "sum_amount", "2016-12-31", "2017-01-03")
    assert out.columns == ["good_name", "2016-12-31", "2017-01-02"]   # only days present
    got = {r["good_name"]: (r["2016-12-31"], r["2017-01-02"]) for r in out.collect()}
    assert got == {"pen": (5, 7), "ink": (0, 1)}


def test_category_totals_semi_join(spark):
    users = spark.createDataFrame([(1,), (1,), (2,)], "user_id int")          # duplicated user
    tx = spark.createDataFrame([(1, "c1", 10), (2, "c1", 5), (3, "c1", 100), (1, "c2", 1)],
                               "user_id int, transaction_category_id string, transaction_amount long")
    got = [tuple(r) for r in agg.category_totals(tx, users).collect()]
    assert got == [("c1", 15, 2), ("c2", 1, 1)]                              # unknown user 3 out


def test_spender_conversion_null_user(spark):
    rows = [("IOS", "u1", True), ("IOS", "u1", True), ("IOS", "u2", False), ("IOS", None, True)]
    df = spark.createDataFrame(rows, "platform string, user_id string, spender boolean")
    r = agg.spender_conversion(df, "platform", "user_id", "spender").first()
    assert (r["user_id_count"], r["spender_users_count"]) == (2, 2)         # NULL adds to sum only


def test_profile_and_constant_columns(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "x", 1), ("a", None, 1)], "c1 string, c2 string, c3 int")
    p = agg.profile(df, ["c1", "c2", "c3"]).first()
    assert (p["rows_count"], p["c1_distinct_count"], p["c2_distinct_count"]) == (3, 1, 2)
    const = sorted(r[0] for r in agg.constant_columns(agg.profile(df, ["c1", "c2", "c3"])).collect())
    assert const == ["c1", "c3"]


def test_run_checks(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    df = spark.createDataFrame([(1, "A", 1), (1, "B", 2), (None, "C", 3), (2, None, 9), (3, "A", None)],
                               "k int, state string, pid int")
    out = {(r["rule"], r["column"]): r["failing_rows"] for r in chk.run_checks(spark, df, [
        chk.NotNull(["k", "state"]), chk.Unique(["k"]), chk.AcceptedValues("state", ["A", "B"]),
        chk.Relationship("pid", parent, "id"), chk.Expect("pid_small", F.col("pid") < 5)]).collect()}
    assert out == {("not_null", "k"): 1, ("not_null", "state"): 1, ("unique", "k"): 1,
                   ("accepted_values", "state"): 1, ("relationships", "pid"): 2,
                   ("expect", "pid_small"): 2}


def test_match_counts_and_reconcile(spark):
    left = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (3,), (4,)], "k int")
    r = chk.match_counts(left, right, "k").first()
    assert (r["total_rows"], r["matched_rows"]) == (3, 2)
    rec = chk.reconcile([("t", left, right)]).first()
    assert (rec["source_count"], rec["target_count"], rec["counts_match"]) == (3, 4, False)


def test_period_totals_good_without_sales(spark):
    goods = spark.createDataFrame([(1, "Pen"), (2, "Unsold")], "id int, good_name string")
    sales = spark.createDataFrame([(1, dt.datetime(2016, 2, 29, 10), 500)],
                                  "id_good int, s_date timestamp_ntz, amount_cents long")
    got = {r["good_name"]: (r["YTD"], r["MTD"], r["PYTD"]) for r in agg.period_totals(goods, sales, "2016-02-29").collect()}
    assert got == {"Pen": (5.0, 5.0, 0.0), "Unsold": (0.0, 0.0, 0.0)}
    # as_of 2017-02-28: a year back is 2016-02-28, so the 29 Feb sale is outside PYTD
    got2 = {r["good_name"]: r["PYTD"] for r in agg.period_totals(goods, sales, "2017-02-28").collect()}
    assert got2["Pen"] == 0.0


def test_control_diff(spark):
    before = spark.createDataFrame([(1, 100), (2, 250)], "id int, cents long")
    after = spark.createDataFrame([(1, 100), (2, 249)], "id int, cents long")
    got = {r["metric"]: (r["before_value"], r["after_value"], r["matches"])
           for r in chk.control_diff(before, after, ["cents"]).collect()}
    assert got == {"rows_count": (2, 2, True), "cents_sum": (350, 349, False)}


def test_load_with_totals_observes_during_write(spark, tmp_dir):
    df = spark.createDataFrame([(1, 100), (2, 250), (3, None)], "id int, cents long")
    before = chk.load_with_totals(df, f"{tmp_dir}/t", ["cents"])
    assert before == {"rows_count": 3, "cents_sum": 350}
    got = {r["metric"]: r["matches"] for r in
           chk.control_diff_loaded(spark, before, spark.read.parquet(f"{tmp_dir}/t"), ["cents"]).collect()}
    assert got == {"rows_count": True, "cents_sum": True}


def test_profile_approx_option(spark):
    df = spark.range(2000).select((F.col("id") % 500).alias("a"), F.lit("x").alias("b"))
    exact = agg.profile(df, ["a", "b"]).first()
    approx = agg.profile(df, ["a", "b"], approx=True).first()
    assert exact["a_distinct_count"] == 500 and approx["b_distinct_count"] == 1
    assert abs(approx["a_distinct_count"] - 500) <= 25          # HyperLogLog, default 5 % error


def test_orders_put_missing_keys_where_the_reports_do(spark):
    from wharf.plans.reports import names_then_counts
    occ = spark.createDataFrame([("z", "b"), ("y", "B"), ("x", None), ("w", "c"), ("v", "c")], "name string, occupation string")
    assert [(r["cnt"], r["occupation"]) for r in agg.occupation_counts(occ).collect()] == [
        (1, "B"), (1, "b"), (1, None), (2, "c")]
    lines = [r["result"] for r in names_then_counts(occ).collect()]
    assert lines[:5] == ["v(c)", "w(c)", "x()", "y(B)", "z(b)"] and lines[-1] == "There are a total of 2 cs."


def test_profile_of_empty_table_and_nulls(spark):
    empty = agg.profile(spark.createDataFrame([], "a int, b string"), ["a", "b"]).first()
    assert empty.asDict() == {"rows_count": 0, "a_distinct_count": 0, "b_distinct_count": 0}
    df = spark.createDataFrame([(1, None), (1, None), (None, "x")], "a int, b string")
    assert agg.profile(df, ["a", "b"]).first().asDict() == {
        "rows_count": 3, "a_distinct_count": 2, "b_distinct_count": 2}


def test_profile_does_not_expand(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert "Expand" not in agg.profile(df, ["a", "b"])._jdf.queryExecution().executedPlan().toString()


def test_money_sum_rounds_the_total_alone(spark):
    rows = [("a", 0.0000004)] * 1000 + [("a", 0.1)] * 3 + [("a", None), ("b", None), ("c", -2.5), ("c", 12345678.9)]
    out = spark.createDataFrame(rows, "k string, x double").groupBy("k").agg(agg.money_sum("x", "s"))
    assert {r["k"]: r["s"] for r in out.collect()} == {"a": 0.3004, "b": None, "c": 12345676.4}
