import datetime as dt
import os

from pyspark.sql import functions as F

from wharf.sources import documents as docs
from wharf.sources import events as ev
from wharf.sources import files as fs
from tests import goods_fixture as gen

FIELDS = ["session_id", "user_id", "event_timestamp", "platform", "is_premium", "user_is_spender",
          "real_currency_amount", "real_currency_type", "usd_cost", "player_name"]
TYPES = {"event_timestamp": "timestamp_ntz", "is_premium": "boolean", "user_is_spender": "boolean"}
MONEY = {"real_currency_amount": "real_currency_amount_centum", "usd_cost": "usd_cost_centum"}

RAW = """[{'session_id': 's1', 'user_id': 'u1', 'event_timestamp': '2019-02-03 10:11:12', 'platform': 'IOS', 'is_premium': False, 'user_is_spender': True, 'real_currency_amount': '4,99', 'real_currency_type': 'EUR', 'usd_cost': '4,99', 'player_name': 'abc'},
{'session_id': 's2', 'user_id': , 'event_timestamp': '2019-02-03 10:11:13', 'platform': 'ANDROID', 'is_premium': False, 'user_is_spender': False, 'real_currency_amount': 19.99, 'real_currency_type': 'USD', 'usd_cost': 19.99, 'player_name': 'd'},
{'session_id': NULL, 'user_id': 'u3', 'event_timestamp': 'yesterday', 'platform': 'IOS', 'is_premium': False, 'user_is_spender': False, 'player_name': 'O'Neil'},
{'session_id': 's4', 'user_id': 'u4', 'event_timestamp': '2019-02-04 00:00:00', 'platform': 'IOS', 'is_premium': True, 'user_is_spender': True, 'real_currency_amount': '0.99', 'real_currency_type': '', 'usd_cost': '0.99', 'player_name': 'Mr True'},
{'session_id': 's5', 'user_id': 'u5', 'event_timestamp': '2019-02-04 00:00:01', 'platform': 'IOS', 'is_premium': False, 'user_is_spender': False, 'real_currency_amount': 'abc', 'player_name': 'x},
{'session_id': 's6', 'user_id': 'u6', 'event_timestamp': '2019-02-04 00:00:02', 'platform': 'IOS', 'is_premium': False, 'user_is_spender': False, 'real_currency_amount': '1,5', 'player_name': 'he said "hi"'}]
"""


def _write(tmp_dir, name, text, mode="w"):
    p = os.path.join(tmp_dir, name)
    with open(p, mode) as f:
        f.write(text)
    return p


def test_read_events_repairs_and_types(spark, tmp_dir):
    path = _write(tmp_dir, "events.txt", RAW)
    df = ev.read_events(spark, path, FIELDS, TYPES, MONEY)
    rows = {r["session_id"]: r for r in df.collect()}
    assert len(df.collect()) == 5                       # the broken line is not in the typed rows
    r1 = rows["s1"]
    assert r1["real_currency_amount_centum"] == 499 and r1["usd_cost_centum"] == 499
    assert r1["event_timestamp"] == dt.datetime(2019, 2, 3, 10, 11, 12)
    assert r1["is_premium"] is False and r1["user_is_spender"] is True
    r2 = rows["s2"]
    assert r2["user_id"] is None                        # 'user_id': ,  → NULL
    assert r2["real_currency_amount_centum"] == 1999    # decimal, not float truncation
    r3 = rows[None]
    assert r3["player_name"] == "O'Neil"                # apostrophe inside a value survives
    assert r3["event_timestamp"] is None                # unreadable time → NULL
    assert r3["real_currency_amount_centum"] == 0       # missing amount → 0
    r4 = rows["s4"]
    assert r4["player_name"] == "Mr True"               # the word True inside a value survives
    assert r4["real_currency_type"] == ""               # empty string is not NULL
    assert r4["is_premium"] is True
    assert rows["s6"]["player_name"] == 'he said "hi"'  # double quotes inside a value
    assert rows["s6"]["real_currency_amount_centum"] == 150


def test_text_that_looks_like_structure_survives(spark, tmp_dir):
    notes = ["ratio 3:, ok", "flag: True, yes", "see: NULL}", 'say "k": None, x', "it's, fine", "a: False}"]
    lines = ["["] + ["{'session_id': '%d', 'note': '%s', 'user_id': },"  % (i, n) for i, n in enumerate(notes)] + ["", "]"]
    path = _write(tmp_dir, "notes.txt", "\n".join(lines))
    got = {r["session_id"]: (r["note"], r["user_id"]) for r in ev.read_events(
        spark, path, ["session_id", "note", "user_id"], {}, {}).collect()}
    assert got == {str(i): (n, None) for i, n in enumerate(notes)}


def test_lines_without_a_record_are_reported(spark, tmp_dir):
    path = _write(tmp_dir, "lost.txt", "[\n{'session_id': 'a'},\nlost line\n], \n  \n42\n]\n")
    raw = ev.parse_events(ev.read_lines(spark, path), ["session_id"])
    assert ev.type_events(raw, {}, {}).count() == 1
    assert [r["problem"] for r in ev.problem_rows(raw, {}, {}, "session_id").collect()] == ["unparseable record"] * 2


def test_problem_report(spark, tmp_dir):
    path = _write(tmp_dir, "events.txt", RAW)
    raw = ev.parse_events(ev.read_lines(spark, path), FIELDS)
    probs = {(r["session_id"], r["problem"]) for r in ev.problem_rows(raw, TYPES, MONEY, "session_id").collect()}
    assert ("s5", "unparseable record") in probs
    assert (None, "unreadable event_timestamp") in probs
    assert len(probs) == 2


def test_records_spanning_lines(spark, tmp_dir):
    text = ("[{'session_id': 'a',\n 'user_id': 'u1'},\n"
            "{'session_id': 'b',\n 'user_id': ,\n 'is_premium': True}]\n")
    path = _write(tmp_dir, "multi.txt", text)
    df = ev.read_events(spark, path, ["session_id", "user_id", "is_premium"], {"is_premium": "boolean"},
                        {}, record_sep="},")
    got = sorted((r["session_id"], r["user_id"], r["is_premium"]) for r in df.collect())
    assert got == [("a", "u1", None), ("b", None, True)]


def test_undecodable_bytes_ignored(spark, tmp_dir):
    data = "{'session_id': 'a\xff\xfeb', 'user_id': 'u'}\n".encode("latin-1")
    path = _write(tmp_dir, "bad.txt", data, "wb")
    df = ev.read_events(spark, path, ["session_id", "user_id"], {}, {})
    assert [r["session_id"] for r in df.collect()] == ["ab"]


def _hour(t, **extra):
    base = {"time": t, "temperature": 1.5, "summary": "Clear", "icon": "clear-day"}
    base.update(extra)
    return base


def test_flatten_hourly(spark):
    import json
    day = 1_546_300_800   # 2019-01-01 00:00:00 UTC
    full = {"latitude": 52.5, "longitude": 13.4,
            "hourly": {"summary": "x", "data": [_hour(day + 3600 * h, precipType="rain") for h in range(24)]}}
    lacking = {"hourly": {"data": [{"time": day}]}}
    empty = {"hourly": {"data": []}}
    rows = [(1, json.dumps(full)), (2, json.dumps(lacking)), (3, json.dumps(empty)), (4, json.dumps(full))]
    df = spark.createDataFrame(rows, "doc_no int, value string")
    flat = docs.flatten_hourly(docs.parse_documents(df, keep=["doc_no"]), keep=["doc_no"])
    counts = {r["doc_no"]: r["count"] for r in flat.groupBy("doc_no").count().collect()}
    assert counts == {1: 24, 2: 1, 4: 24}                 # empty array → no rows; same day twice kept
    r = flat.where("doc_no = 2").first()
    assert r["temperature"] is None and r["timestamp"] == dt.datetime(2019, 1, 1)
    assert flat.where("doc_no = 1").agg(F.max("timestamp")).first()[0] == dt.datetime(2019, 1, 1, 23)


def test_read_csv_by_header_name(spark, tmp_dir):
    path = _write(tmp_dir, "tx.csv", "USER_ID,Transaction_Amount,is_blocked\n1,0.1,False\n1,0.2,False\n")
    df = fs.read_csv(spark, path, {"is_blocked": "string", "user_id": "bigint",
                                   "transaction_amount": "decimal(18,2)"})
    assert df.columns == ["is_blocked", "user_id", "transaction_amount"]
    total = df.agg(F.sum("transaction_amount")).first()[0]
    assert str(total) == "0.30"                           # exact, not 0.30000000000000004


def test_read_seed_keeps_json(spark, tmp_dir):
    path = _write(tmp_dir, "seed.csv",
                  'external_ref,rates\nA1,"{""EUR"":0.9,""USD"":1}"\n')
    r = fs.read_seed(spark, path).first()
    assert r["rates"] == '{"EUR":0.9,"USD":1}'


def test_generators(spark):
    assert gen.amount_period() == 4731
    sales = gen.gen_sales(spark)
    docs_ = gen.gen_docs(spark)
    assert sales.count() == 11136 and docs_.count() == 73008
    first = sales.orderBy("id").first()
    assert first["s_date"] == dt.datetime(2012, 1, 1) and str(first["amount"]) == "15.12"
    row = sales.where("id = 4731").first()            # last value of the first cycle
    assert str(row["amount"]) == "100007.32"
    assert str(sales.where("id = 4732").first()["amount"]) == "15.12"
    assert sales.agg(F.max("s_date")).first()[0] < dt.datetime(2017, 1, 30)
    d = docs_.where("id = 5").first()
    assert (d["id_good"], d["id_doc_type"], d["rate"]) == (5, 2, 2)
    dims = gen.dims(spark)
    assert dims["ref_goods"].count() == 7
    assert dims["ref_goods"].select("good_name").distinct().count() == 6   # two goods share a name


def test_escaped_and_unclosed_quotes(spark, tmp_dir):
    lines = [r"{'id': 'a', 'note': 'say \"hi\"'},", r"{'id': 'b', 'note': 'C:\\new \u00e9'},", "{'id': 'c', 'note': 'open, 'n': 'x'},",
             "{'id': 'd', 'note': abc},", "{'id': 'e', 'note': -1.5e3, 'n': None},", "{'id': 'g', 'note': 'x'",
             "{},", "{'id': 'h', 'id': 'i', 'note': ''}", "{'id': 'j', 'note': '" + "long, " * 20_000 + "'}"]
    path = _write(tmp_dir, "quotes.txt", "\n".join(lines))
    raw = ev.parse_events(ev.read_lines(spark, path), ["id", "note"])
    got = {r["id"]: r["note"] for r in ev.type_events(raw, {}, {}).collect()}
    assert got == {"a": 'say "hi"', "b": "C:\\new é", "e": "-1.5e3", None: None, "i": "", "j": "long, " * 20_000}
    bad = sorted(r["id"] for r in ev.problem_rows(raw, {}, {}, "id").collect())
    assert bad == ["c", "d", "g"]
