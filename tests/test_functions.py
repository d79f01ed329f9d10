from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from sessionscope.functions import timefmt
from sessionscope.functions.numbers import ratio_half_up
from sessionscope.functions.records import record_field
from sessionscope.functions.timefmt import (
    date_hour, date_key, minute_key, parse_action_time, parse_date_key, time_after, time_before,
)


def binary_half_up(k: int, n: int) -> float:
    """Half-up to two places applied to the binary double k / n."""
    return float(Decimal(k / n).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


def test_ratio_matches_binary_half_up_for_all_small_pairs(spark):
    pairs = (spark.range(1, 401).withColumnRenamed("id", "n")
             .crossJoin(spark.range(0, 401).withColumnRenamed("id", "k"))
             .where("k <= n"))
    got = pairs.select("k", "n", ratio_half_up("k", "n").alias("r")).collect()
    assert len(got) == sum(n + 1 for n in range(1, 401))
    bad = [(r.k, r.n, r.r) for r in got if r.r != binary_half_up(r.k, r.n)]
    assert bad == []


def test_ratio_examples(spark):
    df = spark.createDataFrame([(3, 40), (1, 200), (0, 0), (5, 0), (1, 3), (2, 3)], "k long, n long")
    got = [r.r for r in df.select(ratio_half_up("k", "n").alias("r")).collect()]
    # 3/40 = 0.075 is stored just below 0.075, so it rounds down
    assert got == [0.07, 0.01, None, None, 0.33, 0.67]


def test_parse_action_time(spark):
    df = spark.createDataFrame([("2024-01-01 5:03:04",), ("2024-01-01 05:03:04",), ("2024-01-01 15:61:04",),
                                ("junk",), (None,)], "s string")
    got = [r.t for r in df.select(F.date_format(parse_action_time(F.col("s")), "yyyy-MM-dd HH:mm:ss").alias("t")).collect()]
    assert got == ["2024-01-01 05:03:04", "2024-01-01 05:03:04", None, None, None]


def test_time_keys(spark):
    df = spark.createDataFrame([("2024-01-02 5:03:04",)], "s string").select(parse_action_time(F.col("s")).alias("t"))
    row = df.select(date_hour(F.col("t")).alias("h"), date_key(F.col("t")).alias("d"),
                    minute_key(F.col("t")).alias("m"),
                    parse_date_key(date_key(F.col("t"))).alias("back"),
                    parse_date_key(F.lit("2024-13-45")).alias("bad")).first()
    assert (row.h, row.d, row.m) == ("2024-01-02_05", "20240102", "202401020503")
    assert str(row.back) == "2024-01-02" and row.bad is None


def test_before_after_are_false_on_unknown(spark):
    df = spark.createDataFrame([("2024-01-01 1:00:00", "2024-01-01 2:00:00"), ("junk", "2024-01-01 2:00:00")],
                               "a string, b string")
    a, b = parse_action_time(F.col("a")), parse_action_time(F.col("b"))
    got = [(r.x, r.y) for r in df.select(time_before(a, b).alias("x"), time_after(a, b).alias("y")).collect()]
    assert got == [(True, False), (False, False)]


def test_record_field(spark):
    rec = "sessionid=s1|searchKeywords=|age=31|city=a=b|sex=|sex=male|age=40|junk|professional=x|"
    df = spark.createDataFrame([(rec,), (None,)], "r string")
    cols = {f: record_field(F.col("r"), f).alias(f) for f in
            ["sessionid", "searchKeywords", "age", "city", "sex", "missing", "junk", "professional"]}
    got = df.select(*cols.values()).collect()
    # empty values, values holding "=" and parts without "=" never count;
    # the first readable part of a field wins
    assert got[0].asDict() == {"sessionid": "s1", "searchKeywords": None, "age": "31", "city": None,
                               "sex": "male", "missing": None, "junk": None, "professional": "x"}
    assert all(v is None for v in got[1].asDict().values())


def test_today_and_yesterday(spark):
    import datetime as dt

    from sessionscope.functions.timefmt import today, yesterday
    row = spark.range(1).select(today().alias("t"), yesterday().alias("y")).first()
    t = dt.date.fromisoformat(row.t)
    assert dt.date.fromisoformat(row.y) == t - dt.timedelta(days=1)


def test_decode_sessions_agrees_with_record_field(spark):
    from sessionscope.functions.records import SESSION_RECORD_FIELDS, decode_sessions
    recs = ["sessionid=s1|searchKeywords=|age=31|city=a=b|sex=|sex=male|age=40|junk|professional=x|",
            "age=7", "", "visitLength=12|stepLength=3|clickCategoryIds=1,2|city=|city=c", None,
            "|sessionid=|sessionid=z=|sessionid=ok"]
    df = spark.createDataFrame([(r,) for r in recs], "record string")
    got = [r.asDict() for r in decode_sessions(df).collect()]
    want = [r.asDict() for r in df.select(*[
        record_field(F.col("record"), f).try_cast(t).alias(c)
        for f, (c, t) in SESSION_RECORD_FIELDS.items()]).collect()]
    assert got == want
    assert got[0]["age"] == 31 and got[0]["city"] is None and got[5]["session_id"] == "z"


def test_record_field_trailing_equals_and_set_field(spark):
    from sessionscope.functions.records import set_record_field
    df = spark.createDataFrame([("a=1|b=2=|c==3|a=9",), ("x=1",), (None,)], "r string")
    row = df.select(record_field(F.col("r"), "b").alias("b"), record_field(F.col("r"), "c").alias("c"),
                    set_record_field(F.col("r"), "a", F.lit(5)).alias("s1"),
                    set_record_field(F.col("r"), "zz", F.lit(5)).alias("s2")).collect()
    assert (row[0].b, row[0].c) == ("2", None)          # "b=2=" reads 2, "c==3" is unreadable
    assert row[0].s1 == "a=5|b=2=|c==3|a=9"             # only the first part named a
    assert row[0].s2 == "a=1|b=2=|c==3|a=9"             # unknown field: unchanged
    assert row[1].s1 == "x=1" and row[2].s1 is None


def test_times_do_not_depend_on_the_session_zone(spark):
    """A wall-clock time in the daylight-saving gap stays what it says."""
    from sessionscope.functions.timefmt import date_hour, format_action_time, format_time, seconds_between
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([("2024-03-10 1:30:00", "2024-03-10 2:30:05")], "a string, b string")
        a, b = parse_action_time(F.col("a")), parse_action_time(F.col("b"))
        row = df.select(format_time(b).alias("t"), format_action_time(b).alias("r"), date_hour(b).alias("h"),
                        seconds_between(a, b).alias("d")).first()
        assert (row.t, row.r, row.h, row.d) == ("2024-03-10 02:30:05", "2024-03-10 2:30:05", "2024-03-10_02", 3605)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_ratio_at_cluster_sized_counts(spark):
    import random
    rnd = random.Random(7)
    pairs = []
    for _ in range(1500):                    # arbitrary quotients
        n = rnd.randint(1, 10**12)
        pairs.append((rnd.randint(0, n), n))
    for _ in range(1500):                    # exact midpoints (2m+1)/200, scaled
        m, t = rnd.randint(0, 99), rnd.randint(1, 5 * 10**9)
        pairs.append(((2 * m + 1) * t, 200 * t))
    df = spark.createDataFrame(pairs, "k long, n long")
    got = df.select("k", "n", ratio_half_up("k", "n").alias("r")).collect()
    bad = [(r.k, r.n, r.r) for r in got if r.r != binary_half_up(r.k, r.n)]
    assert bad == []


@pytest.mark.parametrize("text,value", [
    ("2024-01-01 15:01:04", "2024-01-01 15:01:04"), ("2024-01-01 15:01:04.123", "2024-01-01 15:01:04"),
    ("2024-1-1 5:3:4", "2024-01-01 05:03:04"), ("2024-01-01 5:03:04.999999", "2024-01-01 05:03:04"),
    ("2024-01-01 05:61:04", None), ("2024-13-01 05:01:04", None), ("2024-01-01", None), ("", None), ("junk", None),
    (None, None)])
def test_action_times_as_logs_write_them(spark, text, value):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(timefmt.format_time(timefmt.parse_action_time(F.col("t"))).alias("t")).first().t == value
