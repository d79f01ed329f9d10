"""Random small logs against a plain-Python computation of the same results."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fixtures import actions_df, user, users_df
from sessionscope.functions.buckets import STEP_BUCKETS, VISIT_BUCKETS
from sessionscope.operators.flow import page_flow_conversion
from sessionscope.plans.job import session_stats
from sessionscope.sources.tasks import TaskParams

BASE = dt.datetime(2024, 1, 1, 0, 0, 0)

action_rows = st.lists(
    st.tuples(st.integers(0, 5),            # session number
              st.integers(0, 2000),         # seconds after midnight
              st.sampled_from([None, "", "a", "b", "ab"]),
              st.sampled_from([None, 1, 10, 11]),
              st.integers(0, 3)),           # page
    min_size=0, max_size=40)


def _raw(rows):
    out = []
    for s, secs, kw, cat, page in rows:
        t = BASE + dt.timedelta(seconds=secs)
        out.append(("2024-01-01", s % 3, f"s{s}", page, f"{t:%Y-%m-%d} {t.hour}:{t:%M:%S}", kw, cat,
                    None, None, None, None, None))
    return out


def _round(k, n):
    return float(Decimal(k / n).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)) if n else None


def _brute_stats(rows, keywords, sexes):
    sessions = {}
    for s, secs, kw, cat, page in rows:
        d = sessions.setdefault(s, {"times": [], "kws": set(), "user": s % 3})
        d["times"].append(secs)
        if kw:
            d["kws"].add(kw)
    kept = [d for d in sessions.values()
            if (not keywords or d["kws"] & set(keywords)) and (sexes is None or
                                                              ("male" if d["user"] != 1 else "female") == sexes)]
    n = len(kept)
    visit = [max(d["times"]) - min(d["times"]) for d in kept]
    steps = [len(d["times"]) for d in kept]

    def inb(v, b):
        return v >= b.low and (b.high is None or v <= b.high)

    out = {"session_count": n}
    out.update({f"visit_length_{b.name}_ratio": _round(sum(inb(v, b) for v in visit), n) for b in VISIT_BUCKETS})
    out.update({f"step_length_{b.name}_ratio": _round(sum(inb(v, b) for v in steps), n) for b in STEP_BUCKETS})
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=action_rows, keywords=st.sampled_from([None, ("a",), ("ab", "b")]),
       sex=st.sampled_from([None, "male", "female"]))
def test_session_stats_match_brute_force(spark, rows, keywords, sex):
    acts = actions_df(spark, _raw(rows))
    users = users_df(spark, [user(0), user(1, sex="female"), user(2)])
    p = TaskParams.of("2024-01-01", "2024-01-01", keywords=",".join(keywords) if keywords else None, sex=sex)
    got = session_stats(acts, users, p).first().asDict()
    got.pop("task_id")
    assert got == _brute_stats(rows, keywords, sex)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=action_rows, flow=st.lists(st.integers(0, 3), min_size=2, max_size=4))
def test_page_flow_matches_brute_force(spark, rows, flow):
    acts = actions_df(spark, _raw(rows))
    got = {r.step: (r.transitions, r.base, r.conversion_rate)
           for r in page_flow_conversion(acts, flow, max_rows=3).collect()}
    # brute force: order each session by (time, ordinal of the action) and count pairs
    by_session = {}
    for s, secs, kw, cat, page in rows:
        by_session.setdefault(s, []).append((secs, page))
    # ties on time are broken by the action id, a hash of the row; pairs are then
    # ambiguous, so only sessions with distinct times are compared exactly
    if any(len({t for t, _ in v}) != len(v) for v in by_session.values()):
        return
    seqs = [[p for _, p in sorted(v)] for v in by_session.values()]
    views = sum(p == flow[0] for seq in seqs for p in seq)
    trans = [sum(1 for seq in seqs for x, y in zip(seq, seq[1:]) if (x, y) == (a, b))
             for a, b in zip(flow, flow[1:])]
    expect = {}
    for i, t in enumerate(trans, start=1):
        base = views if i == 1 else trans[i - 2]
        expect[i] = (t, base, _round(t, base))
    assert got == expect


text = st.text(alphabet=st.sampled_from(list("ab1,= _x")), min_size=0, max_size=6)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(text, text, text), min_size=1, max_size=8))
def test_record_codec_round_trip(spark, rows):
    from pyspark.sql import functions as F

    from sessionscope.functions.records import encode_record, record_field
    df = spark.createDataFrame(rows, "a string, b string, c string")
    enc = df.select("a", "b", "c", encode_record({"fa": F.col("a"), "fb": F.col("b"), "fc": F.col("c")}).alias("r"))
    got = enc.select("a", "b", "c", *[record_field(F.col("r"), f).alias(f) for f in ("fa", "fb", "fc")]).collect()

    def readable(v):
        # a value reads back when non-empty and free of "=" apart from trailing ones
        core = v.rstrip("=")
        return core if core and "=" not in core else None

    for r in got:
        assert (r.fa, r.fb, r.fc) == (readable(r.a), readable(r.b), readable(r.c))
