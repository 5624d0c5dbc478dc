"""Generic temporal operators on hand-made inputs (model: SURVEY §5 new cases)."""

import datetime as dt
import random

import pytest

from pyspark.sql import functions as F

from pitspark.operators import temporal as T
from pitspark.plans import actions

from .conftest import rows

D = dt.date


def test_interval_join_keyed_closed_and_half_open(spark):
    pts = spark.createDataFrame([("A", D(2024, 1, 1)), ("A", D(2024, 1, 5)), ("A", D(2024, 1, 10)), ("B", D(2024, 1, 5))],
                                "security_id string, trade_date date")
    iv = spark.createDataFrame([("A", D(2024, 1, 5), D(2024, 1, 10), "x"), ("A", D(2024, 1, 10), None, "y")],
                               "security_id string, s date, e date, code string")
    both = T.interval_join(pts, iv, point="trade_date", start="s", end="e", on="security_id", closed="both")
    assert rows(both, "trade_date", "code") == [(D(2024, 1, 5), "x"), (D(2024, 1, 10), "x"), (D(2024, 1, 10), "y")]
    left = T.interval_join(pts, iv, point="trade_date", start="s", end="e", on="security_id", closed="left")
    assert rows(left, "trade_date", "code") == [(D(2024, 1, 5), "x"), (D(2024, 1, 10), "y")]
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_interval_join_without_key_uses_year_buckets(spark):
    cal = spark.createDataFrame([(D(1997, 12, 31),), (D(1998, 1, 2),), (D(1999, 6, 1),), (D(2001, 1, 1),)], "trade_date date")
    iv = spark.createDataFrame([("A", D(1997, 12, 30), D(1998, 1, 2)), ("B", D(1999, 1, 1), None)], "sid string, s date, e date")
    out = T.interval_join(cal, iv, point="trade_date", start="s", end="e", closed="both")
    assert rows(out, "sid", "trade_date") == [("A", D(1997, 12, 31)), ("A", D(1998, 1, 2)), ("B", D(1999, 6, 1)), ("B", D(2001, 1, 1))]


def test_next_asof_is_strict(spark):
    cal = spark.createDataFrame([(D(2024, 1, 2),), (D(2024, 1, 3),), (D(2024, 1, 10),)], "trade_date date")
    ann = spark.createDataFrame([("a", D(2024, 1, 2)), ("b", D(2024, 1, 3)), ("c", D(2024, 1, 11)), ("d", D(2023, 12, 1))],
                                "id string, ann date")
    out = T.next_asof(ann, point="ann", calendar=cal, calendar_col="trade_date", out="avail")
    assert rows(out, "id", "avail") == [("a", D(2024, 1, 3)), ("b", D(2024, 1, 10)), ("c", None), ("d", D(2024, 1, 2))]
    loose = T.next_asof(ann, point="ann", calendar=cal, calendar_col="trade_date", out="avail", strict=False)
    assert rows(loose, "id", "avail")[0] == ("a", D(2024, 1, 2))


def test_close_intervals_keeps_zero_length(spark):
    df = spark.createDataFrame([("A", "s", "c1", D(2020, 1, 1), None), ("A", "s", "c2", D(2021, 1, 1), D(2022, 1, 1)),
                                ("A", "s", "c3", D(2021, 1, 1), None)],
                               "security_id string, sch string, code string, eff date, rem date")
    out = T.close_intervals(df, keys=["security_id", "sch"], effective="eff", removed="rem", tiebreak=["code"])
    assert rows(out, "code", "eff", "rem") == [("c1", D(2020, 1, 1), D(2021, 1, 1)), ("c2", D(2021, 1, 1), D(2021, 1, 1)),
                                               ("c3", D(2021, 1, 1), None)]


def test_islands_leaver_reentry_and_last_snapshot(spark):
    snaps = [("I", "A", D(2024, m, 1)) for m in (1, 2, 3, 4)] + [("I", "B", D(2024, 1, 1)), ("I", "B", D(2024, 3, 1)),
                                                                  ("I", "C", D(2024, 2, 1))]
    df = spark.createDataFrame(snaps, "benchmark_id string, security_id string, trade_date date")
    out = T.islands(df, group=["benchmark_id"], member=["security_id"], snapshot="trade_date")
    assert rows(out, "security_id", "effective_at", "removed_at") == [
        ("A", D(2024, 1, 1), None),
        ("B", D(2024, 1, 1), D(2024, 2, 1)),
        ("B", D(2024, 3, 1), D(2024, 4, 1)),
        ("C", D(2024, 2, 1), D(2024, 3, 1)),
    ]


def test_shift_clamped(spark):
    df = spark.createDataFrame([("A", i) for i in range(1, 6)], "code string, d int")
    out = T.shift_clamped(df, keys=["code"], order="d", value="d", back=2, forward=1, out_back="b", out_forward="f")
    assert rows(out, "d", "b", "f") == [(1, 1, 2), (2, 1, 3), (3, 1, 4), (4, 2, 5), (5, 3, 5)]


def test_forward_fill(spark):
    df = spark.createDataFrame([(1, "H1"), (2, None), (3, "H2"), (4, None)], "row_no int, v string")
    out = T.forward_fill(df, order="row_no", value=F.col("v"), out="ff")
    assert rows(out, "row_no", "ff") == [(1, "H1"), (2, "H1"), (3, "H2"), (4, "H2")]


def test_nearest_row_tie_prefers_earlier(spark):
    j = spark.createDataFrame([("A", D(2024, 1, 10))], "security_id string, trade_date date")
    ev = spark.createDataFrame([("A", D(2024, 1, 7)), ("A", D(2024, 1, 13)), ("A", D(2024, 2, 1))], "security_id string, ex_date date")
    out = T.nearest_row(j, ev, row_keys=["security_id", "trade_date"], on=[("security_id", "security_id")], point="trade_date",
                        event_date="ex_date", out_date="d", out_days="n")
    assert rows(out, "d", "n") == [(D(2024, 1, 7), 3)]
    dist = T.nearest_distance(j, ev, row_keys=["security_id", "trade_date"], on=[("security_id", "security_id")],
                              point="trade_date", event_date="ex_date", out="n")
    assert rows(dist, "n") == [(3,)]


def test_existence_flag(spark):
    j = spark.createDataFrame([("A", D(2024, 1, 2), D(2024, 1, 5)), ("B", D(2024, 1, 2), D(2024, 1, 5))],
                              "security_id string, prev date, trade_date date")
    ev = spark.createDataFrame([("A", D(2024, 1, 5)), ("B", D(2024, 1, 2))], "code string, d date")
    out = T.existence_flag(j, ev, row_keys=["security_id", "trade_date"], on=[("security_id", "code")],
                           condition=lambda r, c: (c("d") > r("prev")) & (c("d") <= r("trade_date")), name="hit")
    assert rows(out, "security_id", "hit") == [("A", True), ("B", False)]


def test_asof_event_directions(spark):
    r = spark.createDataFrame([("A", D(2024, 1, 5)), ("A", D(2024, 1, 20)), ("B", D(2024, 1, 5)), ("A", None)],
                              "security_id string, d date")
    ev = spark.createDataFrame([("A", D(2024, 1, 5)), ("A", D(2024, 1, 9)), ("B", D(2024, 1, 1))], "sec string, e date")
    on = [("security_id", "sec")]
    after = T.asof_event(r, ev, on=on, point="d", event_date="e", out="x", direction="after")
    assert rows(after, "security_id", "d", "x") == [("A", None, None), ("A", D(2024, 1, 5), D(2024, 1, 9)),
                                                    ("A", D(2024, 1, 20), None), ("B", D(2024, 1, 5), None)]
    incl = T.asof_event(r, ev, on=on, point="d", event_date="e", out="x", direction="after", inclusive=True)
    assert ("A", D(2024, 1, 5), D(2024, 1, 5)) in rows(incl, "security_id", "d", "x")
    before = T.asof_event(r, ev, on=on, point="d", event_date="e", out="x", direction="before")
    assert rows(before, "security_id", "d", "x") == [("A", None, None), ("A", D(2024, 1, 5), None),
                                                     ("A", D(2024, 1, 20), D(2024, 1, 9)), ("B", D(2024, 1, 5), D(2024, 1, 1))]
    win = T.event_in_window(r.where("d IS NOT NULL").withColumn("prev", F.date_sub("d", 5)), ev, on=on, after="prev",
                            until="d", event_date="e", name="hit")
    assert rows(win, "security_id", "d", "hit") == [("A", D(2024, 1, 5), True), ("A", D(2024, 1, 20), False),
                                                    ("B", D(2024, 1, 5), True)]


def test_asof_events_equals_a_walk(spark):
    """Rows and events of several kinds on the same days, with nulls and repeats, against a plain walk."""
    rng = random.Random(12)
    day = lambda: dt.date(2024, 1, 1) + dt.timedelta(days=rng.randint(0, 40))
    events = {k: [(rng.choice(["a", "b", None]), rng.choice([day(), day(), None])) for _ in range(40)] for k in ("x", "y")}
    points = [(i, rng.choice(["a", "b", "c", None]), rng.choice([day(), day(), day(), None])) for i in range(60)]
    frames = {k: (spark.createDataFrame(v, "who string, at date"), "who", "at") for k, v in events.items()}
    lookups = [T.Lookup("last_x", "last", ("x",)), T.Lookup("next_x", "next", ("x",)), T.Lookup("same_y", "same", ("y",)), T.Lookup("all", "total", ("x", "y")), T.Lookup("last_any", "last", ("x", "y"))]
    got = T.asof_events(spark.createDataFrame(points, "i int, k string, p date"), frames, key="k", point="p", lookups=lookups)
    want = []
    for i, k, p in points:
        of = lambda *kinds: [d for kind in kinds for w, d in events[kind] if k is not None and w == k and d is not None and p is not None]
        want.append((i, max((d for d in of("x") if d <= p), default=None), min((d for d in of("x") if d >= p), default=None),
                     sum(d == p for d in of("y")), len(of("x", "y")), max((d for d in of("x", "y") if d <= p), default=None)))
    assert rows(got, "i", "last_x", "next_x", "same_y", "all", "last_any") == sorted(want)


def test_action_date_explains_a_jump(spark):
    d = dt.date
    jumps = spark.createDataFrame([("s", d(2024, 1, 2), d(2024, 1, 5), 1.0, 1.0, 1.1)], "security_id string, previous_trade_date date, trade_date date, previous_close double, pre_close double, factor_ratio double")
    ledger = spark.createDataFrame([("s", None, None, d(2024, 1, 3))], "security_id string, ex_date date, book_date date, action_date date")
    assert actions.jump_facts(jumps, ledger, None, None).first().has_action
    assert not actions.jump_facts(jumps, ledger.drop("action_date"), None, None).first().has_action
    on_previous = ledger.withColumn("action_date", F.lit(d(2024, 1, 2)))
    assert not actions.jump_facts(jumps, on_previous, None, None).first().has_action


def _spans(rng, n, keys, null_end=0.2):
    out = []
    for _ in range(n):
        s = D(2024, 1, 1) + dt.timedelta(days=rng.randint(0, 60))
        out.append((rng.choice(keys), rng.choice([s, s, s, s, None]), None if rng.random() < null_end else s + dt.timedelta(days=rng.randint(-2, 12))))
    return out


def test_interval_sets_hold_the_days_of_their_intervals(spark):
    rng = random.Random(13)
    spans = _spans(rng, 60, ["a", "b", "c", "d", None], null_end=0.03)
    sets = T.interval_sets(spark.createDataFrame(spans, "k string, s date, e date"), key="k", start="s", end="e", out="x")
    for k, x in sets.collect():
        assert all(a["last"] + dt.timedelta(days=1) < b["first"] for a, b in zip(x, x[1:])) and k is not None
    days = [D(2023, 12, 25) + dt.timedelta(days=i) for i in range(100)]
    points = spark.createDataFrame([(k, d) for k in "abcdz" for d in [*days, None]], "k string, d date")
    inside = {(k, d) for k in "abcd" for d in days for w, s, e in spans if w == k and s is not None and s <= d and (e is None or d <= e)}
    got = points.join(sets, "k", "left").where(T.in_interval_set(F.col("d"), F.col("x")))
    assert set(rows(got, "k", "d")) == inside
    listed = T.interval_set_days(sets, spark.createDataFrame([(d,) for d in days[::3]], "d date"), key="k", intervals="x", day="d")
    assert rows(listed) == sorted((k, d) for k, d in inside if d in days[::3])


def test_sweep_agrees_with_pairs(spark):
    rng = random.Random(14)
    official = [(k, s, e or D(2999, 1, 1)) for k, s, e in _spans(rng, 50, ["a", "b"]) if s]
    candidates = [(i, k, s, e or D(2024, 3, 1)) for i, (k, s, e) in enumerate(_spans(rng, 80, ["a", "b", "c"])) if s]
    o = spark.createDataFrame(official, "k string, s date, e date")
    c = spark.createDataFrame(candidates, "i int, k string, a date, b date")
    before = T.reach_before(c, o, on=["k"], point="b", start="s", end="e", out="r")
    assert rows(before, "i", "r") == sorted((i, max((e for w, s, e in official if w == k and s < b), default=None)) for i, k, a, b in candidates)
    swept = before.where(F.col("r").isNull() | (F.col("r") <= F.col("a"))).select("i")
    pairs = c.alias("c").join(o.alias("o"), (F.col("c.k") == F.col("o.k")) & (F.col("o.s") < F.col("c.b")) & (F.col("c.a") < F.col("o.e")), "left_anti")
    assert rows(swept) == rows(pairs, "i") and 0 < swept.count() < len(candidates)
    upto = T.reach_before(c, o, on=["k"], point="a", start="s", end="e", out="r", inclusive=True)
    assert rows(upto.where("r >= b"), "i") == sorted((i,) for i, k, a, b in candidates if any(w == k and s <= a and e >= b for w, s, e in official))


def test_islands_extended_equal_islands_of_everything(spark):
    rng = random.Random(15)
    days = [D(2024, m, 1) for m in range(1, 9)]
    snaps = [(g, m, d) for g in ("x", "y", None) for m in range(6) for d in days if rng.random() < 0.6 and not (g == "y" and d > D(2024, 5, 1))]
    df = spark.createDataFrame(snaps, "g string, m int, d date").where("g is not null")
    names = {"group": ["g"], "member": ["m"], "snapshot": "d"}
    whole = rows(T.islands(df, **names))
    for cuts in ([3], [1, 2, 3, 4, 6]):
        state = T.islands(df.where(F.col("d") <= days[cuts[0] - 1]), **names, seen_out="last_seen").checkpoint()
        for a, b in zip(cuts, [*cuts[1:], 8]):
            state = T.extend_islands(state, df.where((F.col("d") > days[a - 1]) & (F.col("d") <= days[b - 1])), **names).checkpoint()
        assert rows(state.drop("last_seen")) == whole
    assert any(r[3] is not None for r in whole) and len({r[:2] for r in whole}) < len(whole)  # with members that come back
    state = T.islands(df, **names, seen_out="last_seen")
    with pytest.raises(Exception, match="not later"):
        T.extend_islands(state, df.where(F.col("d") == days[2]), **names).collect()


@pytest.mark.parametrize("direction", ["forward", "back"])
@pytest.mark.parametrize("how", ["last", "min", "max", "sum"])
def test_running_equals_one_window(spark, how, direction):
    rng = random.Random(16)
    items = [(i, i // 7 if rng.random() < 0.9 else i // 7, rng.choice([None, None, rng.randint(0, 50)])) for i in rng.sample(range(200), 90)]
    df = spark.createDataFrame(items, "i long, b long, v long").repartition(4)
    got = T.running(df, order="i", bucket=F.floor(F.col("i") / 7), value=F.col("v"), out="r", how=how, direction=direction)
    w = T.Window.orderBy(F.col("i").asc() if direction == "forward" else F.col("i").desc()).rowsBetween(T.Window.unboundedPreceding, 0)
    want = df.withColumn("r", F.last("v", ignorenulls=True).over(w) if how == "last" else getattr(F, how)("v").over(w))
    assert rows(got, "i", "r") == rows(want, "i", "r")
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()


def test_running_without_values_and_with_too_many_buckets(spark):
    empty = spark.createDataFrame([], "i long, v long")
    assert T.running(empty, order="i", bucket=F.col("i"), value=F.col("v"), out="r").collect() == []
    blank = spark.createDataFrame([(1, None), (9, None)], "i long, v long")
    assert rows(T.running(blank, order="i", bucket=F.col("i"), value=F.col("v"), out="r"), "r") == [(None,), (None,)]
    with pytest.raises(ValueError):
        T.running(spark.range(20_000).withColumn("v", F.col("id")), order="id", bucket=F.col("id"), value=F.col("v"), out="r", how="sum")


def test_next_asof_has_no_single_task(spark):
    cal = spark.createDataFrame([(D(2020, 1, 3),), (D(2022, 5, 5),), (D(2024, 2, 2),)], "d date")
    pts = spark.createDataFrame([(D(2019, 1, 1),), (D(2020, 1, 3),), (D(2022, 5, 4),), (D(2023, 1, 1),), (D(2024, 2, 2),), (None,)], "p date")
    got = T.next_asof(pts, point="p", calendar=cal, calendar_col="d", out="n")
    want = [(None, None), (D(2019, 1, 1), D(2020, 1, 3)), (D(2020, 1, 3), D(2022, 5, 5)), (D(2022, 5, 4), D(2022, 5, 5)), (D(2023, 1, 1), D(2024, 2, 2)), (D(2024, 2, 2), None)]
    assert rows(got, "p", "n") == want
    assert ("SinglePartition" not in got._jdf.queryExecution().executedPlan().toString())
    loose = T.next_asof(pts, point="p", calendar=cal, calendar_col="d", out="n", strict=False)
    assert (D(2020, 1, 3), D(2020, 1, 3)) in rows(loose, "p", "n")
