"""Official industry import: precedence, crosswalk ambiguity, anchors."""

import datetime as dt

from pitspark.plans import industry as I

from .conftest import rows


def _codes(spark):
    data = [("110000", "Fin", "", "", 1), ("110100", "Fin", "Bank", "", 2), ("110101", "Fin", "Bank", "Bank-1", 3),
            ("120000", "Ind", "", "", 4), ("120100", "Ind", "Mach", "", 5), ("120101", "Ind", "Mach", "Mach-1", 6),
            ("990000", "GHOST", "G2", "", 7), ("990001", "NOPE", "", "x", 8)]
    return spark.createDataFrame(data, "`行业代码` string, `一级行业名称` string, `二级行业名称` string, `三级行业名称` string, row_no bigint")


def test_hierarchy_levels(spark):
    h = I.hierarchy_levels(_codes(spark)).where("level_code IS NOT NULL")
    got = rows(h)
    assert ("110101", "L1", "110000") in got and ("110101", "L2", "110100") in got and ("110101", "L3", "110101") in got
    assert ("990001", "L3", "990001") in got
    # a level-2 row with a blank level-3 name is its own L2 code
    assert [r for r in got if r[0] == "990000"] == [("990000", "L2", "990000")]


def test_precedence_stops_at_hierarchy(spark):
    hier = I.hierarchy_levels(_codes(spark))
    cross = spark.createDataFrame([("990001", "L1", "120000"), ("610101", "L1", "110000"), ("990000", "L1", "120000")],
                                  "code string, level string, level_code string")
    emp = spark.createDataFrame([("610101", "L1", "120000"), ("620202", "L1", "120000")], "code string, level string, level_code string")
    raw = spark.createDataFrame([("990001",), ("610101",), ("620202",), ("777777",), ("990000",)], "raw_code string")
    got = dict(((c, lv), v) for c, lv, v in rows(I.resolve_codes(raw, hier, cross, emp, ("L1",))))
    assert got[("990001", "L1")] == ""          # in the table with levels, but no L1: stop
    assert got[("610101", "L1")] == "110000"    # crosswalk before empirical
    assert got[("620202", "L1")] == "120000"    # empirical
    assert got[("777777", "L1")] == ""          # unresolved
    assert got[("990000", "L1")] == ""          # has an L2 level only: stops at the table


def test_crosswalk_unique_and_section_fallback(spark):
    hier = I.hierarchy_levels(_codes(spark))
    sheet = spark.createDataFrame([
        (1, "610000", "110000"), (2, "610101", "110101"), (3, "610102", "110101"), (4, "610102", "120101"),
        (5, "610103", "999999"), (6, "620000", "120000"), (7, "620101", "120101"),
    ], "row_no bigint, c3 string, c7 string").selectExpr("row_no", "'' AS c0", "'' AS c1", "'' AS c2", "c3", "'' AS c4",
                                                         "'' AS c5", "'' AS c6", "c7")
    got = set(rows(I.crosswalk_map(sheet, hier)))
    assert ("610101", "L3", "110101") in got and ("610101", "L1", "110000") in got
    assert ("610102", "L1", "110000") in got and ("610102", "L3", "110101") not in got  # ambiguous: section L1 only
    assert ("610103", "L1", "110000") in got  # new code outside the table
    assert ("620101", "L2", "120100") in got


def test_anchor_only_without_cutover_day_record(spark):
    ledger = spark.createDataFrame([
        ("600001", "2021-07-30 10:00:00", "110101", "2021-07-30 10:00:00", 1),
        ("600002", "2021-08-02 00:00:00", "110101", "2021-08-02 00:00:00", 2),
    ], "`股票代码` string, `计入日期` string, `行业代码` string, `更新日期` string, row_no bigint")
    snap = spark.createDataFrame([("A股", "110101", "600001", 1), ("A股", "110101", "600002", 2), ("B股", "110101", "600003", 3)],
                                 "`交易所` string, `行业代码` string, `股票代码` string, row_no bigint")
    anchors = I.cutover_anchors(I.snapshot_codes(snap), I.stock_records(ledger), I.ImportParams())
    assert [r[0] for r in rows(anchors, "security_id")] == ["600002.SH"]


def test_alias_adjudication_takes_the_legacy_interval(spark):
    """A new code takes over an interval that its legacy code held, unless one of its own rows overlaps it."""
    t = lambda y, m=1: dt.datetime(y, m, 1)
    official = spark.createDataFrame([
        ("OLD.SZ", "sw2021_l1", "801010", t(2000), t(2010)), ("NEW.SZ", "sw2021_l1", "801020", t(2010), None),
        ("BUSY.SZ", "sw2021_l1", "801020", t(2003), t(2004)),
    ], "security_id string, industry_schema string, industry_code string, effective_at timestamp, removed_at timestamp")

    def alias(new, start, end, code="801010", legacy="OLD.SZ", schema="sw2021_l1"):
        return (new, start, end, schema, "L1", code, "security_code_alias_backfill", None, None, None, "medium", "", legacy)

    adj = spark.createDataFrame([
        alias("NEW.SZ", t(2001), t(2010)),            # held by the old code, touches no own row from the left
        alias("BUSY.SZ", t(2002), t(2003, 6)),        # overlaps an own row
        alias("BUSY.SZ", t(2005), t(2006)),           # free again
        alias("NEW.SZ", t(1999), t(2001)),            # the old code began later
        alias("NEW.SZ", t(2001), t(2002), "801099"),  # the old code held another industry
        alias("NONE.SZ", t(2001), t(2002)),           # the new code has no rows
    ], "security_id string, start_date timestamp, end_date timestamp, industry_schema string, industry_level string, industry_code string, source_type string, "
       "evidence_url string, evidence_date timestamp, available_at timestamp, confidence string, adjudication_note string, legacy_security_id string")  # fmt: skip
    closed, applied = I.apply_adjudications(official, adj)
    assert rows(applied, "security_id", "start_date") == [("BUSY.SZ", t(2005)), ("NEW.SZ", t(2001))]
    assert ("NEW.SZ", t(2001), t(2010)) in rows(closed, "security_id", "effective_at", "removed_at")
    assert closed.count() == 5
