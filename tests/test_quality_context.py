"""Count-based same-day dividend flags equal a per-jump bool_or over the
security's dividends, NULL cases included (brute force on a small fixture)."""

import datetime as dt

from pyspark.sql import functions as F

from pitspark.plans import quality

from .conftest import rows

D = dt.date
IMPL = "实施"


def test_same_day_flags_match_bool_or(spark):
    jumps = spark.createDataFrame([
        ("A", D(2024, 1, 1), D(2024, 1, 5)),   # implemented on the day
        ("B", D(2024, 1, 1), D(2024, 1, 5)),   # only NULL-progress rows, all on the day -> NULL implemented flag
        ("C", D(2024, 1, 1), D(2024, 1, 5)),   # no dividends at all -> NULL flags
        ("E", D(2024, 1, 1), D(2024, 1, 5)),   # NULL progress on the day plus another day -> FALSE
        ("F", D(2024, 1, 1), D(2024, 1, 5)),   # proposed on the day
    ], "security_id string, previous_trade_date date, trade_date date").select(
        "*", F.lit(1.0).alias("previous_close"), F.lit(1.0).alias("pre_close"), F.lit(1.1).alias("factor_ratio"))
    divs = spark.createDataFrame([
        ("A", IMPL, D(2024, 1, 5)), ("A", IMPL, D(2023, 12, 1)),
        ("B", None, D(2024, 1, 5)),
        ("E", None, D(2024, 1, 5)), ("E", IMPL, D(2024, 2, 1)),
        ("F", "预案", D(2024, 1, 5)),
    ], "ts_code string, div_proc string, ex_date date")
    ctx = quality.dividend_context(jumps, divs, None)
    got = {r[0]: r[1:] for r in rows(ctx, "security_id", "has_same_date_implemented", "has_same_date_nonimplemented",
                                    "nearest_implemented_days")}
    j, d = jumps.alias("j"), divs.alias("d")
    brute = j.join(d, F.col("j.security_id") == F.col("d.ts_code"), "left").groupBy("j.security_id").agg(
        F.bool_or((F.col("d.ex_date") == F.col("j.trade_date")) & (F.col("d.div_proc") == IMPL)).alias("impl"),
        F.bool_or((F.col("d.ex_date") == F.col("j.trade_date")) & (F.coalesce(F.col("d.div_proc"), F.lit("")) != IMPL)).alias("non"),
        F.min(F.when(F.col("d.div_proc") == IMPL, F.abs(F.datediff(F.col("d.ex_date"), F.col("j.trade_date"))))).alias("near"),
    )
    want = {r[0]: r[1:] for r in rows(brute)}
    assert got == want
    assert got["B"][0] is None and got["C"] == (None, None, None) and got["E"][0] is False
