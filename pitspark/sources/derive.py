"""Raw provider-layer tables derived from the driver's star-schema tables.

The driver ships TPC-H-like tables; the library works on provider market data.
Every raw table here is a deterministic Spark transformation of the driver
tables (grouping ``lineitem`` by supplier and ship day is the bar spine), so
the raw layer grows with the driver data.  The same rules are written once
more, independently, as DuckDB SQL in ``oracle/`` for the correctness gate.

Rules (k = supplier key, d = ship day, dno = days since 1995-01-01; one
"group" = one (k, d) with lo/hi = min/max extended price, q = summed
quantity, n = line count):

* security: symbol = prefix[k % 6] + k zero-padded to 3 digits; suffix
  SZ,SZ,SZ,SH,SH,BJ by k % 6, HK when k % 17 = 16; delisted when k % 23 = 0.
* adjustment factor f = 1 + 0.1 * floor(dno / 365) (+0.004 when k % 3 = 0 and
  dno >= 1200); missing when (k + dno) % 29 = 0; 0.0 when (k + dno) % 307 = 0.
* unadjusted bar: dropped when (k + dno) % 11 = 0; open = (2 lo + hi) / 3
  (0.0 when (3k + dno) % 211 = 0), close = (lo + 2 hi) / 3, pre_close =
  previous close of the supplier (open on the first day), rescaled by the
  factor change when k % 10 in (3, 4); full-day suspension days
  ((7k + dno) % 101 = 0) carry zero volume and amount.
* qfq bar: dropped when (k + dno) % 13 = 0; unadjusted prices times f.
* dividends: per year boundary B_m = 1995-01-01 + 365 m (m = 1..6): k % 5 = 0
  implemented on B_m; 1 proposed on the first trading day >= B_m (NULL
  progress when m = 3); 2 implemented on B_m - 20; 3 implemented on B_m + 70;
  4 none.  One 8-digit invalid ex_date ('20001345') for k % 35 = 0, m = 6.
* limits, suspensions, names, industry intervals, benchmark weights,
  fundamentals, index bars and the two alternative bar feeds: see each function.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from ..functions.text import zfill
from . import feeds

BASE_DATE = _dt.date(1995, 1, 1)
# Symbol prefixes and exchange suffixes by k % 6.
SYMBOL_PREFIXES = ["000", "300", "301", "600", "688", "920"]
SYMBOL_SUFFIXES = ["SZ", "SZ", "SZ", "SH", "SH", "BJ"]
IMPLEMENTED = "实施"
PROPOSED = "预案"
FULL_DAY_TIMING = "全天停牌"
INGEST_DAY = _dt.datetime(2024, 1, 2, 0, 0, 0)


def _k() -> Column:
    return F.col("k")


def _dno() -> Column:
    return F.col("dno")


def _text_date(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd")


def _ts(hours: int | Column = 0) -> Column:
    """Ingest timestamp: 2024-01-02 00:00 UTC plus ``hours``."""
    epoch = int(_dt.datetime(2024, 1, 2, tzinfo=_dt.timezone.utc).timestamp())
    h = hours if isinstance(hours, Column) else F.lit(hours)
    return F.timestamp_seconds(F.lit(epoch) + h.cast("bigint") * 3600)


def _case_by(mod: Column, values: list[str]) -> Column:
    expr = None
    for i, v in enumerate(values):
        expr = F.when(mod == i, F.lit(v)) if expr is None else expr.when(mod == i, F.lit(v))
    return expr


def ts_code_of(k: Column) -> Column:
    digits = zfill(k.cast(StringType()), 3)
    symbol = F.concat(_case_by(k % 6, SYMBOL_PREFIXES), digits)
    suffix = F.when(k % 17 == 16, F.lit("HK")).otherwise(_case_by(k % 6, SYMBOL_SUFFIXES))
    return F.concat(symbol, F.lit("."), suffix)


def factor_of(k: Column, dno: Column) -> Column:
    step = F.floor(dno / 365).cast(DoubleType())
    bump = F.when((k % 3 == 0) & (dno >= 1200), F.lit(0.004)).otherwise(F.lit(0.0))
    return F.lit(1.0) + F.lit(0.1) * step + bump


@dataclass
class DriverTables:
    """Lazy handle on one scale-factor folder of driver tables.

    ``keep`` (optional) stores a shared intermediate frame, dealt by a key, and returns the
    stored copy; the bar spine every raw table is projected from is kept
    once, so the lineitem aggregation and the per-supplier window run once.
    """

    spark: SparkSession
    sf_dir: str
    keep: object = None

    def _kept(self, name: str, df: DataFrame, key: str) -> DataFrame:
        return self.keep(name, df, key) if self.keep is not None else df

    def read(self, name: str, *columns: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return df.select(*columns) if columns else df

    # ---------------------------------------------------------------- spine
    @cached_property
    def groups(self) -> DataFrame:
        """One row per (supplier, ship day) with price/quantity aggregates.

        Partial aggregation runs map-side; the shuffle is on (k, d).
        """
        li = self.read("lineitem", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity")
        g = li.groupBy(F.col("l_suppkey").alias("k"), F.to_date("l_shipdate").alias("d")).agg(
            F.min("l_extendedprice").alias("lo"),
            F.max("l_extendedprice").alias("hi"),
            F.sum("l_quantity").alias("q"),
            F.count(F.lit(1)).alias("n"),
        )
        return g.withColumn("dno", F.datediff(F.col("d"), F.lit(BASE_DATE)))

    @cached_property
    def bars(self) -> DataFrame:
        """Groups with the provider's unadjusted prices and factor.

        The previous close is a per-supplier ``lag`` (rows per supplier are
        bounded by the number of ship days).  Groups are dealt by security code, which follows
        from the supplier, so the window, the stored bars and all joins of their projections share one shuffle.
        """
        g = self.groups.withColumn("ts_code", ts_code_of(_k())).repartition("ts_code")
        w = Window.partitionBy("ts_code", "k").orderBy("d")
        lo, hi, q = F.col("lo"), F.col("hi"), F.col("q")
        close_u = (lo + F.lit(2) * hi) / 3
        g = g.select(
            "ts_code",
            "k",
            "d",
            "dno",
            "lo",
            "hi",
            "q",
            "n",
            F.when((_k() * 3 + _dno()) % 211 == 0, F.lit(0.0)).otherwise((F.lit(2) * lo + hi) / 3).alias("open_u"),
            close_u.alias("close_u"),
            factor_of(_k(), _dno()).alias("f"),
        )
        g = g.withColumn("prev_close", F.lag("close_u").over(w)).withColumn("f_prev", F.lag("f").over(w))
        pre_close = (
            F.when(F.col("prev_close").isNull(), F.col("open_u"))
            .when((_k() % 10).isin(3, 4) & (F.col("f_prev") != F.col("f")), F.col("prev_close") * F.col("f_prev") / F.col("f"))
            .otherwise(F.col("prev_close"))
        )
        g = g.withColumn("pre_close_u", pre_close)
        full = (_k() * 7 + _dno()) % 101 == 0
        return self._kept("derive/bars", g.select(
            *[c for c in g.columns if c != "ts_code"],
            "ts_code",
            _text_date(F.col("d")).alias("trade_date"),
            (F.col("close_u") - F.col("pre_close_u")).alias("change_u"),
            F.when(F.col("pre_close_u") != 0.0, (F.col("close_u") - F.col("pre_close_u")) / F.col("pre_close_u") * 100.0).alias("pct_chg_u"),
            F.when(full, F.lit(0.0)).otherwise(q).alias("vol_u"),
            F.when(full, F.lit(0.0)).otherwise(lo).alias("amount_u"),
        ), "ts_code")

    # ----------------------------------------------------------- dimensions
    def stock_basic_ref(self) -> DataFrame:
        s = self.read("supplier", "s_suppkey", "s_name", "s_nationkey")
        # nation (25 rows) and region (5 rows) are fixed-size TPC-H dimensions.
        n = F.broadcast(self.read("nation", "n_nationkey", "n_name", "n_regionkey"))
        r = F.broadcast(self.read("region", "r_regionkey", "r_name"))
        j = s.join(n, s.s_nationkey == n.n_nationkey, "left").join(r, n.n_regionkey == r.r_regionkey, "left")
        k = F.col("s_suppkey")
        return j.select(
            ts_code_of(k).alias("ts_code"),
            F.concat(_case_by(k % 6, SYMBOL_PREFIXES), zfill(k.cast(StringType()), 3)).alias("symbol"),
            F.col("s_name").alias("name"),
            F.col("r_name").alias("area"),
            F.col("n_name").alias("industry"),
            F.lit("19950101").alias("list_date"),
            F.when(k % 23 == 0, F.lit("20011231")).otherwise(F.lit("")).alias("delist_date"),
            _case_by(k % 3, ["N", "H", "S"]).alias("is_hs"),
            _ts(0).alias("ingested_at"),
            F.lit("stock_basic").alias("source_table"),
        )

    def raw_namechange(self) -> DataFrame:
        """Listing name for everyone; an ST window 1997 for k % 9 = 0 (open end
        for k % 18 = 0, start only announced for k % 27 = 0); a '*ST' reason
        without 'ST' in the name for k % 9 = 4 (1999-03-01..1999-06-30)."""
        s = self.read("supplier", "s_suppkey", "s_name").withColumnRenamed("s_suppkey", "k")
        k = _k()
        base = s.select(
            ts_code_of(k).alias("ts_code"), F.col("s_name").alias("name"), F.lit("19950101").alias("start_date"),
            F.lit("").alias("end_date"), F.lit("19941220").alias("ann_date"), F.lit("listing").alias("change_reason"),
        )
        st = s.where(k % 9 == 0).select(
            ts_code_of(k).alias("ts_code"),
            F.concat(F.lit("ST "), F.col("s_name")).alias("name"),
            F.when(k % 27 == 0, F.lit(None).cast(StringType())).otherwise(F.lit("19970101")).alias("start_date"),
            F.when(k % 18 == 0, F.lit("")).otherwise(F.lit("19980101")).alias("end_date"),
            F.lit("19961215").alias("ann_date"),
            F.lit("ST").alias("change_reason"),
        )
        star = s.where(k % 9 == 4).select(
            ts_code_of(k).alias("ts_code"), F.concat(F.col("s_name"), F.lit("B")).alias("name"),
            F.lit("19990301").alias("start_date"), F.lit("19990630").alias("end_date"),
            F.lit("19990225").alias("ann_date"), F.lit("*ST").alias("change_reason"),
        )
        return base.unionByName(st).unionByName(star).select(
            "*", F.lit("namechange").alias("source_table"), _ts(0).alias("ingested_at")
        )

    # ----------------------------------------------------------------- bars
    def raw_daily_basic(self) -> DataFrame:
        b = self.bars
        k = _k()
        return b.select(
            "ts_code", "trade_date", F.col("close_u").alias("close"),
            (F.col("q") / 100.0).alias("turnover_rate"), (F.col("q") / 50.0).alias("turnover_rate_f"),
            F.col("n").cast(DoubleType()).alias("volume_ratio"), (F.col("hi") / F.col("lo")).alias("pe"),
            (F.col("lo") / 10.0).alias("pe_ttm"), (F.col("hi") / 100.0).alias("pb"), (F.col("lo") / 100.0).alias("ps"),
            F.lit(None).cast(DoubleType()).alias("ps_ttm"), F.lit(None).cast(DoubleType()).alias("dv_ratio"),
            F.lit(None).cast(DoubleType()).alias("dv_ttm"),
            (k + 1000).cast(DoubleType()).alias("total_share"), (k + 600).cast(DoubleType()).alias("float_share"),
            (k + 300).cast(DoubleType()).alias("free_share"),
            (F.col("close_u") * (k + 1000).cast(DoubleType())).alias("total_mv"),
            (F.col("close_u") * (k + 600).cast(DoubleType())).alias("circ_mv"),
            F.lit("daily_basic").alias("source_table"), _ts(5).alias("ingested_at"),
        )

    def _kline(self, keep: Column, scale: Column | None, source: str, hours: int) -> DataFrame:
        b = self.bars.where(keep)
        s = (lambda c: F.col(c) * scale) if scale is not None else (lambda c: F.col(c))
        return b.select(
            "ts_code", "trade_date",
            s("open_u").alias("open"), s("hi").alias("high"), s("lo").alias("low"), s("close_u").alias("close"),
            s("pre_close_u").alias("pre_close"), s("change_u").alias("change"), F.col("pct_chg_u").alias("pct_chg"),
            F.col("vol_u").alias("vol"), F.col("amount_u").alias("amount"),
            F.lit(source).alias("source_table"), _ts(hours).alias("ingested_at"),
        )

    def raw_kline_unadj(self) -> DataFrame:
        return self._kline((_k() + _dno()) % 11 != 0, None, "daily", 6)

    def raw_kline_qfq(self) -> DataFrame:
        return self._kline((_k() + _dno()) % 13 != 0, F.col("f"), "daily_qfq", 7)

    def raw_adj_factor(self) -> DataFrame:
        b = self.bars.where((_k() + _dno()) % 29 != 0)
        return b.select(
            "ts_code", "trade_date",
            F.when((_k() + _dno()) % 307 == 0, F.lit(0.0)).otherwise(F.col("f")).alias("adj_factor"),
            F.lit("adj_factor").alias("source_table"), _ts(_k() % 9).alias("ingested_at"),
        )

    # --------------------------------------------------------------- events
    def raw_dividend(self) -> DataFrame:
        """Dividend events around the factor steps (see module doc)."""
        g = self.bars.select("ts_code", "k", "d", "dno", (F.floor(F.col("dno") / 365)).alias("m")).where(
            (F.col("m") >= 1) & (_k() % 5 != 4)
        )
        per = g.groupBy("ts_code", "k", "m").agg(F.min("d").alias("first_day"))
        k, m = _k(), F.col("m")
        boundary = F.date_add(F.lit(BASE_DATE), (m * 365).cast("int"))
        ex = (
            F.when(k % 5 == 0, boundary)
            .when(k % 5 == 1, F.col("first_day"))
            .when(k % 5 == 2, F.date_sub(boundary, 20))
            .otherwise(F.date_add(boundary, 70))
        )
        per = per.withColumn("ex", ex)
        ex_text = F.when((k % 35 == 0) & (m == 6), F.lit("20001345")).otherwise(_text_date(F.col("ex")))
        proc = (
            F.when(k % 5 != 1, F.lit(IMPLEMENTED))
            .when(m == 3, F.lit(None).cast(StringType()))
            .otherwise(F.lit(PROPOSED))
        )
        mult = (k % 4 + 1).cast(DoubleType())
        pay = (
            F.when(m % 2 == 1, _text_date(F.date_add(F.col("ex"), 3)))
            .when(m == 4, F.lit(""))
            .otherwise(F.lit(None).cast(StringType()))
        )
        return per.select(
            ts_code_of(k).alias("ts_code"),
            F.concat((F.year(boundary) - 1).cast(StringType()), F.lit("1231")).alias("end_date"),
            _text_date(F.date_sub(boundary, 40)).alias("ann_date"),
            proc.alias("div_proc"),
            F.when(m % 3 == 0, F.lit(0.1)).otherwise(F.lit(None).cast(DoubleType())).alias("stk_div"),
            F.when(m % 2 == 0, F.lit(0.2)).otherwise(F.lit(0.0)).alias("stk_bo_rate"),
            F.lit(None).cast(DoubleType()).alias("stk_co_rate"),
            (F.lit(0.04) * mult).alias("cash_div"),
            F.when(m % 2 == 1, F.lit(0.05) * mult).otherwise(F.lit(None).cast(DoubleType())).alias("cash_div_tax"),
            _text_date(F.date_sub(F.col("ex"), 1)).alias("record_date"),
            ex_text.alias("ex_date"),
            pay.alias("pay_date"),
            F.lit(None).cast(StringType()).alias("div_listdate"),
            F.lit("dividend").alias("source_table"),
            _ts(1).alias("ingested_at"),
        )

    def raw_suspend_d(self) -> DataFrame:
        """(7k + dno) % 101: 0 full-day S (timing '', full-day text or NULL by
        dno % 3), 1 intraday S, 2 resume R."""
        b = self.bars
        r = (_k() * 7 + _dno()) % 101
        timing = (
            F.when(r == 1, F.lit("09:30-10:30"))
            .when(r == 2, F.lit(None).cast(StringType()))
            .when(_dno() % 3 == 0, F.lit(""))
            .when(_dno() % 3 == 1, F.lit(FULL_DAY_TIMING))
            .otherwise(F.lit(None).cast(StringType()))
        )
        return b.where(r <= 2).select(
            "ts_code", "trade_date", timing.alias("suspend_timing"),
            F.when(r == 2, F.lit("R")).otherwise(F.lit("S")).alias("suspend_type"),
            F.lit("suspend_d").alias("source_table"), _ts(2).alias("ingested_at"),
        )

    def _limits(self) -> DataFrame:
        b = self.bars
        kd = _k() + _dno()
        up = F.when(kd % 37 == 0, F.col("lo")).otherwise(F.col("pre_close_u") * 1.1)
        down = (
            F.when(kd % 43 == 0, F.lit(None).cast(DoubleType()))
            .when(kd % 41 == 0, F.col("hi"))
            .otherwise(F.col("pre_close_u") * 0.9)
        )
        return b.select("k", "dno", "ts_code", "trade_date", up.alias("up_limit"), down.alias("down_limit"),
                        F.col("pre_close_u").alias("pre_close"))

    def raw_stk_limit(self) -> DataFrame:
        """Official limits on (k + dno) % 4 != 0; up = low every 37th, down = high
        every 41st, down missing every 43rd."""
        lim = self._limits().where((_k() + _dno()) % 4 != 0)
        return lim.select("ts_code", "trade_date", "up_limit", "down_limit", "pre_close",
                          F.lit("stk_limit").alias("source_table"), _ts(3).alias("ingested_at"))

    def supplemental_stk_limit(self) -> DataFrame:
        """Second copy: later and changed for k % 2 = 0, same time and changed
        for k % 10 = 1, no timestamp for k % 10 = 3, only-here rows for k % 10 = 5."""
        lim = self._limits()
        on_source = (_k() + _dno()) % 4 != 0
        k = _k()
        keep = (on_source & ((k % 2 == 0) | (k % 10 == 1) | (k % 10 == 3))) | (~on_source & (k % 10 == 5))
        up = (
            F.when(k % 2 == 0, F.col("up_limit") + 0.01)
            .when(k % 10 == 1, F.col("up_limit") + 0.02)
            .when(k % 10 == 3, F.col("up_limit") * 2.0)
            .otherwise(F.col("up_limit"))
        )
        down = F.when(k % 2 == 0, F.col("down_limit") - 0.01).otherwise(F.col("down_limit"))
        ts = (
            F.when(k % 2 == 0, _ts(27))
            .when(k % 10 == 1, _ts(3))
            .when(k % 10 == 3, F.lit(None).cast("timestamp"))
            .otherwise(_ts(51))
        )
        return lim.where(keep).select("ts_code", "trade_date", up.alias("up_limit"), down.alias("down_limit"),
                                      "pre_close", F.lit("stk_limit_supplemental").alias("source_table"),
                                      ts.alias("ingested_at"))

    # --------------------------------------------------------- fundamentals
    @cached_property
    def quarters(self) -> DataFrame:
        """One row per supplier and quarter with shipments."""
        g = self.bars.select("ts_code", "k", "d", "q", "hi", "lo").withColumn("qe", F.last_day(F.add_months(F.trunc("d", "quarter"), 2)))
        agg = g.groupBy("ts_code", "k", "qe").agg(
            F.sum("q").alias("sq"), F.max("hi").alias("mh"), F.min("lo").alias("ml"), F.count(F.lit(1)).alias("nd")
        )
        k = _k()
        ann = F.when(k % 19 == 0, F.lit("")).otherwise(_text_date(F.date_add(F.col("qe"), (k % 40).cast("int"))))
        return agg.select(ts_code_of(k).alias("ts_code"), ann.alias("ann_date"), _text_date(F.col("qe")).alias("end_date"), "sq", "mh", "ml", F.col("nd").cast(DoubleType()).alias("nd"))

    def _statement(self, **values: Column) -> DataFrame:
        head = [F.col("ts_code"), F.col("ann_date"), F.col("ann_date").alias("f_ann_date"), F.col("end_date"), F.lit("1").alias("report_type"), F.lit("1").alias("comp_type")]
        return self.quarters.select(*head, *[v.alias(n) for n, v in values.items()])

    def raw_income(self) -> DataFrame:
        """Quarterly: quantities as revenue, trading days as costs."""
        sq, nd = F.col("sq"), F.col("nd")
        return self._statement(total_revenue=sq, revenue=sq, operate_profit=sq - nd, total_profit=sq - nd, income_tax=nd / 4.0, n_income=sq - nd * 1.25, n_income_attr_p=sq - nd * 1.25)

    def raw_balancesheet(self) -> DataFrame:
        mh, ml, sq = F.col("mh"), F.col("ml"), F.col("sq")
        return self._statement(total_assets=mh * 2.0, total_liab=ml, total_hldr_eqy_exc_min_int=mh * 2.0 - ml, total_hldr_eqy_inc_min_int=mh * 2.0 - ml, money_cap=mh, accounts_receiv=sq, inventories=mh - sq)

    def raw_cashflow(self) -> DataFrame:
        sq, nd = F.col("sq"), F.col("nd")
        return self._statement(net_profit=sq - nd * 1.25, n_cashflow_act=sq, n_cashflow_inv_act=-nd, n_cash_flows_fnc_act=nd / 2.0, free_cashflow=sq - nd)

    def raw_forecast(self) -> DataFrame:
        """Forecasts of the years: quarters that end in December."""
        year, sq = self.quarters.where(F.col("end_date").endswith("1231")), F.col("sq")
        return year.select("ts_code", "ann_date", "end_date", F.lit("forecast").alias("type"), F.lit(-5.0).alias("p_change_min"), F.lit(5.0).alias("p_change_max"), (sq * 0.5).alias("net_profit_min"),
                           (sq * 2.0).alias("net_profit_max"), sq.alias("last_parent_net"), F.col("ann_date").alias("first_ann_date"), F.lit("").alias("summary"), F.lit("").alias("change_reason"))

    def raw_express(self) -> DataFrame:
        """Early figures of half-years: quarters that end in June or December."""
        half, sq, mh = self.quarters.where(F.col("end_date").rlike("(0630|1231)$")), F.col("sq"), F.col("mh")
        nul = F.lit(None).cast(DoubleType())
        return half.select("ts_code", "ann_date", "end_date", sq.alias("revenue"), (sq - F.col("nd")).alias("operate_profit"), (sq - F.col("nd")).alias("total_profit"), sq.alias("n_income"), (mh * 2.0).alias("total_assets"),
                           mh.alias("total_hldr_eqy_exc_min_int"), nul.alias("diluted_eps"), nul.alias("diluted_roe"), nul.alias("yoy_net_profit"))

    def raw_index_weight(self) -> DataFrame:
        w = self.benchmark_weight_snapshot_pit()
        return w.select(F.col("benchmark_id").alias("index_code"), F.col("security_id").alias("con_code"), "trade_date", "weight")

    def pit_fina_indicator(self) -> DataFrame:
        """Quarterly per supplier (quarters with shipments); announced k % 40
        days after period end; blank announcement for k % 19 = 0."""
        nul = F.lit(None).cast(DoubleType())
        return self.quarters.select(
            "ts_code", "ann_date", "end_date",
            (F.col("sq") / 1000.0).alias("eps"), (F.col("mh") / F.col("ml")).alias("roe"),
            (F.col("nd") / 100.0).alias("roa"), (F.col("ml") / F.col("mh")).alias("gross_margin"),
            nul.alias("netprofit_margin"), nul.alias("current_ratio"), nul.alias("debt_to_assets"),
            (F.col("sq") / 10.0).alias("revenue_ps"), nul.alias("netprofit_yoy"), nul.alias("dt_netprofit_yoy"),
            nul.alias("or_yoy"), nul.alias("q_sales_yoy"), nul.alias("assets_yoy"), nul.alias("equity_yoy"),
        )

    # ------------------------------------------------------ reference (PIT)
    def industry_classification_pit(self) -> DataFrame:
        """Per supplier (none for k % 13 = 0): sw2021_l1 = region code, changing
        to the next region on 1998-01-01 (not for k % 11 = 5); sw2021_l2 = nation
        code; other_l1 for even k.  Names NULL for k % 4 = 1."""
        s = self.read("supplier", "s_suppkey", "s_nationkey").withColumnRenamed("s_suppkey", "k")
        n = F.broadcast(self.read("nation", "n_nationkey", "n_name", "n_regionkey"))
        r = F.broadcast(self.read("region", "r_regionkey", "r_name"))
        j = s.where(_k() % 13 != 0).join(n, s.s_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == r.r_regionkey)
        k = _k()
        rk = F.col("n_regionkey")
        no_name = k % 4 == 1

        def nm(c: Column) -> Column:
            return F.when(no_name, F.lit(None).cast(StringType())).otherwise(c)

        def code(region: Column) -> Column:
            return F.concat(F.lit("8010"), region.cast(StringType()), F.lit("0.SI"))

        l1_old = j.where(k % 11 != 5).select(
            ts_code_of(k).alias("security_id"), F.lit("sw2021_l1").alias("industry_schema"), code(rk).alias("industry_code"),
            nm(F.col("r_name")).alias("industry_name"), F.lit("19950101").alias("effective_at"), F.lit("19980101").alias("removed_at"))
        l1_new = j.where(k % 11 != 5).select(
            ts_code_of(k).alias("security_id"), F.lit("sw2021_l1").alias("industry_schema"),
            code((rk + 1) % 5).alias("industry_code"), nm(F.concat(F.col("r_name"), F.lit("+"))).alias("industry_name"),
            F.lit("19980101").alias("effective_at"), F.lit("").alias("removed_at"))
        l2 = j.select(
            ts_code_of(k).alias("security_id"), F.lit("sw2021_l2").alias("industry_schema"),
            F.concat(F.lit("85"), F.lpad(F.col("s_nationkey").cast(StringType()), 4, "0"), F.lit(".SI")).alias("industry_code"),
            nm(F.col("n_name")).alias("industry_name"), F.lit("19950101").alias("effective_at"),
            F.lit(None).cast(StringType()).alias("removed_at"))
        other = j.where(k % 2 == 0).select(
            ts_code_of(k).alias("security_id"), F.lit("other_l1").alias("industry_schema"),
            F.concat(F.lit("OTH"), rk.cast(StringType())).alias("industry_code"), nm(F.col("r_name")).alias("industry_name"),
            F.lit("19960101").alias("effective_at"), F.lit("").alias("removed_at"))
        return l1_old.unionByName(l1_new).unionByName(l2).unionByName(other)

    def benchmark_weight_snapshot_pit(self) -> DataFrame:
        """Monthly snapshots: supplier k is a member in month index mi (months since
        1995-01) when it shipped that month and (k + mi) % 3 != 0; even k in
        benchmark 000300.SH, odd k in 000905.SH."""
        g = self.bars.select("ts_code", "k", F.trunc("d", "month").alias("month")).distinct()
        mi = (F.year("month") - 1995) * 12 + F.month("month") - 1
        k = _k()
        return g.where((k + mi) % 3 != 0).select(
            F.when(k % 2 == 0, F.lit("000300.SH")).otherwise(F.lit("000905.SH")).alias("benchmark_id"),
            ts_code_of(k).alias("security_id"),
            _text_date(F.col("month")).alias("trade_date"),
            ((k % 7 + 1).cast(DoubleType()) / 10.0).alias("weight"),
        )

    # ------------------------------------------------------------- indices
    @cached_property
    def event_days(self) -> DataFrame:
        e = self.read("events", "ts", "event_type", "value")
        return (e.groupBy("event_type", F.to_date("ts").alias("d")).agg(
            F.min("value").alias("mn"), F.max("value").alias("mx"), F.count(F.lit(1)).alias("cnt")
        ))

    def raw_index_daily(self) -> DataFrame:
        """One index per event type; daily bar from that day's event values."""
        e = self.event_days
        w = Window.partitionBy("event_type").orderBy("d")
        close = (F.col("mn") + F.col("mx")) / 2
        e = e.withColumn("close", close).withColumn("pre_close", F.lag("close").over(w))
        return e.select(
            F.concat(F.upper("event_type"), F.lit(".EV")).alias("ts_code"), _text_date(F.col("d")).alias("trade_date"),
            "close", F.col("mn").alias("open"), F.col("mx").alias("high"), F.col("mn").alias("low"), "pre_close",
            (F.col("close") - F.col("pre_close")).alias("change"),
            F.when(F.col("pre_close") != 0.0, (F.col("close") - F.col("pre_close")) / F.col("pre_close") * 100.0).alias("pct_chg"),
            F.col("cnt").cast(DoubleType()).alias("vol"), (F.col("mx") * F.col("cnt").cast(DoubleType())).alias("amount"),
            F.lit("index_daily").alias("source_table"), _ts(4).alias("ingested_at"),
        )

    def index_basic_ref(self) -> DataFrame:
        e = self.event_days.groupBy("event_type").agg(F.min("d").alias("first_day"), F.count(F.lit(1)).alias("days"))
        return e.select(
            F.concat(F.upper("event_type"), F.lit(".EV")).alias("ts_code"), F.col("event_type").alias("name"),
            F.lit("EVT").alias("market"), F.lit("driver").alias("publisher"), F.lit("event").alias("category"),
            _text_date(F.col("first_day")).alias("base_date"), F.lit(1000.0).alias("base_point"),
            _text_date(F.col("first_day")).alias("list_date"),
        )

    # ------------------------------------------------ alternative bar feeds
    def feed_a(self) -> DataFrame:
        """Unadjusted bars with Chinese column headers and ISO dates; the feed lacks days with (k + dno) % 17 = 0."""
        b = self.bars.where(((_k() + _dno()) % 11 != 0) & ((_k() + _dno()) % 17 != 0))
        return b.select(
            F.split_part("ts_code", F.lit("."), F.lit(1)).alias("symbol"),
            F.date_format("d", "yyyy-MM-dd").alias("日期"),
            F.col("open_u").alias("开盘"), F.col("close_u").alias("收盘"), F.col("hi").alias("最高"),
            F.col("lo").alias("最低"), F.col("vol_u").alias("成交量"), F.col("amount_u").alias("成交额"),
            F.col("pct_chg_u").alias("涨跌幅"), F.col("change_u").alias("涨跌额"),
        )

    def feed_b(self) -> DataFrame:
        """Unadjusted bars as all-text positional rows ('sz.000001' codes, ISO
        dates); the feed lacks days with (2k + dno) % 13 = 0; open blank when
        (k + dno) % 7 = 0, volume 'N/A' when (k + dno) % 19 = 0."""
        b = self.bars.where(((_k() + _dno()) % 11 != 0) & ((_k() * 2 + _dno()) % 13 != 0))
        kd = _k() + _dno()
        code = F.concat(
            F.lower(F.split_part("ts_code", F.lit("."), F.lit(2))), F.lit("."), F.split_part("ts_code", F.lit("."), F.lit(1))
        )

        def txt(c: str) -> Column:
            return F.col(c).cast(StringType())

        return b.select(
            code.alias("code"), F.date_format("d", "yyyy-MM-dd").alias("date"),
            F.when(kd % 7 == 0, F.lit("")).otherwise(txt("open_u")).alias("open"),
            txt("hi").alias("high"), txt("lo").alias("low"), txt("close_u").alias("close"),
            txt("pre_close_u").alias("preclose"),
            F.when(kd % 19 == 0, F.lit("N/A")).otherwise(txt("vol_u")).alias("volume"),
            txt("amount_u").alias("amount"), txt("pct_chg_u").alias("pctChg"),
        )

    # ------------------------------------------------ provider-shaped extras
    def provider_suspend_d(self) -> DataFrame:
        """Suspension rows as a provider delivers them: the day sometimes only in
        ``suspend_date`` (trade_date blank on even dno), the type sometimes only
        in ``reason_type`` (dno % 5 = 0), padded codes (dno % 7 = 0) and a
        'nan' timing word (dno % 11 = 0)."""
        b = self.bars
        r = (_k() * 7 + _dno()) % 101
        typ = F.when(r == 2, F.lit("R")).otherwise(F.lit("S"))
        timing = (
            F.when(_dno() % 11 == 0, F.lit("nan"))
            .when(r == 1, F.lit("09:30-10:30"))
            .when(r == 2, F.lit(None).cast(StringType()))
            .when(_dno() % 3 == 1, F.lit(FULL_DAY_TIMING))
            .otherwise(F.lit(""))
        )
        return b.where(r <= 2).select(
            F.when(_dno() % 7 == 0, F.concat(F.lit(" "), F.col("ts_code"), F.lit(" "))).otherwise(F.col("ts_code")).alias("ts_code"),
            F.when(_dno() % 2 == 0, F.lit("")).otherwise(F.col("trade_date")).alias("trade_date"),
            F.col("trade_date").alias("suspend_date"),
            timing.alias("suspend_timing"),
            F.when(_dno() % 5 == 0, F.lit(None).cast(StringType())).otherwise(typ).alias("suspend_type"),
            typ.alias("reason_type"),
        )

    def provider_dividend(self) -> DataFrame:
        """Dividends as a provider delivers them: all text, padded codes, sentinel words for what is missing, 'None' for a zero rate."""
        d = self.raw_dividend()
        word = {"stk_div": "nan", "stk_co_rate": "None", "cash_div_tax": " NaN ", "div_proc": "none", "div_listdate": "NaT"}
        texts = {c: F.coalesce(F.col(c).cast(StringType()), F.lit(word.get(c))) for c in d.columns if c not in ("ts_code", "stk_bo_rate", "source_table", "ingested_at")}
        return d.select(F.concat(F.lit(" "), F.col("ts_code")).alias("ts_code"), F.when(F.col("stk_bo_rate") == 0.0, "None").otherwise(F.col("stk_bo_rate").cast(StringType())).alias("stk_bo_rate"),
                        *[c.alias(n) for n, c in texts.items()])

    def provider_stk_limit(self) -> DataFrame:
        """Limits as text, 'nan' where there is none."""
        limits = self.raw_stk_limit()
        text = lambda c: F.coalesce(F.col(c).cast(StringType()), F.lit("nan")).alias(c)
        return limits.select(F.concat("ts_code", F.lit("  ")).alias("ts_code"), "trade_date", text("up_limit"), text("down_limit"))

    def provider_share_float(self) -> DataFrame:
        """Shares set free at each quarter's end: a padded holder, a share type in odd numbers of trading days only, no ratio in even ones."""
        odd = F.col("nd") % 2 == 1
        return self.quarters.select("ts_code", "ann_date", F.col("end_date").alias("float_date"), F.col("sq").cast(StringType()).alias("float_share"),
                                    F.when(odd, (F.col("nd") / 100.0).cast(StringType())).otherwise("nan").alias("float_ratio"), F.lit("  Holder ").alias("holder_name"),
                                    F.when(odd, "common").otherwise("None").alias("share_type"))

    def provider_repurchase(self) -> DataFrame:
        """Repurchases at the end of each year, with no end of their programme."""
        text = lambda c: F.col(c).cast(StringType())
        return self.quarters.where(F.col("end_date").endswith("1231")).select(
            "ts_code", "ann_date", "end_date", F.lit(" done ").alias("proc"), F.lit("NaT").alias("exp_date"), text("sq").alias("vol"), text("mh").alias("amount"), text("mh").alias("high_limit"), F.lit("").alias("low_limit"))

    def raw_share_float(self) -> DataFrame:
        return feeds.normalize_share_float_events(self.provider_share_float()).withColumn("ingested_at", _ts(2))

    def raw_repurchase(self) -> DataFrame:
        return feeds.normalize_repurchase_events(self.provider_repurchase()).withColumn("ingested_at", _ts(2))

    def raw_index_member_all(self) -> DataFrame:
        """Industry membership rows with three level codes per supplier: L1 by
        region, L2 by nation, L3 by nation and k % 3 (blank L3 for k % 5 = 0);
        a move to the next region's L1 on 1999-01-01 for k % 4 = 0, a second,
        conflicting L2 on the same day for k % 8 = 0, an exact duplicate row
        for k % 6 = 0 and a blank in_date for k % 7 = 3."""
        s = self.read("supplier", "s_suppkey", "s_name", "s_nationkey").withColumnRenamed("s_suppkey", "k")
        n = F.broadcast(self.read("nation", "n_nationkey", "n_name", "n_regionkey"))
        j = s.join(n, s.s_nationkey == n.n_nationkey)
        k = _k()
        nk, rk = F.col("s_nationkey"), F.col("n_regionkey")

        def code(prefix: str, v: Column) -> Column:
            return F.concat(F.lit(prefix), F.lpad(v.cast(StringType()), 3, "0"), F.lit(".SI"))

        def row(l1: Column, l2: Column, l3: Column, in_date: Column, out_date: Column) -> list[Column]:
            return [
                l1.alias("l1_code"), F.concat(F.lit("L1-"), l1).alias("l1_name"),
                l2.alias("l2_code"), F.concat(F.lit("L2-"), l2).alias("l2_name"),
                l3.alias("l3_code"), F.concat(F.lit("L3-"), l3).alias("l3_name"),
                ts_code_of(k).alias("ts_code"), F.col("s_name").alias("name"),
                in_date.alias("in_date"), out_date.alias("out_date"), F.lit("Y").alias("is_new"),
            ]

        l3 = F.when(k % 5 == 0, F.lit("")).otherwise(code("853", nk * 10 + k % 3))
        first = j.select(*row(code("851", rk), code("852", nk), l3,
                              F.when(k % 7 == 3, F.lit("")).otherwise(F.lit("19950101")),
                              F.when(k % 4 == 0, F.lit("19990101")).otherwise(F.lit(None).cast(StringType()))))
        moved = j.where(k % 4 == 0).select(*row(code("851", (rk + 1) % 5), code("852", nk), l3, F.lit("19990101"),
                                                F.lit(None).cast(StringType())))
        conflict = j.where(k % 8 == 0).select(*row(code("851", (rk + 1) % 5), code("852", nk + 30), l3, F.lit("19990101"),
                                                   F.lit(None).cast(StringType())))
        dup = j.where(k % 6 == 0).select(*row(code("851", rk), code("852", nk), l3,
                                              F.when(k % 7 == 3, F.lit("")).otherwise(F.lit("19950101")),
                                              F.when(k % 4 == 0, F.lit("19990101")).otherwise(F.lit(None).cast(StringType()))))
        return first.unionByName(moved).unionByName(conflict).unionByName(dup)

    def raw_trade_cal(self) -> DataFrame:
        """Exchange calendar from the order days; weekends closed."""
        o = self.read("orders", "o_orderdate").select(F.to_date("o_orderdate").alias("d")).distinct()
        w = Window.orderBy("d")
        return o.select(
            F.lit("SSE").alias("exchange"), _text_date(F.col("d")).alias("cal_date"),
            F.when(F.dayofweek("d").isin(1, 7), F.lit(0)).otherwise(F.lit(1)).alias("is_open"),
            _text_date(F.lag("d").over(w)).alias("pretrade_date"),
            _ts(0).alias("ingested_at"), F.lit("trade_cal").alias("source_table"),
        )

    # ----------------------------------------------- official industry packet
    def _nations(self) -> DataFrame:
        n = self.read("nation", "n_nationkey", "n_name", "n_regionkey")
        r = self.read("region", "r_regionkey", "r_name")
        return n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select(
            F.col("n_nationkey").alias("nk"), "n_name", F.col("n_regionkey").alias("rk"), "r_name")

    @staticmethod
    def _code(v: Column) -> Column:
        return v.cast(StringType())

    def official_codes(self) -> DataFrame:
        """Code table: L1 = 110000 + 10000 r, L2 = L1 + 100 (n + 1), L3 = L2 + j
        (j = 1..3); a later duplicate L1 row for region 0 (code 110009), a
        code whose names resolve to nothing (990000) and one with a level-3
        name only (990001)."""
        nat = self._nations()
        reg = self.read("region", "r_regionkey", "r_name")
        l1 = reg.select(self._code(F.lit(110000) + F.col("r_regionkey") * 10000).alias("行业代码"), F.col("r_name").alias("一级行业名称"),
                        F.lit("").alias("二级行业名称"), F.lit("").alias("三级行业名称"))
        dup = reg.where(F.col("r_regionkey") == 0).select(F.lit("110009").alias("行业代码"), F.col("r_name").alias("一级行业名称"),
                                                           F.lit("").alias("二级行业名称"), F.lit("").alias("三级行业名称"))
        odd = reg.where(F.col("r_regionkey") == 0).select(
            F.explode(F.array(
                F.struct(F.lit("990000").alias("行业代码"), F.lit("GHOST").alias("一级行业名称"), F.lit("G2").alias("二级行业名称"),
                         F.lit("").alias("三级行业名称")),
                F.struct(F.lit("990001").alias("行业代码"), F.lit("UNMAPPED").alias("一级行业名称"), F.lit("").alias("二级行业名称"),
                         F.lit("x").alias("三级行业名称")),
            )).alias("_r")).select("_r.*")
        l2code = F.lit(110000) + F.col("rk") * 10000 + (F.col("nk") + 1) * 100
        l2 = nat.select(self._code(l2code).alias("行业代码"), F.col("r_name").alias("一级行业名称"), F.col("n_name").alias("二级行业名称"),
                        F.lit("").alias("三级行业名称"))
        l3 = nat.select("*", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("j")).select(
            self._code(l2code + F.col("j")).alias("行业代码"), F.col("r_name").alias("一级行业名称"), F.col("n_name").alias("二级行业名称"),
            F.concat(F.col("n_name"), F.lit("-"), F.col("j").cast(StringType())).alias("三级行业名称"))
        rows = l1.unionByName(dup).unionByName(odd).unionByName(l2).unionByName(l3)
        return rows.withColumn("row_no", F.dense_rank().over(Window.orderBy("行业代码")).cast("bigint"))

    def official_crosswalk(self) -> DataFrame:
        """Old -> new sheet (8 positional text columns, row order ``row_no``):
        a section row per region (old 6r0000 -> new L1), one row per (nation,
        j) old L3 -> new L3; nations with n % 6 = 5 are missing; n % 4 = 0
        maps j = 1 twice (ambiguous); n % 5 = 1, j = 3 points at a code
        outside the table; j = 2 codes are written as '...0' floats."""
        nat = self._nations()
        reg = self.read("region", "r_regionkey", "r_name")
        head = reg.select(
            (F.col("r_regionkey") * 1000).cast("bigint").alias("row_no"), F.lit("section").alias("c0"), F.col("r_name").alias("c1"),
            F.lit("").alias("c2"), self._code(F.lit(610000) + F.col("r_regionkey") * 10000).alias("c3"), F.lit("").alias("c4"),
            F.lit("").alias("c5"), F.lit("").alias("c6"), self._code(F.lit(110000) + F.col("r_regionkey") * 10000).alias("c7"))
        rows = nat.where(F.col("nk") % 6 != 5).select("*", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("j"))
        old = F.lit(610000) + F.col("rk") * 10000 + (F.col("nk") + 1) * 100 + F.col("j")
        new = F.lit(110000) + F.col("rk") * 10000 + (F.col("nk") + 1) * 100 + F.col("j")
        old_txt = F.when(F.col("j") == 2, F.concat(self._code(old), F.lit(".0"))).otherwise(self._code(old))
        new_txt = F.when((F.col("nk") % 5 == 1) & (F.col("j") == 3), F.lit("999999")).otherwise(self._code(new))
        body = rows.select(
            (F.col("rk") * 1000 + (F.col("nk") + 1) * 10 + F.col("j")).cast("bigint").alias("row_no"), F.lit("item").alias("c0"),
            F.col("n_name").alias("c1"), F.lit("").alias("c2"), old_txt.alias("c3"), F.lit("").alias("c4"), F.lit("").alias("c5"),
            F.lit("").alias("c6"), new_txt.alias("c7"))
        amb = rows.where((F.col("nk") % 4 == 0) & (F.col("j") == 1)).select(
            (F.col("rk") * 1000 + (F.col("nk") + 1) * 10 + 5).cast("bigint").alias("row_no"), F.lit("item").alias("c0"),
            F.col("n_name").alias("c1"), F.lit("").alias("c2"), self._code(old).alias("c3"), F.lit("").alias("c4"),
            F.lit("").alias("c5"), F.lit("").alias("c6"), self._code(new + 1).alias("c7"))
        return head.unionByName(body).unionByName(amb)

    def _supplier_codes(self) -> DataFrame:
        s = self.read("supplier", "s_suppkey", "s_nationkey").withColumnRenamed("s_suppkey", "k")
        nat = self._nations()
        j = s.join(F.broadcast(nat), s.s_nationkey == nat.nk)
        jj = (_k() % 3 + 1)
        base = F.col("rk") * 10000 + (F.col("nk") + 1) * 100
        symbol = F.concat(_case_by(_k() % 6, SYMBOL_PREFIXES), zfill(_k().cast(StringType()), 3))
        return j.select(
            "k", "nk", "rk", symbol.alias("symbol"),
            (F.lit(610000) + base + jj).alias("old_code"), (F.lit(610000) + base + (jj % 3 + 1)).alias("old_code2"),
            (F.lit(110000) + base + jj).alias("new_code"), (F.lit(110000) + base).alias("new_l2"),
        )

    def official_ledger(self) -> DataFrame:
        """Stock ledger rows (see ``plans.industry``): an old code in 1995, a
        change in 1997 for even k (re-issued with a later update for k % 10 = 0),
        a 1990 placeholder for k % 11 = 0, a record at the window start for
        k % 13 = 0, a new code after the 1999-07-30 cutover (not for k % 4 = 1)
        and one on the cutover day for k % 7 = 2."""
        c = self._supplier_codes()
        k = _k()
        code_text = (
            F.when(k % 4 == 1, F.regexp_replace(F.col("symbol"), "^0+", ""))
            .when(k % 4 == 2, F.concat(F.col("symbol"), F.lit(".0")))
            .otherwise(F.col("symbol"))
        )
        upd_blank = k % 9 == 4

        def rec(idx: int, when: Column, eff: Column, code: Column, upd: Column) -> DataFrame:
            return c.where(when).select(
                code_text.alias("股票代码"), eff.alias("计入日期"), code.cast(StringType()).alias("行业代码"),
                F.when(upd_blank, F.lit("")).otherwise(upd).alias("更新日期"), (k * 10 + idx).cast("bigint").alias("row_no"))

        def ts(day: Column, time: str = "00:00:00") -> Column:
            return F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" " + time))

        d95 = F.date_add(F.lit(_dt.date(1995, 3, 1)), (k % 28).cast("int"))
        d97 = F.date_add(F.lit(_dt.date(1997, 5, 1)), (k % 50).cast("int"))
        d99 = F.date_add(F.lit(_dt.date(1999, 8, 15)), (k % 20).cast("int"))
        parts = [
            rec(0, F.lit(True), ts(d95), F.col("old_code"), ts(d95)),
            rec(1, k % 2 == 0, ts(d97, "09:30:00"), F.col("old_code2"), F.lit("1997-06-01 00:00:00")),
            rec(2, k % 10 == 0, ts(d97, "09:30:00"), F.col("old_code"), F.lit("1997-07-01 00:00:00")),
            rec(3, k % 11 == 0, F.lit("1990-01-01 00:00:00"), F.col("old_code"), F.lit("1990-01-01 00:00:00")),
            rec(4, k % 13 == 0, F.lit("1996-02-21 00:00:00"), F.col("old_code2"), F.lit("1996-02-21 00:00:00")),
            rec(5, k % 4 != 1, ts(d99), F.col("new_code"), ts(d99)),
            rec(6, k % 7 == 2, F.lit("1999-07-30 10:00:00"), F.col("new_code"), F.lit("1999-07-30 10:00:00")),
        ]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def official_snapshot(self) -> DataFrame:
        """Cutover snapshot: every supplier with its new L3 code (its L2 code for
        k % 6 = 1), marked as B shares for k % 9 = 8."""
        c = self._supplier_codes()
        k = _k()
        return c.select(
            F.when(k % 9 == 8, F.lit("B股")).otherwise(F.lit("A股")).alias("交易所"),
            F.when(k % 6 == 1, F.col("new_l2")).otherwise(F.col("new_code")).cast(StringType()).alias("行业代码"),
            F.col("symbol").alias("股票代码"),
            k.cast("bigint").alias("row_no"),
        )


# Provider tables that are row-wise projections of the stored bar spine: they
# are re-projected on use rather than stored a second time.
SPINE_PROJECTIONS = frozenset({
    "raw_daily_basic", "raw_kline_unadj", "raw_kline_qfq", "raw_adj_factor", "raw_stk_limit", "raw_suspend_d",
    "feed_a", "feed_b", "provider_suspend_d",
})


@dataclass
class RawSources:
    """The two provider databases as dicts of DataFrames (source, supplemental)."""

    source: Mapping[str, DataFrame]
    supplemental: Mapping[str, DataFrame]
    feeds: Mapping[str, DataFrame] | None = None


class LazyFrames(Mapping):
    """Name -> DataFrame, each built on first access (building a DataFrame
    costs analysis round trips even before any job runs)."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders, self._built = builders, {}

    def __getitem__(self, key: str) -> DataFrame:
        if key not in self._built:
            self._built[key] = self._builders[key]()
        return self._built[key]

    def __contains__(self, key: object) -> bool:
        return key in self._builders

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def raw_sources(spark: SparkSession, sf_dir: str, keep=None) -> RawSources:
    t = DriverTables(spark, sf_dir, keep)
    source = LazyFrames({
        "stock_basic_ref": t.stock_basic_ref,
        "raw_namechange": t.raw_namechange,
        "raw_daily_basic": t.raw_daily_basic,
        "raw_kline_unadj": t.raw_kline_unadj,
        "raw_kline_qfq": t.raw_kline_qfq,
        "raw_adj_factor": t.raw_adj_factor,
        "raw_dividend": t.raw_dividend,
        "raw_stk_limit": t.raw_stk_limit,
        "raw_suspend_d": t.raw_suspend_d,
        "pit_fina_indicator": t.pit_fina_indicator,
        "raw_trade_cal": t.raw_trade_cal,
        "raw_index_member_all": t.raw_index_member_all,
        "raw_index_weight": t.raw_index_weight,
        "raw_income": t.raw_income,
        "raw_balancesheet": t.raw_balancesheet,
        "raw_cashflow": t.raw_cashflow,
        "raw_forecast": t.raw_forecast,
        "raw_express": t.raw_express,
        "raw_share_float": t.raw_share_float,
        "raw_repurchase": t.raw_repurchase,
    })
    supplemental = LazyFrames({
        "industry_classification_pit": t.industry_classification_pit,
        "benchmark_weight_snapshot_pit": t.benchmark_weight_snapshot_pit,
        "index_basic_ref": t.index_basic_ref,
        "raw_index_daily": t.raw_index_daily,
        "raw_stk_limit": t.supplemental_stk_limit,
    })
    frames = LazyFrames({"feed_a": t.feed_a, "feed_b": t.feed_b, "provider_suspend_d": t.provider_suspend_d,
                        "provider_dividend": t.provider_dividend, "provider_stk_limit": t.provider_stk_limit,
                        "provider_share_float": t.provider_share_float, "provider_repurchase": t.provider_repurchase,
                        "official_codes": t.official_codes, "official_crosswalk": t.official_crosswalk,
                        "official_ledger": t.official_ledger, "official_snapshot": t.official_snapshot})
    return RawSources(source, supplemental, frames)
