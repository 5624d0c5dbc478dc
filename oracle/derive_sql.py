"""DuckDB CTEs that derive the raw provider layer from the driver views.

An independent second writing of the rules in ``pitspark/sources/derive.py``
(same arithmetic order, every literal cast to DOUBLE so DuckDB does not switch
to DECIMAL arithmetic).
"""

from __future__ import annotations


def D(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def TS(hours: str | int) -> str:
    return f"(TIMESTAMP '2024-01-02 00:00:00' + to_hours(CAST({hours} AS BIGINT)))"


DNUM = "CASE WHEN length(CAST(k AS VARCHAR)) >= 3 THEN CAST(k AS VARCHAR) ELSE lpad(CAST(k AS VARCHAR), 3, '0') END"
PREFIX = ("CASE k % 6 WHEN 0 THEN '000' WHEN 1 THEN '300' WHEN 2 THEN '301' WHEN 3 THEN '600' "
          "WHEN 4 THEN '688' ELSE '920' END")
SUFFIX = ("CASE WHEN k % 17 = 16 THEN 'HK' ELSE CASE k % 6 WHEN 3 THEN 'SH' WHEN 4 THEN 'SH' "
          "WHEN 5 THEN 'BJ' ELSE 'SZ' END END")
SYMBOL = f"({PREFIX} || {DNUM})"
TS_CODE = f"({SYMBOL} || '.' || {SUFFIX})"
FACTOR = (f"({D(1.0)} + {D(0.1)} * CAST(floor(dno / 365) AS DOUBLE) "
          f"+ CASE WHEN k % 3 = 0 AND dno >= 1200 THEN {D(0.004)} ELSE {D(0.0)} END)")
TXT = "strftime({0}, '%Y%m%d')"


def txt(x: str) -> str:
    return f"strftime({x}, '%Y%m%d')"


CTES: list[tuple[str, str]] = [
    ("g_groups", f"""
        SELECT l_suppkey AS k, CAST(l_shipdate AS DATE) AS d,
               min(l_extendedprice) AS lo, max(l_extendedprice) AS hi,
               sum(l_quantity) AS q, count(*) AS n,
               date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS dno
        FROM lineitem GROUP BY 1, 2"""),
    ("g_bars0", f"""
        SELECT k, d, dno, lo, hi, q, n,
               CASE WHEN (k * 3 + dno) % 211 = 0 THEN {D(0.0)} ELSE (2 * lo + hi) / 3 END AS open_u,
               (lo + 2 * hi) / 3 AS close_u,
               {FACTOR} AS f
        FROM g_groups"""),
    ("g_bars1", """
        SELECT *, lag(close_u) OVER (PARTITION BY k ORDER BY d) AS prev_close,
                  lag(f) OVER (PARTITION BY k ORDER BY d) AS f_prev
        FROM g_bars0"""),
    ("g_bars2", """
        SELECT *, CASE WHEN prev_close IS NULL THEN open_u
                       WHEN k % 10 IN (3, 4) AND f_prev <> f THEN prev_close * f_prev / f
                       ELSE prev_close END AS pre_close_u
        FROM g_bars1"""),
    ("g_bars", f"""
        SELECT *, {TS_CODE} AS ts_code, {txt('d')} AS trade_date,
               close_u - pre_close_u AS change_u,
               CASE WHEN pre_close_u <> {D(0.0)} THEN (close_u - pre_close_u) / pre_close_u * {D(100.0)} END AS pct_chg_u,
               CASE WHEN (k * 7 + dno) % 101 = 0 THEN {D(0.0)} ELSE q END AS vol_u,
               CASE WHEN (k * 7 + dno) % 101 = 0 THEN {D(0.0)} ELSE lo END AS amount_u
        FROM g_bars2"""),
    ("stock_basic_ref", f"""
        SELECT {TS_CODE} AS ts_code, {SYMBOL} AS symbol, s_name AS name, r_name AS area,
               n_name AS industry, '19950101' AS list_date,
               CASE WHEN k % 23 = 0 THEN '20011231' ELSE '' END AS delist_date,
               CASE k % 3 WHEN 0 THEN 'N' WHEN 1 THEN 'H' ELSE 'S' END AS is_hs,
               {TS(0)} AS ingested_at, 'stock_basic' AS source_table
        FROM (SELECT s_suppkey AS k, * FROM supplier) s
        LEFT JOIN nation ON s.s_nationkey = nation.n_nationkey
        LEFT JOIN region ON nation.n_regionkey = region.r_regionkey"""),
    ("raw_namechange", f"""
        WITH s AS (SELECT s_suppkey AS k, s_name FROM supplier)
        SELECT *, 'namechange' AS source_table, {TS(0)} AS ingested_at FROM (
            SELECT {TS_CODE} AS ts_code, s_name AS name, '19950101' AS start_date, '' AS end_date,
                   '19941220' AS ann_date, 'listing' AS change_reason FROM s
            UNION ALL
            SELECT {TS_CODE}, 'ST ' || s_name, CASE WHEN k % 27 = 0 THEN NULL ELSE '19970101' END,
                   CASE WHEN k % 18 = 0 THEN '' ELSE '19980101' END, '19961215', 'ST' FROM s WHERE k % 9 = 0
            UNION ALL
            SELECT {TS_CODE}, s_name || 'B', '19990301', '19990630', '19990225', '*ST' FROM s WHERE k % 9 = 4
        )"""),
    ("raw_daily_basic", f"""
        SELECT ts_code, trade_date, close_u AS close, q / {D(100.0)} AS turnover_rate,
               q / {D(50.0)} AS turnover_rate_f, CAST(n AS DOUBLE) AS volume_ratio, hi / lo AS pe,
               lo / {D(10.0)} AS pe_ttm, hi / {D(100.0)} AS pb, lo / {D(100.0)} AS ps,
               NULL::DOUBLE AS ps_ttm, NULL::DOUBLE AS dv_ratio, NULL::DOUBLE AS dv_ttm,
               CAST(k + 1000 AS DOUBLE) AS total_share, CAST(k + 600 AS DOUBLE) AS float_share,
               CAST(k + 300 AS DOUBLE) AS free_share, close_u * CAST(k + 1000 AS DOUBLE) AS total_mv,
               close_u * CAST(k + 600 AS DOUBLE) AS circ_mv, 'daily_basic' AS source_table,
               {TS(5)} AS ingested_at
        FROM g_bars"""),
    ("raw_kline_unadj", f"""
        SELECT ts_code, trade_date, open_u AS open, hi AS high, lo AS low, close_u AS close,
               pre_close_u AS pre_close, change_u AS change, pct_chg_u AS pct_chg, vol_u AS vol,
               amount_u AS amount, 'daily' AS source_table, {TS(6)} AS ingested_at
        FROM g_bars WHERE (k + dno) % 11 <> 0"""),
    ("raw_kline_qfq", f"""
        SELECT ts_code, trade_date, open_u * f AS open, hi * f AS high, lo * f AS low, close_u * f AS close,
               pre_close_u * f AS pre_close, change_u * f AS change, pct_chg_u AS pct_chg, vol_u AS vol,
               amount_u AS amount, 'daily_qfq' AS source_table, {TS(7)} AS ingested_at
        FROM g_bars WHERE (k + dno) % 13 <> 0"""),
    ("raw_adj_factor", f"""
        SELECT ts_code, trade_date, CASE WHEN (k + dno) % 307 = 0 THEN {D(0.0)} ELSE f END AS adj_factor,
               'adj_factor' AS source_table, {TS('k % 9')} AS ingested_at
        FROM g_bars WHERE (k + dno) % 29 <> 0"""),
    ("g_div_first", """
        SELECT k, CAST(floor(dno / 365) AS BIGINT) AS m, min(d) AS first_day
        FROM g_groups
        WHERE CAST(floor(dno / 365) AS BIGINT) >= 1 AND k % 5 <> 4
        GROUP BY 1, 2"""),
    ("g_div_ex", """
        SELECT *, CASE WHEN k % 5 = 0 THEN b WHEN k % 5 = 1 THEN first_day
                       WHEN k % 5 = 2 THEN b - 20 ELSE b + 70 END AS ex
        FROM (SELECT *, DATE '1995-01-01' + CAST(m * 365 AS INTEGER) AS b FROM g_div_first)"""),
    ("raw_dividend", f"""
        SELECT {TS_CODE} AS ts_code, CAST(year(b) - 1 AS VARCHAR) || '1231' AS end_date,
               {txt('b - 40')} AS ann_date,
               CASE WHEN k % 5 <> 1 THEN '实施' WHEN m = 3 THEN NULL ELSE '预案' END AS div_proc,
               CASE WHEN m % 3 = 0 THEN {D(0.1)} ELSE NULL::DOUBLE END AS stk_div,
               CASE WHEN m % 2 = 0 THEN {D(0.2)} ELSE {D(0.0)} END AS stk_bo_rate,
               NULL::DOUBLE AS stk_co_rate,
               {D(0.04)} * CAST(k % 4 + 1 AS DOUBLE) AS cash_div,
               CASE WHEN m % 2 = 1 THEN {D(0.05)} * CAST(k % 4 + 1 AS DOUBLE) ELSE NULL::DOUBLE END AS cash_div_tax,
               {txt('ex - 1')} AS record_date,
               CASE WHEN k % 35 = 0 AND m = 6 THEN '20001345' ELSE {txt('ex')} END AS ex_date,
               CASE WHEN m % 2 = 1 THEN {txt('ex + 3')} WHEN m = 4 THEN '' ELSE NULL END AS pay_date,
               NULL::VARCHAR AS div_listdate, 'dividend' AS source_table, {TS(1)} AS ingested_at
        FROM g_div_ex"""),
    ("raw_suspend_d", f"""
        SELECT ts_code, trade_date,
               CASE WHEN r = 1 THEN '09:30-10:30' WHEN r = 2 THEN NULL
                    WHEN dno % 3 = 0 THEN '' WHEN dno % 3 = 1 THEN '全天停牌' ELSE NULL END AS suspend_timing,
               CASE WHEN r = 2 THEN 'R' ELSE 'S' END AS suspend_type,
               'suspend_d' AS source_table, {TS(2)} AS ingested_at
        FROM (SELECT *, (k * 7 + dno) % 101 AS r FROM g_bars) WHERE r <= 2"""),
    ("g_limits", f"""
        SELECT k, dno, ts_code, trade_date,
               CASE WHEN (k + dno) % 37 = 0 THEN lo ELSE pre_close_u * {D(1.1)} END AS up_limit,
               CASE WHEN (k + dno) % 43 = 0 THEN NULL::DOUBLE WHEN (k + dno) % 41 = 0 THEN hi
                    ELSE pre_close_u * {D(0.9)} END AS down_limit,
               pre_close_u AS pre_close
        FROM g_bars"""),
    ("raw_stk_limit", f"""
        SELECT ts_code, trade_date, up_limit, down_limit, pre_close, 'stk_limit' AS source_table,
               {TS(3)} AS ingested_at
        FROM g_limits WHERE (k + dno) % 4 <> 0"""),
    ("sup_raw_stk_limit", f"""
        SELECT ts_code, trade_date,
               CASE WHEN k % 2 = 0 THEN up_limit + {D(0.01)} WHEN k % 10 = 1 THEN up_limit + {D(0.02)}
                    WHEN k % 10 = 3 THEN up_limit * {D(2.0)} ELSE up_limit END AS up_limit,
               CASE WHEN k % 2 = 0 THEN down_limit - {D(0.01)} ELSE down_limit END AS down_limit,
               pre_close, 'stk_limit_supplemental' AS source_table,
               CASE WHEN k % 2 = 0 THEN {TS(27)} WHEN k % 10 = 1 THEN {TS(3)}
                    WHEN k % 10 = 3 THEN NULL::TIMESTAMP ELSE {TS(51)} END AS ingested_at
        FROM g_limits
        WHERE ((k + dno) % 4 <> 0 AND (k % 2 = 0 OR k % 10 = 1 OR k % 10 = 3))
           OR ((k + dno) % 4 = 0 AND k % 10 = 5)"""),
    ("pit_fina_indicator", f"""
        SELECT {TS_CODE} AS ts_code,
               CASE WHEN k % 19 = 0 THEN '' ELSE {txt('qe + CAST(k % 40 AS INTEGER)')} END AS ann_date,
               {txt('qe')} AS end_date, sq / {D(1000.0)} AS eps, mh / ml AS roe,
               CAST(nd AS DOUBLE) / {D(100.0)} AS roa, ml / mh AS gross_margin,
               NULL::DOUBLE AS netprofit_margin, NULL::DOUBLE AS current_ratio, NULL::DOUBLE AS debt_to_assets,
               sq / {D(10.0)} AS revenue_ps, NULL::DOUBLE AS netprofit_yoy, NULL::DOUBLE AS dt_netprofit_yoy,
               NULL::DOUBLE AS or_yoy, NULL::DOUBLE AS q_sales_yoy, NULL::DOUBLE AS assets_yoy,
               NULL::DOUBLE AS equity_yoy
        FROM (
            SELECT k, last_day(CAST(date_trunc('quarter', d) AS DATE) + INTERVAL 2 MONTH)::DATE AS qe,
                   sum(q) AS sq, max(hi) AS mh, min(lo) AS ml, count(*) AS nd
            FROM g_groups GROUP BY 1, 2)"""),
    ("g_industry_base", """
        SELECT s_suppkey AS k, s_nationkey, n_name, n_regionkey AS rk, r_name
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        WHERE s_suppkey % 13 <> 0"""),
    ("industry_classification_pit", f"""
        SELECT {TS_CODE} AS security_id, 'sw2021_l1' AS industry_schema, '8010' || CAST(rk AS VARCHAR) || '0.SI' AS industry_code,
               CASE WHEN k % 4 = 1 THEN NULL ELSE r_name END AS industry_name, '19950101' AS effective_at,
               '19980101' AS removed_at
        FROM g_industry_base WHERE k % 11 <> 5
        UNION ALL
        SELECT {TS_CODE}, 'sw2021_l1', '8010' || CAST((rk + 1) % 5 AS VARCHAR) || '0.SI',
               CASE WHEN k % 4 = 1 THEN NULL ELSE r_name || '+' END, '19980101', ''
        FROM g_industry_base WHERE k % 11 <> 5
        UNION ALL
        SELECT {TS_CODE}, 'sw2021_l2', '85' || lpad(CAST(s_nationkey AS VARCHAR), 4, '0') || '.SI',
               CASE WHEN k % 4 = 1 THEN NULL ELSE n_name END, '19950101', NULL
        FROM g_industry_base
        UNION ALL
        SELECT {TS_CODE}, 'other_l1', 'OTH' || CAST(rk AS VARCHAR),
               CASE WHEN k % 4 = 1 THEN NULL ELSE r_name END, '19960101', ''
        FROM g_industry_base WHERE k % 2 = 0"""),
    ("benchmark_weight_snapshot_pit", f"""
        SELECT CASE WHEN k % 2 = 0 THEN '000300.SH' ELSE '000905.SH' END AS benchmark_id,
               {TS_CODE} AS security_id, {txt('month')} AS trade_date,
               CAST(k % 7 + 1 AS DOUBLE) / {D(10.0)} AS weight
        FROM (SELECT DISTINCT k, CAST(date_trunc('month', d) AS DATE) AS month FROM g_groups)
        WHERE (k + (year(month) - 1995) * 12 + month(month) - 1) % 3 <> 0"""),
    ("g_event_days", """
        SELECT event_type, CAST(ts AS DATE) AS d, min(value) AS mn, max(value) AS mx, count(*) AS cnt
        FROM events GROUP BY 1, 2"""),
    ("raw_index_daily", f"""
        SELECT upper(event_type) || '.EV' AS ts_code, {txt('d')} AS trade_date, close, mn AS open, mx AS high,
               mn AS low, pre_close, close - pre_close AS change,
               CASE WHEN pre_close <> {D(0.0)} THEN (close - pre_close) / pre_close * {D(100.0)} END AS pct_chg,
               CAST(cnt AS DOUBLE) AS vol, mx * CAST(cnt AS DOUBLE) AS amount, 'index_daily' AS source_table,
               {TS(4)} AS ingested_at
        FROM (SELECT *, lag(close) OVER (PARTITION BY event_type ORDER BY d) AS pre_close
              FROM (SELECT *, (mn + mx) / 2 AS close FROM g_event_days))"""),
    ("index_basic_ref", f"""
        SELECT upper(event_type) || '.EV' AS ts_code, event_type AS name, 'EVT' AS market, 'driver' AS publisher,
               'event' AS category, {txt('first_day')} AS base_date, {D(1000.0)} AS base_point,
               {txt('first_day')} AS list_date
        FROM (SELECT event_type, min(d) AS first_day FROM g_event_days GROUP BY 1)"""),
    ("feed_a", """
        SELECT split_part(ts_code, '.', 1) AS symbol, strftime(d, '%Y-%m-%d') AS "日期",
               open_u AS "开盘", close_u AS "收盘", hi AS "最高", lo AS "最低", vol_u AS "成交量",
               amount_u AS "成交额", pct_chg_u AS "涨跌幅", change_u AS "涨跌额"
        FROM g_bars WHERE (k + dno) % 11 <> 0 AND (k + dno) % 17 <> 0"""),
    ("feed_b", """
        SELECT lower(split_part(ts_code, '.', 2)) || '.' || split_part(ts_code, '.', 1) AS code,
               strftime(d, '%Y-%m-%d') AS date,
               CASE WHEN (k + dno) % 7 = 0 THEN '' ELSE CAST(open_u AS VARCHAR) END AS open,
               CAST(hi AS VARCHAR) AS high, CAST(lo AS VARCHAR) AS low, CAST(close_u AS VARCHAR) AS close,
               CAST(pre_close_u AS VARCHAR) AS preclose,
               CASE WHEN (k + dno) % 19 = 0 THEN 'N/A' ELSE CAST(vol_u AS VARCHAR) END AS volume,
               CAST(amount_u AS VARCHAR) AS amount, CAST(pct_chg_u AS VARCHAR) AS "pctChg"
        FROM g_bars WHERE (k + dno) % 11 <> 0 AND (2 * k + dno) % 13 <> 0"""),
]

CTES += [
    ("provider_suspend_d", """
        SELECT CASE WHEN dno % 7 = 0 THEN ' ' || ts_code || ' ' ELSE ts_code END AS ts_code,
               CASE WHEN dno % 2 = 0 THEN '' ELSE trade_date END AS trade_date,
               trade_date AS suspend_date,
               CASE WHEN dno % 11 = 0 THEN 'nan' WHEN r = 1 THEN '09:30-10:30' WHEN r = 2 THEN NULL
                    WHEN dno % 3 = 1 THEN '全天停牌' ELSE '' END AS suspend_timing,
               CASE WHEN dno % 5 = 0 THEN NULL WHEN r = 2 THEN 'R' ELSE 'S' END AS suspend_type,
               CASE WHEN r = 2 THEN 'R' ELSE 'S' END AS reason_type
        FROM (SELECT *, (k * 7 + dno) % 101 AS r FROM g_bars) WHERE r <= 2"""),
    ("g_member_base", """
        SELECT s_suppkey AS k, s_name, s_nationkey AS nk, n_regionkey AS rk
        FROM supplier JOIN nation ON s_nationkey = n_nationkey"""),
    ("g_member_rows", """
        SELECT k, s_name, '851' || lpad(CAST(rk AS VARCHAR), 3, '0') || '.SI' AS l1,
               '852' || lpad(CAST(nk AS VARCHAR), 3, '0') || '.SI' AS l2,
               CASE WHEN k % 7 = 3 THEN '' ELSE '19950101' END AS in_date,
               CASE WHEN k % 4 = 0 THEN '19990101' ELSE NULL END AS out_date
        FROM g_member_base
        UNION ALL
        SELECT k, s_name, '851' || lpad(CAST((rk + 1) % 5 AS VARCHAR), 3, '0') || '.SI',
               '852' || lpad(CAST(nk AS VARCHAR), 3, '0') || '.SI', '19990101', NULL
        FROM g_member_base WHERE k % 4 = 0
        UNION ALL
        SELECT k, s_name, '851' || lpad(CAST((rk + 1) % 5 AS VARCHAR), 3, '0') || '.SI',
               '852' || lpad(CAST(nk + 30 AS VARCHAR), 3, '0') || '.SI', '19990101', NULL
        FROM g_member_base WHERE k % 8 = 0
        UNION ALL
        SELECT k, s_name, '851' || lpad(CAST(rk AS VARCHAR), 3, '0') || '.SI',
               '852' || lpad(CAST(nk AS VARCHAR), 3, '0') || '.SI',
               CASE WHEN k % 7 = 3 THEN '' ELSE '19950101' END, CASE WHEN k % 4 = 0 THEN '19990101' ELSE NULL END
        FROM g_member_base WHERE k % 6 = 0"""),
    ("raw_index_member_all", f"""
        SELECT m.l1 AS l1_code, 'L1-' || m.l1 AS l1_name, m.l2 AS l2_code, 'L2-' || m.l2 AS l2_name,
               CASE WHEN m.k % 5 = 0 THEN '' ELSE '853' || lpad(CAST(b.nk * 10 + m.k % 3 AS VARCHAR), 3, '0') || '.SI' END AS l3_code,
               'L3-' || CASE WHEN m.k % 5 = 0 THEN '' ELSE '853' || lpad(CAST(b.nk * 10 + m.k % 3 AS VARCHAR), 3, '0') || '.SI' END AS l3_name,
               (SELECT {TS_CODE} FROM (SELECT m.k AS k)) AS ts_code, m.s_name AS name, m.in_date, m.out_date, 'Y' AS is_new
        FROM g_member_rows m JOIN g_member_base b ON b.k = m.k"""),
    ("raw_trade_cal", """
        SELECT 'SSE' AS exchange, strftime(d, '%Y%m%d') AS cal_date,
               CASE WHEN dayofweek(d) IN (0, 6) THEN 0 ELSE 1 END AS is_open,
               strftime(lag(d) OVER (ORDER BY d), '%Y%m%d') AS pretrade_date,
               TIMESTAMP '2024-01-02 00:00:00' AS ingested_at, 'trade_cal' AS source_table
        FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)"""),
]

_NAT = "(SELECT n_nationkey AS nk, n_name, n_regionkey AS rk, r_name FROM nation JOIN region ON n_regionkey = r_regionkey)"
_SUP = f"""(SELECT k, nk, rk, {SYMBOL} AS symbol,
                   610000 + rk * 10000 + (nk + 1) * 100 + (k % 3 + 1) AS old_code,
                   610000 + rk * 10000 + (nk + 1) * 100 + ((k % 3 + 1) % 3 + 1) AS old_code2,
                   110000 + rk * 10000 + (nk + 1) * 100 + (k % 3 + 1) AS new_code,
                   110000 + rk * 10000 + (nk + 1) * 100 AS new_l2
            FROM (SELECT s_suppkey AS k, s_nationkey FROM supplier) s JOIN {_NAT} n ON s.s_nationkey = n.nk)"""


def _rec(idx: int, cond: str, eff: str, code: str, upd: str) -> str:
    code_text = ("CASE WHEN k % 4 = 1 THEN regexp_replace(symbol, '^0+', '') WHEN k % 4 = 2 THEN symbol || '.0' "
                 "ELSE symbol END")
    return (f"SELECT {code_text} AS \"股票代码\", {eff} AS \"计入日期\", CAST({code} AS VARCHAR) AS \"行业代码\", "
            f"CASE WHEN k % 9 = 4 THEN '' ELSE {upd} END AS \"更新日期\", CAST(k * 10 + {idx} AS BIGINT) AS row_no "
            f"FROM sup WHERE {cond}")


def _tsx(day: str, time: str = "00:00:00") -> str:
    return f"(strftime({day}, '%Y-%m-%d') || ' {time}')"


_D95 = "(DATE '1995-03-01' + CAST(k % 28 AS INTEGER))"
_D97 = "(DATE '1997-05-01' + CAST(k % 50 AS INTEGER))"
_D99 = "(DATE '1999-08-15' + CAST(k % 20 AS INTEGER))"

CTES += [
    ("official_codes", f"""
        SELECT *, CAST(dense_rank() OVER (ORDER BY "行业代码") AS BIGINT) AS row_no FROM (
            SELECT CAST(110000 + r_regionkey * 10000 AS VARCHAR) AS "行业代码", r_name AS "一级行业名称",
                   '' AS "二级行业名称", '' AS "三级行业名称" FROM region
            UNION ALL SELECT '110009', r_name, '', '' FROM region WHERE r_regionkey = 0
            UNION ALL SELECT '990000', 'GHOST', 'G2', '' FROM region WHERE r_regionkey = 0
            UNION ALL SELECT '990001', 'UNMAPPED', '', 'x' FROM region WHERE r_regionkey = 0
            UNION ALL SELECT CAST(110000 + rk * 10000 + (nk + 1) * 100 AS VARCHAR), r_name, n_name, '' FROM {_NAT}
            UNION ALL SELECT CAST(110000 + rk * 10000 + (nk + 1) * 100 + j AS VARCHAR), r_name, n_name,
                             n_name || '-' || CAST(j AS VARCHAR)
                      FROM {_NAT} CROSS JOIN (SELECT range AS j FROM range(1, 4)))"""),
    ("official_crosswalk", f"""
        WITH items AS (
            SELECT *, 610000 + rk * 10000 + (nk + 1) * 100 + j AS old, 110000 + rk * 10000 + (nk + 1) * 100 + j AS new
            FROM {_NAT} CROSS JOIN (SELECT range AS j FROM range(1, 4)) WHERE nk % 6 <> 5)
        SELECT CAST(r_regionkey * 1000 AS BIGINT) AS row_no, 'section' AS c0, r_name AS c1, '' AS c2,
               CAST(610000 + r_regionkey * 10000 AS VARCHAR) AS c3, '' AS c4, '' AS c5, '' AS c6,
               CAST(110000 + r_regionkey * 10000 AS VARCHAR) AS c7
        FROM region
        UNION ALL
        SELECT CAST(rk * 1000 + (nk + 1) * 10 + j AS BIGINT), 'item', n_name, '',
               CASE WHEN j = 2 THEN CAST(old AS VARCHAR) || '.0' ELSE CAST(old AS VARCHAR) END, '', '', '',
               CASE WHEN nk % 5 = 1 AND j = 3 THEN '999999' ELSE CAST(new AS VARCHAR) END
        FROM items
        UNION ALL
        SELECT CAST(rk * 1000 + (nk + 1) * 10 + 5 AS BIGINT), 'item', n_name, '', CAST(old AS VARCHAR), '', '', '',
               CAST(new + 1 AS VARCHAR)
        FROM items WHERE nk % 4 = 0 AND j = 1"""),
    ("official_ledger", f"""
        WITH sup AS {_SUP}
        {_rec(0, 'TRUE', _tsx(_D95), 'old_code', _tsx(_D95))}
        UNION ALL {_rec(1, 'k % 2 = 0', _tsx(_D97, '09:30:00'), 'old_code2', "'1997-06-01 00:00:00'")}
        UNION ALL {_rec(2, 'k % 10 = 0', _tsx(_D97, '09:30:00'), 'old_code', "'1997-07-01 00:00:00'")}
        UNION ALL {_rec(3, 'k % 11 = 0', "'1990-01-01 00:00:00'", 'old_code', "'1990-01-01 00:00:00'")}
        UNION ALL {_rec(4, 'k % 13 = 0', "'1996-02-21 00:00:00'", 'old_code2', "'1996-02-21 00:00:00'")}
        UNION ALL {_rec(5, 'k % 4 <> 1', _tsx(_D99), 'new_code', _tsx(_D99))}
        UNION ALL {_rec(6, 'k % 7 = 2', "'1999-07-30 10:00:00'", 'new_code', "'1999-07-30 10:00:00'")}"""),
    ("official_snapshot", f"""
        SELECT CASE WHEN k % 9 = 8 THEN 'B股' ELSE 'A股' END AS "交易所",
               CAST(CASE WHEN k % 6 = 1 THEN new_l2 ELSE new_code END AS VARCHAR) AS "行业代码",
               symbol AS "股票代码", CAST(k AS BIGINT) AS row_no
        FROM {_SUP}"""),
]

CTES += [
    ("g_quarters", f"""
        SELECT {TS_CODE} AS ts_code, CASE WHEN k % 19 = 0 THEN '' ELSE {txt('qe + CAST(k % 40 AS INTEGER)')} END AS ann_date, {txt('qe')} AS end_date, sq, mh, ml, nd
        FROM (
            SELECT k, last_day(CAST(date_trunc('quarter', d) AS DATE) + INTERVAL 2 MONTH)::DATE AS qe, sum(q) AS sq, max(hi) AS mh, min(lo) AS ml, count(*) AS nd
            FROM g_groups GROUP BY 1, 2)"""),
    ("raw_index_weight", "SELECT benchmark_id AS index_code, security_id AS con_code, trade_date, weight FROM benchmark_weight_snapshot_pit"),
    ("raw_income", "SELECT ts_code, ann_date, end_date FROM pit_fina_indicator"),
    ("raw_balancesheet", "FROM raw_income"),
    ("raw_cashflow", "FROM raw_income"),
    ("raw_forecast", "SELECT * FROM raw_income WHERE end_date[5:8] = '1231'"),
    ("raw_express", "SELECT * FROM raw_income WHERE end_date[5:8] IN ('0630', '1231')"),
]
