"""Raw-layer dataset registry (S1): fields, primary key, incremental axis.

``read_dataset`` loads a stored raw dataset with its fixed schema, so a
folder of Parquet files never has its types inferred.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType, DoubleType, IntegerType, StringType, StructField, StructType, TimestampType

S, D, I = StringType(), DoubleType(), IntegerType()


@dataclass(frozen=True)
class DatasetSpec:
    dataset_id: str
    table: str
    fields: tuple[tuple[str, DataType], ...]
    primary_key: tuple[str, ...]
    axis: str  # 'trade_date' | 'period_end' | 'static'

    def schema(self) -> StructType:
        extra = [("source_table", S), ("ingested_at", TimestampType())]
        return StructType([StructField(n, t, True) for n, t in [*self.fields, *extra]])

    @property
    def axis_column(self) -> str | None:
        """Column holding the incremental axis (the calendar uses cal_date)."""
        if self.axis == "static":
            return None
        if self.axis == "period_end":
            return "end_date"
        return "cal_date" if self.dataset_id == "trade_cal" else "trade_date"


def _f(text: str, doubles: str = "", ints: str = "") -> tuple[tuple[str, DataType], ...]:
    d, i = set(doubles.split()), set(ints.split())
    return tuple((n, D if n in d else I if n in i else S) for n in text.split())


_PRICE = "open high low close pre_close change pct_chg vol amount"
_STATEMENT = "ts_code ann_date f_ann_date end_date report_type comp_type"
# Dataset id, table, fields, primary key and incremental axis.
DATASETS: dict[str, DatasetSpec] = {
    s.dataset_id: s
    for s in [
        DatasetSpec("stock_basic", "stock_basic_ref", _f("ts_code symbol name area industry list_date delist_date is_hs"), ("ts_code",), "static"),
        DatasetSpec("trade_cal", "raw_trade_cal", _f("exchange cal_date is_open pretrade_date", ints="is_open"), ("exchange", "cal_date"), "trade_date"),
        DatasetSpec("namechange", "raw_namechange", _f("ts_code name start_date end_date ann_date change_reason"), ("ts_code", "start_date"), "static"),
        DatasetSpec("daily", "raw_kline_unadj", _f(f"ts_code trade_date {_PRICE}", _PRICE), ("ts_code", "trade_date"), "trade_date"),
        DatasetSpec("daily_basic", "raw_daily_basic", _f(
            "ts_code trade_date close turnover_rate turnover_rate_f volume_ratio pe pe_ttm pb ps ps_ttm dv_ratio dv_ttm "
            "total_share float_share free_share total_mv circ_mv",
            "close turnover_rate turnover_rate_f volume_ratio pe pe_ttm pb ps ps_ttm dv_ratio dv_ttm total_share "
            "float_share free_share total_mv circ_mv"), ("ts_code", "trade_date"), "trade_date"),
        DatasetSpec("adj_factor", "raw_adj_factor", _f("ts_code trade_date adj_factor", "adj_factor"), ("ts_code", "trade_date"), "trade_date"),
        DatasetSpec("daily_qfq", "raw_kline_qfq", _f(f"ts_code trade_date {_PRICE}", _PRICE), ("ts_code", "trade_date"), "trade_date"),
        DatasetSpec("suspend_d", "raw_suspend_d", _f("ts_code trade_date suspend_timing suspend_type"), ("ts_code", "trade_date"), "trade_date"),
        DatasetSpec("stk_limit", "raw_stk_limit", _f("trade_date ts_code up_limit down_limit pre_close", "up_limit down_limit pre_close"), ("ts_code", "trade_date"), "trade_date"),
        DatasetSpec("index_daily", "raw_index_daily", _f(f"ts_code trade_date {_PRICE}", _PRICE), ("ts_code", "trade_date"), "trade_date"),
        DatasetSpec("index_weight", "raw_index_weight", _f("index_code con_code trade_date weight", "weight"), ("index_code", "con_code", "trade_date"), "trade_date"),
        DatasetSpec("index_member_all", "raw_index_member_all", _f("l1_code l1_name l2_code l2_name l3_code l3_name ts_code name in_date out_date is_new"), ("ts_code", "l3_code", "in_date"), "static"),
        DatasetSpec("fina_indicator", "pit_fina_indicator", _f(
            "ts_code ann_date end_date eps roe roa gross_margin netprofit_margin current_ratio debt_to_assets revenue_ps "
            "netprofit_yoy dt_netprofit_yoy or_yoy q_sales_yoy assets_yoy equity_yoy",
            "eps roe roa gross_margin netprofit_margin current_ratio debt_to_assets revenue_ps netprofit_yoy "
            "dt_netprofit_yoy or_yoy q_sales_yoy assets_yoy equity_yoy"), ("ts_code", "end_date", "ann_date"), "period_end"),
        DatasetSpec("income", "raw_income", _f(
            f"{_STATEMENT} total_revenue revenue operate_profit total_profit income_tax n_income n_income_attr_p",
            "total_revenue revenue operate_profit total_profit income_tax n_income n_income_attr_p"),
            ("ts_code", "end_date", "ann_date", "report_type"), "period_end"),
        DatasetSpec("balancesheet", "raw_balancesheet", _f(
            f"{_STATEMENT} total_assets total_liab total_hldr_eqy_exc_min_int total_hldr_eqy_inc_min_int money_cap accounts_receiv inventories",
            "total_assets total_liab total_hldr_eqy_exc_min_int total_hldr_eqy_inc_min_int money_cap accounts_receiv inventories"),
            ("ts_code", "end_date", "ann_date", "report_type"), "period_end"),
        DatasetSpec("cashflow", "raw_cashflow", _f(
            f"{_STATEMENT} net_profit n_cashflow_act n_cashflow_inv_act n_cash_flows_fnc_act free_cashflow",
            "net_profit n_cashflow_act n_cashflow_inv_act n_cash_flows_fnc_act free_cashflow"),
            ("ts_code", "end_date", "ann_date", "report_type"), "period_end"),
        DatasetSpec("forecast", "raw_forecast", _f(
            "ts_code ann_date end_date type p_change_min p_change_max net_profit_min net_profit_max last_parent_net "
            "first_ann_date summary change_reason",
            "p_change_min p_change_max net_profit_min net_profit_max last_parent_net"), ("ts_code", "ann_date", "end_date"), "period_end"),
        DatasetSpec("express", "raw_express", _f(
            "ts_code ann_date end_date revenue operate_profit total_profit n_income total_assets "
            "total_hldr_eqy_exc_min_int diluted_eps diluted_roe yoy_net_profit",
            "revenue operate_profit total_profit n_income total_assets total_hldr_eqy_exc_min_int diluted_eps "
            "diluted_roe yoy_net_profit"), ("ts_code", "ann_date", "end_date"), "period_end"),
    ]
}
DEPENDENCY_ORDER = tuple(DATASETS)


def read_dataset(spark: SparkSession, dataset_id: str, path: str) -> DataFrame:
    """Load a stored raw dataset with its fixed schema."""
    return spark.read.schema(DATASETS[dataset_id].schema()).parquet(path)
