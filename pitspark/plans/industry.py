"""Official industry-classification import.

Inputs arrive as tables (the provider ships spreadsheets; reading those is
outside the library): a stock ledger of (security, effective time, raw code,
update time), a hierarchy code table, an old->new crosswalk sheet with
positional columns and an explicit row order, a cutover snapshot, and an
adjudication table.  Everything below is joins, windows and aggregates keyed
by security or code; the two whole-sheet windows (forward fill of crosswalk
sections, row order of the code table) run over reference sheets whose size
is bounded by the number of industry codes, not by the data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean_text, normalize_industry_code, normalize_security_id
from ..operators.temporal import close_intervals, forward_fill, reach_before
from ..session import cut_lineage

# Levels -> schema name, placeholder day, defaults of the import.
LEVEL_SCHEMAS = {"L1": "sw2021_l1", "L2": "sw2021_l2", "L3": "sw2021_l3"}
PLACEHOLDER_DATE = "19900101"
DEFAULT_MIN_EFFECTIVE = "20140221"
DEFAULT_CUTOVER = "20210730"
A_SHARE_MARK = "A股"
EXTENDING_TYPES = ["external_left_edge_backfill", "listing_lag_backfill", "security_code_alias_backfill"]
FAR_END = "9999-12-31 23:59:59"


@dataclass(frozen=True)
class ImportParams:
    levels: tuple[str, ...] = ("L1",)
    min_effective_date: str = DEFAULT_MIN_EFFECTIVE
    cutover_date: str = DEFAULT_CUTOVER

    def validate(self) -> None:
        bad = sorted(lv for lv in self.levels if lv not in LEVEL_SCHEMAS)
        if bad:
            raise ValueError("no such level in the official import: " + ", ".join(bad))
        for d in (self.min_effective_date, self.cutover_date):
            if len(d) != 8 or not d.isdigit():
                raise ValueError("days of the official import are written yyyyMMdd")

    @property
    def min_effective_ts(self) -> Column:
        return F.to_timestamp(F.lit(self.min_effective_date), "yyyyMMdd")

    @property
    def cutover_ts(self) -> Column:
        return F.to_timestamp(F.lit(self.cutover_date), "yyyyMMdd")


def day_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd")


def _ts(c: Column) -> Column:
    """Provider time text/number -> timestamp (NULL when blank)."""
    t = clean_text(c)
    return F.when(t == "", F.lit(None).cast("timestamp")).otherwise(
        F.coalesce(F.try_to_timestamp(t, F.lit("yyyy-MM-dd HH:mm:ss")), F.try_to_timestamp(t, F.lit("yyyy-MM-dd")),
                   F.try_to_timestamp(t, F.lit("yyyyMMdd")))
    )


# ------------------------------------------------------------------ C11/W11
def stock_records(ledger: DataFrame) -> DataFrame:
    """Normalised ledger rows; per (security, effective time) the latest update
    wins, ties to the row delivered last (``row_no``)."""
    r = ledger.select(
        normalize_security_id(F.col("股票代码")).alias("security_id"),
        _ts(F.col("计入日期")).alias("effective_at"),
        normalize_industry_code(F.col("行业代码")).alias("raw_code"),
        _ts(F.col("更新日期")).alias("updated_at"),
        F.col("row_no"),
    ).where((F.col("security_id") != "") & F.col("effective_at").isNotNull() & (F.col("raw_code") != ""))
    w = Window.partitionBy("security_id", "effective_at").orderBy(F.col("updated_at").desc_nulls_last(), F.col("row_no").desc())
    return r.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).select(
        "security_id", "effective_at", "raw_code", "updated_at")


# ---------------------------------------------------------------------- C12
def hierarchy_levels(codes: DataFrame) -> DataFrame:
    """Code table (code + level names) -> (code, level, level_code).

    Level-1 rows (names below blank) name the L1 code, level-2 rows the L2
    code; every row maps to the L1/L2 codes of its names and to itself as L3
    when it has a level-3 name.  Later rows win on repeated names or codes.
    """
    rows = codes.select(
        normalize_industry_code(F.col("行业代码")).alias("code"),
        clean_text(F.col("一级行业名称")).alias("l1"),
        clean_text(F.col("二级行业名称")).alias("l2"),
        clean_text(F.col("三级行业名称")).alias("l3"),
        "row_no",
    )
    l1 = rows.where((F.col("code") != "") & (F.col("l1") != "") & (F.col("l2") == "") & (F.col("l3") == "")).groupBy("l1").agg(
        F.max_by("code", "row_no").alias("_l1_code"))
    l2 = rows.where((F.col("code") != "") & (F.col("l1") != "") & (F.col("l2") != "") & (F.col("l3") == "")).groupBy("l1", "l2").agg(
        F.max_by("code", "row_no").alias("_l2_code"))
    valid = rows.where((F.col("code") != "") & (F.col("l1") != ""))
    last = valid.groupBy("code").agg(F.max_by(F.struct("l1", "l2", "l3"), "row_no").alias("_n")).select(
        "code", F.col("_n.l1").alias("l1"), F.col("_n.l2").alias("l2"), F.col("_n.l3").alias("l3"))
    j = last.join(l1, "l1", "left").join(l2, ["l1", "l2"], "left")
    long = j.select(
        "code",
        F.explode(F.array(
            F.struct(F.lit("L1").alias("level"), F.col("_l1_code").alias("level_code")),
            F.struct(F.lit("L2").alias("level"), F.when(F.col("l2") != "", F.col("_l2_code")).alias("level_code")),
            F.struct(F.lit("L3").alias("level"), F.when(F.col("l3") != "", F.col("code")).alias("level_code")),
        )).alias("_e"),
    ).select("code", "_e.level", "_e.level_code")
    # codes without any level stay (level_code NULL): they count as "in the
    # code table" for the crosswalk, but resolve nothing
    return long


# ---------------------------------------------------------------------- C13
def crosswalk_map(sheet: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """Old -> new code per level: unique mappings (exactly one distinct new
    code in the hierarchy) take all its levels; other old codes of a section
    fall back to the section's new level-1 code (L1 only)."""
    rows = sheet.select(
        "row_no",
        normalize_industry_code(F.col("c3")).alias("old"),
        normalize_industry_code(F.col("c7")).alias("new"),
    )
    section = (F.col("old") != "") & F.col("old").endswith("0000")
    rows = forward_fill(rows, order="row_no", value=F.when(section, F.col("old")), out="old_l1")
    hcodes = hierarchy.select(F.col("code").alias("new")).distinct().withColumn("_in_h", F.lit(True))
    hierarchy = hierarchy.where(F.col("level_code").isNotNull())
    rows = rows.join(hcodes, "new", "left")
    in_h = F.coalesce(F.col("_in_h"), F.lit(False))
    h_l1 = hierarchy.where(F.col("level") == "L1").select(F.col("code").alias("new"), F.col("level_code").alias("new_l1"))
    section_map = (
        rows.where(section & (F.col("new") != "") & F.col("new").endswith("0000") & in_h)
        .join(h_l1, "new", "left")
        .groupBy(F.col("old").alias("old_l1"))
        .agg(F.max_by(F.coalesce(F.col("new_l1"), F.lit("")), "row_no").alias("section_new_l1"))
    )
    old_to_section = rows.where((F.col("old") != "") & F.col("old_l1").isNotNull()).groupBy("old").agg(
        F.max_by("old_l1", "row_no").alias("old_l1"))
    unique = (
        rows.where((F.col("old") != "") & (F.col("new") != "") & in_h)
        .groupBy("old")
        .agg(F.countDistinct("new").alias("_n"), F.min("new").alias("new"))
        .where(F.col("_n") == 1)
        .join(hierarchy.withColumnRenamed("code", "new"), "new")
        .select("old", "level", "level_code")
    )
    fallback = (
        old_to_section.join(section_map, "old_l1")
        .where(F.col("section_new_l1") != "")
        .select("old", F.lit("L1").alias("level"), F.col("section_new_l1").alias("level_code"))
        .join(unique.where(F.col("level") == "L1").select("old"), "old", "left_anti")
    )
    return unique.unionByName(fallback).withColumnRenamed("old", "code")


# ------------------------------------------------------------------ C14
def snapshot_codes(snapshot: DataFrame) -> DataFrame:
    """A-share rows of the cutover snapshot; the last row per security wins."""
    s = snapshot.where(clean_text(F.col("交易所")) == A_SHARE_MARK).select(
        normalize_security_id(F.col("股票代码")).alias("security_id"),
        normalize_industry_code(F.col("行业代码")).alias("raw_code"),
        "row_no",
    ).where((F.col("security_id") != "") & (F.col("raw_code") != ""))
    return s.groupBy("security_id").agg(F.max_by("raw_code", "row_no").alias("raw_code"))


def cutover_anchors(snap: DataFrame, records: DataFrame, params: ImportParams) -> DataFrame:
    """Snapshot securities without a ledger record dated exactly on the
    cutover day get an anchor record at the cutover (earlier or later records
    do not count)."""
    post = records.where(day_key(F.col("effective_at")) >= params.cutover_date).groupBy("security_id").agg(
        F.min("effective_at").alias("_first_post"))
    on_cutover = post.where(day_key(F.col("_first_post")) <= params.cutover_date).select("security_id")
    return snap.join(on_cutover, "security_id", "left_anti").select(
        "security_id", params.cutover_ts.alias("effective_at"), "raw_code", params.cutover_ts.alias("updated_at"))


# ------------------------------------------------------------------ C15
def empirical_map(records: DataFrame, hierarchy: DataFrame, params: ImportParams) -> DataFrame:
    """Old raw code -> level code from each security's last record before the
    cutover and first record on/after it (W12), kept only when unambiguous (A18)."""
    hierarchy = hierarchy.where(F.col("level_code").isNotNull())
    before = day_key(F.col("effective_at")) < params.cutover_date
    pairs = records.groupBy("security_id").agg(
        F.max_by(F.when(before, F.col("raw_code")), F.when(before, F.col("effective_at"))).alias("left_code"),
        F.min_by(F.when(~before, F.col("raw_code")), F.when(~before, F.col("effective_at"))).alias("right_code"),
    ).where(F.col("left_code").isNotNull() & F.col("right_code").isNotNull())
    cand = pairs.join(hierarchy.withColumnRenamed("code", "right_code"), "right_code")
    return (
        cand.groupBy(F.col("left_code").alias("code"), "level")
        .agg(F.countDistinct("level_code").alias("_n"), F.min("level_code").alias("level_code"))
        .where(F.col("_n") == 1)
        .select("code", "level", "level_code")
    )


# ------------------------------------------------------------------ J17
def resolve_codes(raw_codes: DataFrame, hierarchy: DataFrame, crosswalk: DataFrame, empirical: DataFrame,
                  levels: tuple[str, ...]) -> DataFrame:
    """(raw_code, level) -> level_code ('' when unresolved).

    A code present in the hierarchy with any level stops there (even when the
    requested level is blank); otherwise the crosswalk, then the empirical map.
    """
    codes = raw_codes.select("raw_code").distinct()
    grid = codes.withColumn("level", F.explode(F.array(*[F.lit(x) for x in levels])))
    hierarchy = hierarchy.where(F.col("level_code").isNotNull())
    in_h = hierarchy.select(F.col("code").alias("raw_code")).distinct().withColumn("_h", F.lit(True))

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col("code").alias("raw_code"), "level", F.col("level_code").alias(name))

    j = (
        grid.join(in_h, "raw_code", "left")
        .join(side(hierarchy, "_hier"), ["raw_code", "level"], "left")
        .join(side(crosswalk, "_cross"), ["raw_code", "level"], "left")
        .join(side(empirical, "_emp"), ["raw_code", "level"], "left")
    )
    code = F.when(F.col("_h").isNotNull(), F.coalesce(F.col("_hier"), F.lit(""))).otherwise(
        F.coalesce(F.col("_cross"), F.col("_emp"), F.lit("")))
    return j.select("raw_code", "level", code.alias("level_code"))


# ------------------------------------------------------------------ C16
@dataclass
class OfficialImport:
    rows: DataFrame      # closed PIT rows (security, schema, code, effective_at, removed_at)
    counters: DataFrame  # (counter, level, value)


def official_industry_rows(ledger: DataFrame, codes: DataFrame, sheet: DataFrame, snapshot: DataFrame,
                           params: ImportParams = ImportParams()) -> OfficialImport:
    params.validate()
    # the shared inputs of every step below are checkpointed once
    hier = cut_lineage(hierarchy_levels(codes))
    cross = crosswalk_map(sheet, hier)
    raw_records = cut_lineage(stock_records(ledger))
    snap = cut_lineage(snapshot_codes(snapshot))
    anchors = cutover_anchors(snap, raw_records, params)
    records = cut_lineage(raw_records.unionByName(anchors))
    emp = empirical_map(records, hier, params)
    codes_used = records.select("raw_code").unionByName(snap.select("raw_code"))
    resolved = cut_lineage(resolve_codes(codes_used, hier, cross, emp, params.levels))
    schema = F.create_map(*[x for lv in params.levels for x in (F.lit(lv), F.lit(LEVEL_SCHEMAS[lv]))])

    dkey = day_key(F.col("effective_at"))
    placeholder = dkey == PLACEHOLDER_DATE
    pre_window = (~placeholder) & (dkey < params.min_effective_date)
    in_window = records.where(~placeholder & ~pre_window)
    window_rows = in_window.join(resolved, "raw_code").select(
        "security_id", "level", "level_code", "effective_at")
    base = window_rows.where(F.col("level_code") != "")

    # carry the last pre-window record forward to the window start
    latest_pre = records.where(pre_window).groupBy("security_id").agg(F.max_by("raw_code", "effective_at").alias("raw_code"))
    at_start = base.where(F.col("effective_at") == params.min_effective_ts).select("security_id", "level").distinct()
    carry = (
        latest_pre.join(resolved, "raw_code")
        .where(F.col("level_code") != "")
        .join(at_start, ["security_id", "level"], "left_anti")
        .select("security_id", "level", "level_code", params.min_effective_ts.alias("effective_at"))
    )
    rows = base.unionByName(carry)

    # snapshot backfill for securities without a pre-cutover raw record in the window
    raw_pre_cut = raw_records.where(
        (day_key(F.col("effective_at")) >= params.min_effective_date) & (day_key(F.col("effective_at")) < params.cutover_date)
    ).select("security_id").distinct()
    resolved_pre_cut = rows.where(day_key(F.col("effective_at")) < params.cutover_date).select("security_id", "level").distinct()
    backfill = (
        snap.join(raw_pre_cut, "security_id", "left_anti")
        .join(resolved, "raw_code")
        .where(F.col("level_code") != "")
        .join(resolved_pre_cut, ["security_id", "level"], "left_anti")
        .select("security_id", "level", "level_code", params.min_effective_ts.alias("effective_at"))
    )
    unique = rows.unionByName(backfill).select(
        "security_id", schema[F.col("level")].alias("industry_schema"), F.col("level_code").alias("industry_code"),
        "effective_at", F.lit(None).cast("timestamp").alias("removed_at"),
    ).distinct()
    closed = close_intervals(unique, keys=["security_id", "industry_schema"], effective="effective_at",
                             removed="removed_at", tiebreak=["industry_code"])

    one = records.agg(F.count_if(placeholder).alias("placeholder"), F.count_if(pre_window).alias("pre_window"))
    counters = one.select(
        F.explode(F.array(
            F.struct(F.lit("quarantined_placeholder_rows").alias("counter"), F.lit("").alias("level"), F.col("placeholder").alias("value")),
            F.struct(F.lit("quarantined_pre_window_rows").alias("counter"), F.lit("").alias("level"), F.col("pre_window").alias("value")),
        )).alias("_c")).select("_c.*")
    counted = (
        window_rows.where(F.col("level_code") == "").select(F.lit("quarantined_unresolved_rows").alias("counter"), "level")
        .unionByName(carry.select(F.lit("window_carry_forward_rows").alias("counter"), "level"))
        .unionByName(backfill.select(F.lit("snapshot_backfill_rows").alias("counter"), "level"))
        .groupBy("counter", "level").agg(F.count(F.lit(1)).alias("value"))
    )
    # Every counter reports every level, zeros included: a fixed grid of counters x levels.
    names = ("quarantined_unresolved_rows", "window_carry_forward_rows", "snapshot_backfill_rows")
    grid = one.select(F.explode(F.array(*(F.struct(F.lit(n).alias("counter"), F.lit(lv).alias("level")) for n in names for lv in params.levels))).alias("_g")).select("_g.*")
    per_level = grid.join(counted, ["counter", "level"], "left").select("counter", "level", F.coalesce("value", F.lit(0)).cast("bigint").alias("value"))
    return OfficialImport(cut_lineage(closed.select("security_id", "industry_schema", "industry_code", "effective_at", "removed_at")),
                          counters.unionByName(per_level))


# ------------------------------------------------------------------ C17
def supported_adjudications(adj: DataFrame, official: DataFrame) -> DataFrame:
    """Adjudications whose evidence is consistent with the official rows."""
    a = adj.alias("a")
    o = official.alias("o")
    same = (F.col("o.security_id") == F.col("a.security_id")) & (F.col("o.industry_schema") == F.col("a.industry_schema")) & (
        F.col("o.industry_code") == F.col("a.industry_code"))
    t = F.col("a.source_type")
    gap = (t == "provider_gap_confirmation") & (F.col("o.effective_at") == F.col("a.start_date")) & (
        (F.col("o.removed_at") == F.col("a.end_date"))
        | (F.col("o.removed_at").isNull() & (F.col("a.end_date") > F.col("a.start_date"))))
    left_edge = (t == "external_left_edge_backfill") & (
        F.col("a.evidence_url").startswith("http://") | F.col("a.evidence_url").startswith("https://")) & (
        F.col("o.effective_at") == F.col("a.end_date"))
    lag = (t == "listing_lag_backfill") & (F.col("o.effective_at") == F.col("a.end_date"))
    direct = a.join(o, same & (gap | left_edge | lag), "left_semi")
    # alias: the new code has rows for the schema and the legacy code held the interval
    alias_rows = adj.where(F.col("source_type") == "security_code_alias_backfill")
    new_identity = official.select("security_id", "industry_schema").distinct()
    legacy = official.select(F.col("security_id").alias("legacy_security_id"), "industry_schema", "industry_code",
                             F.col("effective_at").alias("_ls"), F.col("removed_at").alias("_le"))
    far = F.to_timestamp(F.lit(FAR_END))
    held = ["legacy_security_id", "industry_schema", "industry_code"]
    la = reach_before(alias_rows, legacy.select(*held, "_ls", F.coalesce("_le", far).alias("_le")), on=held, point="start_date", start="_ls", end="_le", out="_reach", inclusive=True)
    la = la.where(F.col("_reach") >= F.col("end_date")).select(*adj.columns).join(new_identity, ["security_id", "industry_schema"], "left_semi")
    return direct.unionByName(la)


def apply_adjudications(official: DataFrame, adj: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Add supported, extending adjudications that overlap no official row of
    their (security, schema) (J18) and, except aliases, touch an official row
    of the same code at their right edge; then close intervals again."""
    sup = supported_adjudications(adj, official).where(F.col("source_type").isin(*EXTENDING_TYPES))
    keyed = official.select("security_id", "industry_schema").distinct()
    sup = sup.join(keyed, ["security_id", "industry_schema"], "left_semi")
    ends = official.select("security_id", "industry_schema", "effective_at", F.coalesce("removed_at", F.to_timestamp(F.lit(FAR_END))).alias("_to"))
    swept = reach_before(sup, ends, on=["security_id", "industry_schema"], point="end_date", start="effective_at", end="_to", out="_reach")
    no_overlap = swept.where(F.col("_reach").isNull() | (F.col("_reach") <= F.col("start_date"))).drop("_reach")
    o = official.alias("o")
    key = (F.col("o.security_id") == F.col("a.security_id")) & (F.col("o.industry_schema") == F.col("a.industry_schema"))
    edge = (F.col("o.industry_code") == F.col("a.industry_code")) & (F.col("o.effective_at") == F.col("a.end_date"))
    touching = no_overlap.alias("a").join(o, key & edge, "left_semi")
    applied = touching.unionByName(no_overlap.where(F.col("source_type") == "security_code_alias_backfill")).distinct()
    rows = official.unionByName(applied.select(
        "security_id", "industry_schema", "industry_code", F.col("start_date").alias("effective_at"),
        F.col("end_date").alias("removed_at"))).distinct()
    closed = close_intervals(rows, keys=["security_id", "industry_schema"], effective="effective_at", removed="removed_at",
                             tiebreak=["industry_code"])
    return closed, applied
