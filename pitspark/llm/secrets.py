"""Secret scanning over a content-addressed blob ledger, in DataFrame operations only.

Every version of every path is addressed by the SHA-256 of its text.  The ledger holds one row for each (blob, rule
version) that was ever scanned, with its findings; a scan takes only the distinct blobs that the ledger lacks, finds all
matches of every rule in them once, and the findings are joined back to every path and version that holds the blob.

Matches of a rule are found leftmost and without overlap.  Positions come from cutting the text at the matches: a match
starts after the text between the matches before it and those matches (code points, end exclusive).

Edge cases: null text is an empty blob without findings; null ids and repeated rows keep a row each; an empty table gives
an empty result; an absent or empty ledger means that every blob is scanned; other columns are not read; a blob held by any
number of paths is scanned once, and its findings meet the paths in an ordinary join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitspark.llm.common import NULL_ID, real_id, table

RULE_VERSION = "1"
# Kind, pattern (leftmost, greedy), group whose length counts, least length.
BASE_RULES = [
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
]
# Kinds beyond the base: private key heads, signed web tokens, prefixed service tokens.  Repeated groups are bounded (the
# matcher recurses into them) and a web token begins where its characters do (else a long run is read once for each "eyJ" in it).
MORE_RULES = [
    ("pem", r"-----BEGIN (?:[A-Z]{1,20} ){0,4}PRIVATE KEY-----", 0, 1),
    ("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
    ("service", r"(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abpr]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,})", 0, 1),
]
RULES = BASE_RULES + MORE_RULES
LEDGER_SCHEMA = "blob string, rule_version string, spans array<struct<start:bigint,kind_no:int,kind:string,end:bigint>>"


def scan_blobs(blobs: DataFrame, rules: list[tuple[str, str, int, int]] = RULES) -> DataFrame:
    """Spans of all rules in the rows (blob, _text): one row for each span."""
    each = []
    for no, (_, pattern, group, _) in enumerate(rules):
        whole = F.regexp_extract_all("_text", F.lit(pattern), F.lit(0))
        part = whole if group == 0 else F.regexp_extract_all("_text", F.lit(pattern), F.lit(group))
        hit = F.col("_text").rlike(pattern)
        each += [F.when(hit, whole).alias(f"all{no}"), F.when(hit, part).alias(f"part{no}"), F.when(hit, F.split("_text", pattern, -1)).alias(f"gaps{no}")]
    cut = blobs.select("blob", *each)

    def entry(no: int):
        return lambda m, i: F.struct(F.lit(no).alias("kind_no"), i.alias("nth"), F.length(F.get(f"gaps{no}", i)).alias("gap"), F.length(m).alias("size"), F.length(F.get(f"part{no}", i)).alias("counts"))

    rows = []
    for no in range(len(rules)):
        rows.append(F.coalesce(F.transform(f"all{no}", entry(no)), F.array().cast("array<struct<kind_no:int,nth:int,gap:int,size:int,counts:int>>")))
    so_far = Window.partitionBy("blob", "kind_no").orderBy("nth")
    hits = cut.select("blob", F.inline(F.concat(*rows)))
    hits = hits.withColumn("end", F.sum(F.col("gap").cast("long") + F.col("size")).over(so_far))
    rule = lambda k: F.element_at(F.array(*(F.lit(r[k]) for r in rules)), F.col("kind_no") + 1)
    return hits.filter(F.col("counts") >= rule(3)).select("blob", (F.col("end") - F.col("size")).alias("start"), "kind_no", rule(0).alias("kind"), "end")


def scan_new(versions: DataFrame, ledger: DataFrame | None = None, rules: list[tuple[str, str, int, int]] = RULES, rule_version: str = RULE_VERSION) -> DataFrame:
    """Ledger rows of the blobs in ``versions`` (blob, _id, _text) that ``ledger`` lacks for this rule version, one a blob."""
    unseen = versions.groupBy("blob").agg(F.min("_id").alias("_id"))
    if ledger is not None:
        unseen = unseen.join(ledger.filter(F.col("rule_version") == rule_version), "blob", "left_anti")
    texts = versions.join(unseen, ["blob", "_id"], "left_semi").dropDuplicates(["blob", "_id"]).select("blob", "_text")  # one row a blob
    spans = scan_blobs(texts, rules).groupBy("blob").agg(F.sort_array(F.collect_set(F.struct("start", "kind_no", "kind", "end"))).alias("spans"))
    none = F.array().cast("array<struct<start:bigint,kind_no:int,kind:string,end:bigint>>")
    return unseen.select("blob").join(spans, "blob", "left").select("blob", F.lit(rule_version).alias("rule_version"), F.coalesce("spans", none).alias("spans"))


def address(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("_id"), F.sha2(text, 256).alias("blob"), text.alias("_text"))


def find_secrets(docs: DataFrame, ledger: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", rules: list[tuple[str, str, int, int]] = RULES, rule_version: str = RULE_VERSION) -> DataFrame:
    """One row for each row of ``docs``: its id, blob and ``spans`` (start, kind_no, kind, end), ordered by start and kind."""
    versions = address(docs, id_col, text_col)
    seen = scan_new(versions, ledger, rules, rule_version)
    if ledger is not None:
        seen = seen.unionByName(ledger.filter(F.col("rule_version") == rule_version))
    holding = seen.filter(F.size("spans") > 0).select("blob", "spans")
    none = F.array().cast("array<struct<start:bigint,kind_no:int,kind:string,end:bigint>>")
    return versions.select("_id", "blob").join(holding, "blob", "left").select(real_id().alias("doc_id"), "blob", F.coalesce("spans", none).alias("spans"))


def _joined(spans: F.Column) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents: counts by base kind, digest of the base spans, and all spans."""
    found = find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind_no"] < len(BASE_RULES))
    count = lambda no: F.size(F.filter("spans", lambda s: s["kind_no"] == no)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
