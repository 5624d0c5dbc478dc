"""Line-level dedup by winnowing, in DataFrame operations only.

A window is a run of ``min_lines`` consecutive lines, or of fewer lines that hold ``min_words`` words together.  Each window
picks the least of its line hashes; the picked positions are the document's fingerprints.  Equal windows pick equal
fingerprints, so a repeated run of ``min_lines`` lines or of ``min_words`` words is sure to share one.  Fingerprints that occur once in the corpus are dropped; the windows around the others are joined by content to
their first occurrence (smallest document id, then position), and overlapping matched windows grow together both ways into
maximal runs.  A line goes if a matched later window covers it; windows are judged on the input, so the first occurrence
of every run stays.

A window's content is compared by two independent 64-bit hashes of its lines.  Nothing pairs copies with each other: each
window meets only the first occurrence, found by an aggregate with map-side combine.

Edge cases: null text counts as empty (one empty line); documents of fewer lines and words than a window are kept as they are;
words are what the breaks of ``WORD_BREAKS`` separate;
rows that repeat an id and text count as one document, and rows that repeat an id with other texts are ordered by a hash of
the text; null ids come first; an empty table gives an empty result; extra columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitspark.llm.common import NULL_ID, WORD_BREAKS, table

MIN_LINES = 3
MIN_WORDS = 50  # a run of fewer lines is a window from so many words on
WORD = "[^" + "".join(f"\\x{b:02x}" for b in WORD_BREAKS) + "]+"


def _windows(docs: DataFrame, w: int, words: int) -> DataFrame:
    """One row for each window: document, position, lines, two content hashes, the picked fingerprint and its position."""
    hashed = docs.select("_id", "_th", F.split("_text", "\n", -1).alias("lines")).filter((F.size("lines") >= w) | (F.length("_text") >= 2 * words - 1))
    count = lambda x: F.when(F.length(x) > 0, F.regexp_count(x, F.lit(WORD))).otherwise(0)
    hashed = hashed.select("_id", "_th", F.transform("lines", lambda x: F.xxhash64(x)).alias("a"), F.transform("lines", lambda x: F.xxhash64(F.lit(1), x)).alias("b"), F.transform("lines", count).alias("c"))

    def window(k: int):
        def of(i: Column) -> Column:
            own = F.slice("a", i + 1, k)
            least = F.array_min(own)
            return F.struct(i.alias("pos"), F.lit(k).alias("size"), F.xxhash64(own).alias("k1"), F.xxhash64(F.slice("b", i + 1, k)).alias("k2"), least.alias("fp"), (i + F.array_position(own, least)).cast("int").alias("fp_pos"))

        return of

    def enough(k: int):
        return lambda i: sum((F.get("c", i + j) for j in range(1, k)), F.get("c", i)) >= words

    none = F.array().cast("array<int>")
    each = []
    for k in range(1, w + 1):
        starts = F.when(F.size("a") >= k, F.sequence(F.lit(0), F.size("a") - k)).otherwise(none)
        each.append(F.transform(starts if k == w else F.filter(starts, enough(k)), window(k)))
    return hashed.select("_id", "_th", F.inline(F.concat(*each)))


def repeated_runs(docs: DataFrame, w: int = MIN_LINES, words: int = MIN_WORDS) -> DataFrame:
    """Later repeated runs of the documents (_id, _th, _text): ``runs``, an array of (first, last) line positions."""
    windows = _windows(docs, w, words)
    prints = windows.select("_id", "_th", "fp", "fp_pos").distinct()
    common = prints.groupBy("fp").agg(F.count("*").alias("n")).filter("n > 1").select("fp")
    near = windows.join(common, "fp", "left_semi")
    first = near.groupBy("size", "k1", "k2").agg(F.min(F.struct("_id", "_th", "pos")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    later = near.join(first.drop("n"), ["size", "k1", "k2"]).filter(F.struct("_id", "_th", "pos") != F.col("first"))
    lines = F.flatten(F.transform(F.collect_set(F.struct("pos", "size")), lambda x: F.sequence(x["pos"], x["pos"] + x["size"] - 1)))
    starts = later.groupBy("_id", "_th").agg(F.sort_array(F.array_distinct(lines)).alias("s"))
    opens = F.filter("s", lambda x, i: (i == 0) | (F.get("s", i - 1) < x - 1))
    closes = F.filter("s", lambda x, i: (i == F.size("s") - 1) | (F.get("s", i + 1) > x + 1))
    runs = F.zip_with(opens, closes, lambda a, b: F.struct(a.alias("first"), b.alias("last")))
    return starts.select("_id", "_th", runs.alias("runs"))


def dedup_lines(docs: DataFrame, min_lines: int = MIN_LINES, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with later repeated runs cut out of their text; adds ``n_lines``, ``n_removed`` and ``removed_runs``."""
    others = [c for c in docs.columns if c != text_col]
    rows = docs.select(
        F.struct(*(F.col(c) for c in others)).alias("_row"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("_id"),
        F.xxhash64(text_col).alias("_th"),
        F.col(text_col).alias("_raw"),
    )
    text = F.coalesce("_raw", F.lit(""))
    runs = repeated_runs(rows.select("_id", "_th", text.alias("_text")), min_lines, min_words)
    both = rows.join(runs, ["_id", "_th"], "left")
    both = both.select("_row", "_raw", "runs", F.split(text, "\n", -1).alias("lines"))
    kept = F.filter("lines", lambda _, i: ~F.exists("runs", lambda r: i.between(r["first"], r["last"])))
    both = both.select("_row", "_raw", "runs", F.size("lines").alias("n"), F.when(F.col("runs").isNotNull(), kept).alias("kept"))
    out = both.select(
        *(F.col("_row")[c].alias(c) for c in others),
        F.when(F.col("runs").isNull(), F.col("_raw")).otherwise(F.array_join("kept", "\n")).alias(text_col),
        F.col("n").cast("long").alias("_n"),
        F.when(F.col("runs").isNull(), F.lit(0)).otherwise(F.col("n") - F.size("kept")).cast("long").alias("_gone"),
        F.coalesce("runs", F.array().cast("array<struct<first:int,last:int>>")).alias("_runs"),
    )
    return out.select(*docs.columns, F.col("_n").alias("n_lines"), F.col("_gone").alias("n_removed"), F.col("_runs").alias("removed_runs"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: lines, removed lines, removed runs, and the SHA-256 of the remaining text."""
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id", "n_lines", "n_removed", F.size("removed_runs").cast("long").alias("n_runs"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


ORACLE = rf"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
told AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM l),
run AS ({" UNION ALL ".join(f"""
        SELECT doc_id, pos, {k} AS size, string_agg(line, chr(10)) OVER v AS body, count(*) OVER v AS n, sum(words) OVER v AS words
        FROM told WINDOW v AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {k - 1} FOLLOWING)""" for k in range(1, MIN_LINES + 1))}),
ranked AS (SELECT doc_id, pos, size, row_number() OVER (PARTITION BY size, body ORDER BY doc_id, pos) AS nth
           FROM run WHERE n = size AND (size = {MIN_LINES} OR words >= {MIN_WORDS})),
gone AS (SELECT DISTINCT doc_id, pos + k AS pos FROM ranked, range({MIN_LINES}) t(k) WHERE nth > 1 AND k < size),
marked AS (SELECT l.doc_id, l.pos, l.line, gone.pos IS NOT NULL AS cut FROM l LEFT JOIN gone USING (doc_id, pos)),
edged AS (SELECT *, cut AND NOT coalesce(lag(cut) OVER (PARTITION BY doc_id ORDER BY pos), false) AS opens FROM marked)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (cut) AS n_removed, count(*) FILTER (opens) AS n_runs,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT cut), '')) AS kept_sha256
FROM edged GROUP BY doc_id
"""
