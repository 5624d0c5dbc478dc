"""Generic temporal operators over DataFrames.

Every operator is a composition of built-in DataFrame operations (joins,
windows, aggregates) so Catalyst plans it and Tungsten runs it; there is no
Python UDF and no driver-side loop.  Column names are arguments, so the
operators apply to any keyed time series, not only market bars.

Scale notes (checked with ``explain``):

* keyed interval joins are equi-joins on the key plus a range residual
  (sort-merge join with a condition, or broadcast hash join when the runtime
  sees a small side) — never a nested loop;
* key-less interval joins (a calendar against windows) are equi-joins on a
  year bucket: a window is expanded to the years it spans, not to days;
* as-of lookups run on the *distinct* dates (bounded by the calendar span),
  and are joined back with an equi-join;
* per-key windows are partitioned by the key; the bar spine guarantees one
  row per (key, day), so a key holds at most one row per calendar day.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FAR_FUTURE = "9999-12-31"


def _cols(names: Sequence[str] | str | None) -> list[str]:
    if names is None:
        return []
    return [names] if isinstance(names, str) else list(names)


def in_interval(point: Column, start: Column, end: Column, closed: str = "both") -> Column:
    """``start <= point`` and (``end`` is NULL or ``point <= end`` / ``point < end``).

    ``closed='both'`` is the closed window of name histories; ``closed='left'``
    is the half-open ``[effective_at, removed_at)`` of PIT reference rows.
    A NULL start never matches (the comparison is NULL).
    """
    upper = point <= end if closed == "both" else point < end
    return (point >= start) & (end.isNull() | upper)


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    *,
    point: str,
    start: str,
    end: str,
    on: Sequence[str] | str | None = None,
    how: str = "inner",
    closed: str = "both",
) -> DataFrame:
    """Join each point row to every interval row that contains it.

    With ``on`` keys this is an equi-join on the keys with the range as a
    residual condition.  Without keys the intervals are expanded to the years
    they span (open ends stop at the last point year) and equi-joined on the
    year, so the work is (#points + #interval-years), not #points x #intervals.
    Column names of the two sides must not overlap except for ``on``.
    """
    keys = _cols(on)
    p = points.alias("_p")
    i = intervals.alias("_i")
    inside = in_interval(F.col(f"_p.{point}"), F.col(f"_i.{start}"), F.col(f"_i.{end}"), closed)
    if keys:
        cond = inside
        for k in keys:
            cond = cond & (F.col(f"_p.{k}") == F.col(f"_i.{k}"))
        out = p.join(i, cond, how)
        if how in ("left_semi", "left_anti", "semi", "anti", "leftsemi", "leftanti"):
            return out
        return out.select("_p.*", *[F.col(f"_i.{c}") for c in intervals.columns if c not in keys])
    last_year = points.agg(F.max(F.year(point)).alias("_last_year")).withColumn("_one", F.lit(1))
    spans = (
        i.withColumn("_one", F.lit(1))
        # one-row table: the last year present among the points
        .join(F.broadcast(last_year), "_one")
        .withColumn(
            "_year",
            F.explode(
                F.sequence(
                    F.year(F.col(start)),
                    F.greatest(F.year(F.col(start)), F.coalesce(F.year(F.col(end)), F.col("_last_year"))),
                )
            ),
        )
        .drop("_one", "_last_year")
        .alias("_i")
    )
    p2 = p.withColumn("_year", F.year(F.col(point))).alias("_p")
    cond = (F.col("_p._year") == F.col("_i._year")) & in_interval(
        F.col(f"_p.{point}"), F.col(f"_i.{start}"), F.col(f"_i.{end}"), closed
    )
    out = p2.join(spans, cond, how)
    return out.select(*[F.col(f"_p.{c}") for c in points.columns], *[F.col(f"_i.{c}") for c in intervals.columns])


def existence_flag(
    rows: DataFrame,
    candidates: DataFrame,
    *,
    row_keys: Sequence[str],
    on: Sequence[tuple[str, str]],
    condition,
    name: str,
) -> DataFrame:
    """Add boolean ``name``: does any candidate match the row?

    ``on`` pairs (row column, candidate column) form the equi part, and
    ``condition(r, c)`` (two aliased DataFrames' column getters) the residual.
    Implemented as a left-semi join of the row keys (sort-merge or broadcast,
    chosen at runtime) joined back on ``row_keys``; rows without a match get
    FALSE.  ``row_keys`` must identify rows uniquely.
    """
    r = rows.alias("_r")
    c = candidates.alias("_c")
    cond = None
    for a, b in on:
        part = F.col(f"_r.{a}") == F.col(f"_c.{b}")
        cond = part if cond is None else cond & part
    res = condition(lambda x: F.col(f"_r.{x}"), lambda x: F.col(f"_c.{x}"))
    if res is not None:
        cond = cond & res
    hits = r.join(c, cond, "left_semi").select(*[F.col(f"_r.{k}").alias(k) for k in row_keys]).withColumn(name, F.lit(True))
    return rows.join(hits, list(row_keys), "left").withColumn(name, F.coalesce(F.col(name), F.lit(False)))


MAX_BUCKETS = 10_000


def running(
    df: DataFrame,
    *,
    order: str,
    bucket: Column,
    value: Column,
    out: str,
    how: str = "last",
    direction: str = "forward",
    tie: Sequence[Column] = (),
    totals_of: DataFrame | None = None,
) -> DataFrame:
    """``out`` = 'last' (ignoring nulls), 'min', 'max' or 'sum' of ``value`` over all rows up to this one in order.

    A prefix scan over many tasks instead of one window over everything: ``bucket``, which must not fall as the order rises
    (a year, a range of row numbers), cuts the rows into ranges that are scanned each for itself; the totals of the
    buckets, one value each and ``MAX_BUCKETS`` at most, are summed up once and carried into the later ones.  With direction
    'back' the rows are read from the greatest order down.  Rows of equal order follow ``tie``; ``totals_of`` may name a
    part of the rows that holds all values.  Totals are gathered when this is called.
    """
    tagged = lambda d: d.withColumns({"_b": bucket, "_v": value})
    up = direction == "forward"
    step = [F.col(order).asc_nulls_first() if up else F.col(order).desc_nulls_last(), *tie]
    held = tagged(df if totals_of is None else totals_of).where(F.col("_v").isNotNull())
    if how == "last":
        nth = F.row_number().over(Window.partitionBy("_b").orderBy(*step))
        count = F.count(F.lit(1)).over(Window.partitionBy("_b"))
        totals = held.withColumns({"_nth": nth, "_n": count}).where("_nth = _n").select("_b", F.col("_v").alias("_t"))
    else:
        totals = held.groupBy("_b").agg({"min": F.min, "max": F.max, "sum": F.sum}[how]("_v").alias("_t"))
    found = totals.limit(MAX_BUCKETS + 1).collect()
    if len(found) > MAX_BUCKETS:
        raise ValueError(f"more than {MAX_BUCKETS} buckets")
    known = sorted(((r["_b"], r["_t"]) for r in found if r["_b"] is not None), reverse=direction == "back")
    join = {"last": lambda a, b: b, "min": min, "max": max, "sum": lambda a, b: a + b}[how]
    carried, so_far = [], None
    for b, t in known:
        so_far = t if so_far is None else join(so_far, t)
        carried.append((b, so_far))
    # A bucket's carry is the total of the nearest bucket before it, whether or not it holds values itself.
    carry = F.lit(None)
    if carried:
        entries = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(t).alias("t")) for b, t in carried])
        passed = F.filter(entries, lambda x: x["b"] < F.col("_b") if up else x["b"] > F.col("_b"))
        carry = F.get(passed, F.size(passed) - 1)["t"]
    w = Window.partitionBy("_b").orderBy(*step).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.last("_v", ignorenulls=True).over(w) if how == "last" else {"min": F.min, "max": F.max, "sum": F.sum}[how]("_v").over(w)
    both = {"last": F.coalesce("_own", "_carry"), "min": F.least("_own", "_carry"), "max": F.greatest("_own", "_carry"),
            "sum": F.when(F.col("_own").isNull() & F.col("_carry").isNull(), None).otherwise(F.coalesce("_own", F.lit(0)) + F.coalesce("_carry", F.lit(0)))}[how]
    scanned = tagged(df).withColumn("_own", own)
    kind = scanned.schema["_own"].dataType
    return scanned.withColumn("_carry", carry.cast(kind)).withColumn(out, both.cast(kind)).drop("_b", "_v", "_own", "_carry")


def next_asof(
    rows: DataFrame,
    *,
    point: str,
    calendar: DataFrame,
    calendar_col: str,
    out: str,
    strict: bool = True,
) -> DataFrame:
    """``out`` = the first calendar date after ``point`` (``>=`` when not strict).

    Resolved once per distinct point date: distinct point dates and calendar dates are united and scanned newest-first
    with a running minimum of the calendar dates seen so far, year by year with a carry (``running``).  Within one day,
    point rows come before calendar rows for the strict lookup (a same-day calendar date is not "after"), after them
    otherwise.  The answer is equi-joined back to ``rows``.
    """
    pts = rows.select(F.col(point).alias("_d")).where(F.col("_d").isNotNull()).distinct().withColumn("_cal", F.lit(None).cast("date"))
    cal = calendar.select(F.col(calendar_col).alias("_d")).where(F.col("_d").isNotNull()).distinct().withColumn("_cal", F.col("_d"))
    both = pts.unionByName(cal).withColumn("_is_cal", F.col("_cal").isNotNull())
    tie = F.col("_is_cal").asc() if strict else F.col("_is_cal").desc()
    scanned = running(both, order="_d", bucket=F.year("_d"), value=F.col("_cal"), out=out, how="min", direction="back", tie=[tie], totals_of=cal)
    resolved = scanned.where(~F.col("_is_cal")).select(F.col("_d").alias(point), out)
    return rows.join(resolved, point, "left")


def asof_event(
    rows: DataFrame,
    events: DataFrame,
    *,
    on: Sequence[tuple[str, str]],
    point: str,
    event_date: str,
    out: str,
    direction: str = "after",
    inclusive: bool = False,
) -> DataFrame:
    """``out`` = the nearest event date of the same key after (or before)
    ``point``; ``inclusive`` also accepts an event on the point itself.

    Rows and events are unioned and scanned once per key in date order with a
    running minimum (``after``, newest first) or maximum (``before``, oldest
    first) of the event dates seen so far — a sort per key, never a pairing of
    every row with every event of its key.  Within one day, rows sort before
    events for the exclusive lookup and after them for the inclusive one.
    Rows with a NULL point get NULL.
    """
    keys = [a for a, _ in on]
    r = rows.withColumn("_pt", F.col(point)).withColumn("_is_ev", F.lit(False)).withColumn("_ev", F.lit(None).cast("date"))
    e = events.where(F.col(event_date).isNotNull()).select(
        *[F.col(b).alias(a) for a, b in on], F.col(event_date).alias("_ev")
    ).withColumn("_pt", F.col("_ev")).withColumn("_is_ev", F.lit(True))
    both = r.unionByName(e, allowMissingColumns=True)
    tie = F.col("_is_ev").desc() if inclusive else F.col("_is_ev").asc()
    if direction == "after":
        order, agg = [F.col("_pt").desc_nulls_last(), tie], F.min
    elif direction == "before":
        order, agg = [F.col("_pt").asc_nulls_last(), tie], F.max
    else:
        raise ValueError(f"direction must be 'after' or 'before', not {direction!r}")
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn(out, F.when(F.col("_pt").isNotNull(), agg("_ev").over(w)))
    return found.where(~F.col("_is_ev")).drop("_pt", "_ev", "_is_ev")


@dataclass(frozen=True)
class Lookup:
    """What ``asof_events`` finds among the events of some kinds.

    how: 'last' (the latest date on or before the point), 'next' (the earliest on or after it), 'same' (how many on that
    day) or 'total' (how many the key has).
    """

    out: str
    how: str
    kinds: tuple[str, ...]


def asof_events(rows: DataFrame, events: Mapping[str, tuple[DataFrame, str, str]], *, key: str, point: str, lookups: Sequence[Lookup]) -> DataFrame:
    """All lookups among events of all kinds in one pass forward and one back.

    events: kind -> (frame, key column, date column); rows without key or date are no events.  Rows and events of all kinds
    are united and shuffled once by the key.  The forward window answers 'last', 'same' and 'total', the backward one
    'next'; frames are ranges of the date, so rows and events of one day see each other whatever their order.  A row with a null
    key or point finds nothing (null dates, counts of 0).
    """
    tagged = None
    for kind, (frame, of, date) in events.items():
        e = frame.select(F.col(of).alias(key), F.col(date).cast("date").alias("_at"), F.lit(kind).alias("_kind")).where(F.col(key).isNotNull() & F.col("_at").isNotNull())
        tagged = e if tagged is None else tagged.unionByName(e)
    both = rows.withColumns({"_at": F.col(point), "_kind": F.lit(None).cast("string")})
    if tagged is not None:
        both = both.unionByName(tagged, allowMissingColumns=True)
    forward, back = Window.partitionBy(key).orderBy(F.col("_at").asc_nulls_first()), Window.partitionBy(key).orderBy(F.col("_at").desc_nulls_first())
    until_now = (Window.unboundedPreceding, Window.currentRow)
    known = F.col(point).isNotNull() & F.col(key).isNotNull()
    found = {}
    for x in lookups:
        hit = F.col("_kind").isin(*x.kinds)
        if x.how == "last":
            found[x.out] = F.when(known, F.max(F.when(hit, F.col("_at"))).over(forward.rangeBetween(*until_now)))
        elif x.how == "next":
            found[x.out] = F.when(known, F.min(F.when(hit, F.col("_at"))).over(back.rangeBetween(*until_now)))
        elif x.how == "same":
            found[x.out] = F.when(known, F.count_if(hit).over(forward.rangeBetween(Window.currentRow, Window.currentRow))).otherwise(0)
        elif x.how == "total":
            found[x.out] = F.when(known, F.count_if(hit).over(forward.rangeBetween(Window.unboundedPreceding, Window.unboundedFollowing))).otherwise(0)
        else:
            raise ValueError(f"unknown lookup {x.how}")
    return both.withColumns(found).where(F.col("_kind").isNull()).select(*rows.columns, *found)


def event_in_window(
    rows: DataFrame,
    events: DataFrame,
    *,
    on: Sequence[tuple[str, str]],
    after: str,
    until: str,
    event_date: str,
    name: str,
) -> DataFrame:
    """Boolean ``name``: an event of the same key in ``(after, until]``.

    The first event strictly after ``after`` (an as-of scan) lies on or
    before ``until``.
    """
    tmp = f"_{name}_next"
    out = asof_event(rows, events, on=on, point=after, event_date=event_date, out=tmp, direction="after")
    return out.withColumn(name, F.coalesce(F.col(tmp) <= F.col(until), F.lit(False))).drop(tmp)


def nearest_distance(
    rows: DataFrame,
    events: DataFrame,
    *,
    row_keys: Sequence[str] = (),
    on: Sequence[tuple[str, str]],
    point: str,
    event_date: str,
    out: str,
    event_filter: Column | None = None,
) -> DataFrame:
    """``out`` = min |event_date - point| in days over the key's events (NULL if none).

    The nearest event is either the last one on/before the point or the first
    one on/after it: two as-of scans, no pairing.
    """
    ev = events if event_filter is None else events.where(event_filter)
    a = asof_event(rows, ev, on=on, point=point, event_date=event_date, out="_prev", direction="before", inclusive=True)
    a = asof_event(a, ev, on=on, point=point, event_date=event_date, out="_next", direction="after", inclusive=True)
    d = F.least(F.datediff(F.col(point), F.col("_prev")), F.datediff(F.col("_next"), F.col(point)))
    return a.withColumn(out, d).drop("_prev", "_next")


def nearest_row(
    rows: DataFrame,
    events: DataFrame,
    *,
    row_keys: Sequence[str] = (),
    on: Sequence[tuple[str, str]],
    point: str,
    event_date: str,
    out_date: str,
    out_days: str,
) -> DataFrame:
    """Nearest event per row: smallest distance, ties to the earlier event date."""
    a = asof_event(rows, events, on=on, point=point, event_date=event_date, out="_prev", direction="before", inclusive=True)
    a = asof_event(a, events, on=on, point=point, event_date=event_date, out="_next", direction="after", inclusive=True)
    dp, dn = F.datediff(F.col(point), F.col("_prev")), F.datediff(F.col("_next"), F.col(point))
    take_prev = F.col("_prev").isNotNull() & (F.col("_next").isNull() | (dp <= dn))
    return (
        a.withColumn(out_date, F.when(take_prev, F.col("_prev")).otherwise(F.col("_next")))
        .withColumn(out_days, F.when(take_prev, dp).otherwise(dn))
        .drop("_prev", "_next")
    )


def shift_clamped(
    df: DataFrame,
    *,
    keys: Sequence[str],
    order: str,
    value: str,
    back: int,
    forward: int,
    out_back: str,
    out_forward: str,
) -> DataFrame:
    """Value ``back`` rows earlier / ``forward`` rows later within the key,
    clamped to the first / last row of the key when out of range.

    One window partition per key; ``first``/``last`` over the whole partition
    give the clamps, so no self-join is needed.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumn(
        out_back, F.coalesce(F.lag(value, back).over(w), F.first(value).over(whole))
    ).withColumn(out_forward, F.coalesce(F.lead(value, forward).over(w), F.last(value).over(whole)))


def close_intervals(
    df: DataFrame,
    *,
    keys: Sequence[str],
    effective: str,
    removed: str,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Cut each interval at the next interval's start within the key.

    ``removed = least(removed, next effective)``; NULL means open.  Equal
    start dates produce a zero-length interval, which is kept.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(effective).asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tiebreak])
    nxt = F.lead(effective).over(w)
    return df.withColumn(removed, F.least(F.col(removed), nxt))


def _islands(rows: DataFrame, group: Sequence[str], member: Sequence[str], snapshot: str, aggregates: Mapping[str, Column]) -> DataFrame:
    """Runs of consecutive snapshots of each member; ``_next`` is the group's snapshot after a row's."""
    g, m = list(group), list(member)
    dates = rows.select(*g, snapshot).distinct()
    rank_w = Window.partitionBy(*g).orderBy(snapshot)
    ranked_dates = dates.withColumn("_rank", F.row_number().over(rank_w)).withColumn(
        "_next", F.lead(snapshot).over(rank_w)
    )
    ranked = rows.join(ranked_dates, [*g, snapshot])
    member_w = Window.partitionBy(*g, *m).orderBy("_rank")
    ranked = ranked.withColumn("_island", F.col("_rank") - F.row_number().over(member_w))
    return ranked.groupBy(*g, *m, "_island").agg(*[c.alias(n) for n, c in aggregates.items()]).drop("_island")


def islands(
    snapshots: DataFrame,
    *,
    group: Sequence[str],
    member: Sequence[str],
    snapshot: str,
    start_out: str = "effective_at",
    end_out: str = "removed_at",
    seen_out: str | None = None,
) -> DataFrame:
    """Membership intervals from full snapshots (gaps and islands).

    A member present in consecutive snapshots of its group forms one interval
    ``[first snapshot, first snapshot without it)``; the end is NULL when the
    member is in the group's last snapshot, and a re-entry opens a new
    interval.  Snapshot ranks come from the distinct snapshot dates per group
    (a small table), the island id from ``rank - row_number`` per member.
    ``seen_out`` names a column for the last snapshot that holds the member;
    with it the result is a state that ``extend_islands`` goes on from.
    """
    rows = snapshots.select(*group, *member, snapshot).distinct()
    aggregates = {start_out: F.min(snapshot), end_out: F.max_by(F.col("_next"), F.col("_rank"))}
    return _islands(rows, group, member, snapshot, aggregates | ({seen_out: F.max(snapshot)} if seen_out else {}))


def extend_islands(
    state: DataFrame,
    snapshots: DataFrame,
    *,
    group: Sequence[str],
    member: Sequence[str],
    snapshot: str,
    start_out: str = "effective_at",
    end_out: str = "removed_at",
    seen_out: str = "last_seen",
) -> DataFrame:
    """The state of ``islands`` after further snapshots, without reading earlier ones again.

    Only open intervals take part: each stands for its member in the group's last snapshot, to which the new snapshots are
    appended; an interval that goes on keeps its start.  Closed intervals pass through.  The state is read several times: hand in
    a stored table or a checkpoint, and store the result before the next call.  A snapshot that isn't later than
    the group's last one is an error: what lay between is not in the state.
    """
    g, m = list(group), list(member)
    columns = [*g, *m, start_out, end_out, seen_out]
    still = state.where(F.col(end_out).isNull())
    last = still.groupBy(*[F.col(c).alias(f"_{c}") for c in g]).agg(F.max(seen_out).alias("_last"))
    same_group = F.lit(True)
    for c in g:
        same_group = same_group & F.col(c).eqNullSafe(F.col(f"_{c}"))
    new = snapshots.select(*g, *m, snapshot).distinct().join(last, same_group, "left")
    late = F.concat(F.lit("snapshot is not later than the state: "), F.col(snapshot).cast("string"))
    new = new.select(*g, *m, F.when(F.col(snapshot) <= F.col("_last"), F.raise_error(late).cast("date")).otherwise(F.col(snapshot)).alias(snapshot), F.lit(None).cast(state.schema[start_out].dataType).alias("_from"))
    rows = new.unionByName(still.select(*g, *m, F.col(seen_out).alias(snapshot), F.col(start_out).alias("_from")))
    grown = _islands(rows, g, m, snapshot, {start_out: F.min(F.coalesce("_from", snapshot)), end_out: F.max_by(F.col("_next"), F.col("_rank")), seen_out: F.max(snapshot)})
    return state.where(F.col(end_out).isNotNull()).select(*columns).unionByName(grown.select(*columns))


def interval_sets(intervals: DataFrame, *, key: str, start: str, end: str, out: str) -> DataFrame:
    """One row for each key: its closed day intervals, merged and sorted, as an array of (first, last).

    A NULL end is open (``FAR_FUTURE``); intervals that overlap or follow each other without a day between become one;
    those without a start, or with the end before it, hold no day.
    """
    far = F.to_date(F.lit(FAR_FUTURE))
    known = intervals.select(key, F.col(start).alias("_s"), F.coalesce(F.col(end), far).alias("_e")).where(F.col(key).isNotNull() & (F.col("_s") <= F.col("_e")))
    w = Window.partitionBy(key).orderBy("_s", "_e")
    reach = F.max("_e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.datediff("_s", reach) > 1, F.lit(True)).cast("int")
    numbered = known.withColumn("_opens", opens).withColumn("_nth", F.sum("_opens").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    merged = numbered.groupBy(key, "_nth").agg(F.min("_s").alias("first"), F.max("_e").alias("last"))
    return merged.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias(out))


def in_interval_set(point: Column, intervals: Column) -> Column:
    """Whether a day lies in one of a key's intervals (FALSE where there are none or the day is NULL)."""
    return F.coalesce(F.exists(intervals, lambda x: (x["first"] <= point) & (point <= x["last"])), F.lit(False))


def interval_set_days(sets: DataFrame, days: DataFrame, *, key: str, intervals: str, day: str) -> DataFrame:
    """(key, day) for each of the given days, distinct ones, that lies in the key's set: days of a set are listed between the
    first and the last of ``days`` and joined on the day."""
    first, last = (days.agg(f(day).alias("_d")).scalar() for f in (F.min, F.max))
    part = sets.select(key, F.explode(intervals).alias("_x")).select(key, F.greatest("_x.first", first).alias("_s"), F.least("_x.last", last).alias("_e"))
    listed = part.where(F.col("_s") <= F.col("_e")).select(key, F.explode(F.sequence("_s", "_e")).alias(day))
    return listed.join(days.select(day), day).select(key, day)


def reach_before(rows: DataFrame, intervals: DataFrame, *, on: Sequence[str], point: str, start: str, end: str, out: str, inclusive: bool = False) -> DataFrame:
    """``out`` = the greatest end among the key's intervals that start before ``point`` (or on it, if inclusive).

    One sweep over rows and intervals of a key in order of point and start with a running maximum.  A row [a, b) overlaps an
    interval exactly if the reach before b lies after a, and lies within one exactly if the reach up to a isn't before b.
    """
    both = rows.withColumns({"_pos": F.col(point), "_row": F.lit(True), "_end": F.lit(None).cast(intervals.schema[end].dataType)}).unionByName(
        intervals.select(*on, F.col(start).alias("_pos"), F.col(end).alias("_end"), F.lit(False).alias("_row")), allowMissingColumns=True)
    order = [F.col("_pos").asc_nulls_first(), F.col("_row").asc() if inclusive else F.col("_row").desc()]
    w = Window.partitionBy(*on).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = both.withColumn(out, F.max(F.when(F.col("_pos").isNotNull(), F.col("_end"))).over(w))
    return swept.where("_row").drop("_pos", "_row", "_end")


ROWS_A_BUCKET = 1 << 16


def forward_fill(df: DataFrame, *, order: str, value: Column, out: str, partition: Sequence[str] = ()) -> DataFrame:
    """``out`` = last non-NULL ``value`` up to the current row (running).

    With ``partition`` one window per key; without, a scan over ranges of the whole numbers in ``order`` (``running``).
    """
    if not partition:
        return running(df, order=order, bucket=F.floor(F.col(order) / ROWS_A_BUCKET), value=value, out=out)
    w = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.last(value, ignorenulls=True).over(w))
