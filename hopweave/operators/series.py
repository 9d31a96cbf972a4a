"""Interval-coded account series: sparse day rows and each account's first and last day.

A dense daily table repeats zeros: nearly all of its rows say that nothing happened.  The
operators here take only the days with activity, ``days`` (address, day, measures), and
``spans`` (address, first_day, last_day).  Idle time is a run (first week, number of weeks)
between two active weeks; weeks are generated from runs and spans, days only for weeks that
are kept.  Results equal those of the dense forms in ``shrink`` and ``windows``.

Scale: an account contributes a row per active week and two marks to a window partitioned by
address (a calendar's worth of rows at most); the only shuffles are by address.

Defined results: days outside their account's span do not count; a null measure is 0; an
account without active days is one idle run; rows that repeat a day are added up; accounts
without a span have no series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hopweave.functions.common import iso_week, month_label
from hopweave.operators.shrink import ACTIVITY_COLUMNS
from hopweave.operators.windows import ETH_NUMS, INT_COUNTS, MAX_ONLY, existing, series_aggs

DAYS_A_WEEK = 7


def week_no(day: Column) -> Column:
    """Weeks since the Monday before 1970-01-01."""
    return F.floor((F.unix_date(day) + 3) / DAYS_A_WEEK)


def monday(week: Column) -> Column:
    return F.date_from_unix_date((week * DAYS_A_WEEK - 3).cast("int"))


def _activity(columns) -> Column:
    return sum((F.coalesce(F.col(c), F.lit(0)) for c in columns[1:]), F.coalesce(F.col(columns[0]), F.lit(0)))


def _in_span(days: DataFrame, spans: DataFrame) -> DataFrame:
    return days.join(spans, "address").where(F.col("day").between(F.col("first_day"), F.col("last_day")))


def coded_weeks(days: DataFrame, spans: DataFrame, mode: str = "reference", activity_cols=ACTIVITY_COLUMNS) -> DataFrame:
    """One row per active week and one per account's end, each with the idle run before it.

    (address, week_no, week_activity, ends, gap, run_no, run_weeks, first_day, last_day): ``gap``
    idle weeks come right before ``week_no``, run ``run_no`` of ``run_weeks`` weeks.  An
    account's end (``ends``) stands in the week after its last day.  Modes as in
    ``shrink.p_idle_runs``.
    """
    if mode not in ("reference", "strict"):
        raise ValueError(f"unknown mode {mode!r}")
    sums = _in_span(days, spans).groupBy("address", week_no(F.col("day")).alias("week_no")).agg(F.sum(_activity(activity_cols)).alias("week_activity"))
    none = F.lit(None)
    active = sums.where("week_activity > 0").select("address", "week_no", "week_activity", F.lit(0).alias("kind"),
                                                    none.cast("date").alias("first_day"), none.cast("date").alias("last_day"))
    both = F.array(F.struct((week_no(F.col("first_day")) - 1).alias("week_no"), F.lit(-1).alias("kind")),
                   F.struct((week_no(F.col("last_day")) + 1).alias("week_no"), F.lit(1).alias("kind")))
    marks = spans.select("address", F.explode(both).alias("m"), "first_day", "last_day") \
        .select("address", "m.week_no", none.cast("long").alias("week_activity"), "m.kind", "first_day", "last_day")
    account = Window.partitionBy("address")
    order = account.orderBy("week_no", "kind")
    rows = active.unionByName(marks).withColumns({
        "gap": F.col("week_no") - F.lag("week_no").over(order) - 1, "_leads": F.lag("kind").over(order) == -1,
        "first_day": F.max("first_day").over(account), "last_day": F.max("last_day").over(account), "_end": F.max("week_no").over(account)})
    opens = F.col("gap") > 0
    counted = opens & ~F.col("_leads") if mode == "reference" else opens
    rows = rows.withColumns({"run_no": F.count_if(counted).over(order), "_start": F.when(opens, F.col("week_no") - F.col("gap"))})
    later = account.orderBy(F.desc("week_no"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    until = F.coalesce(F.min("_start").over(later), "_end")              # where the next run begins
    rows = rows.withColumn("run_weeks", F.when(opens, (until - F.col("_start")) if mode == "reference" else F.col("gap")))
    return rows.where("kind >= 0").select("address", "week_no", "week_activity", (F.col("kind") == 1).alias("ends"), "gap", "run_no", "run_weeks",
                                          "first_day", "last_day")


def _places(gap: Column, wanted=None) -> Column:
    """Places 1 .. gap of an idle run (those wanted)."""
    every = F.when(gap > 0, F.sequence(F.lit(1), gap.cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.filter(every, wanted) if wanted else every


def _weeks_of(coded: DataFrame, wanted=None) -> DataFrame:
    """A row per (wanted) week, idle ones generated from their runs."""
    week = lambda no, idle, act, place, total: F.struct(
        no.cast("long").alias("week_no"), idle.alias("is_idle"), act.cast("long").alias("week_activity"), place.cast("long").alias("place"),
        total.cast("long").alias("run_weeks"))
    none = F.lit(None)
    idle = F.transform(_places(F.col("gap"), wanted), lambda p: week(
        F.col("week_no") - F.col("gap") + p - 1, F.lit(True), F.lit(0), p, F.col("run_weeks")))
    own = F.when(F.col("ends"), F.array().cast(
        "array<struct<week_no:bigint,is_idle:boolean,week_activity:bigint,place:bigint,run_weeks:bigint>>")).otherwise(
        F.array(week(F.col("week_no"), F.lit(False), F.col("week_activity"), none, none)))
    return coded.select("address", "run_no", "first_day", "last_day", F.explode(F.concat(idle, own)).alias("w")) \
        .select("address", "run_no", "first_day", "last_day", "w.*").withColumn("week", monday(F.col("week_no")))


def week_marks(days: DataFrame, spans: DataFrame, activity_cols=ACTIVITY_COLUMNS) -> DataFrame:
    """Activity of every week of every account, idle weeks included."""
    return _weeks_of(coded_weeks(days, spans, "strict", activity_cols)).select("address", "week", "week_activity")


def idle_runs(days: DataFrame, spans: DataFrame, mode: str = "reference", activity_cols=ACTIVITY_COLUMNS) -> DataFrame:
    """(address, week, week_activity, is_idle, run_no, place, run_weeks) of every week."""
    return _weeks_of(coded_weeks(days, spans, mode, activity_cols)) \
        .select("address", "week", "week_activity", "is_idle", "run_no", "place", "run_weeks")


def keep_weeks(days: DataFrame, spans: DataFrame, keep_every: int = 4, mode: str = "reference", activity_cols=ACTIVITY_COLUMNS) -> DataFrame:
    """Daily rows (zeros filled in) of the weeks kept: active ones, the first and the last place
    of an idle run, and of runs of three weeks or more every ``keep_every``-th place."""
    def wanted(p):
        total = F.col("run_weeks")
        return (p == 1) | (p == total) | ((total >= 3) & (p % keep_every == 1 % keep_every))
    weeks = _weeks_of(coded_weeks(days, spans, mode, activity_cols), wanted)
    measures = [c for c in days.columns if c not in ("address", "day")]
    sums = days.where(F.col("day").isNotNull()).repartition("address").groupBy("address", "day").agg(*[F.sum(c).alias(c) for c in measures])
    # A week's active days (seven at most) meet it before it is expanded: no day is joined or sorted.
    active = sums.groupBy("address", monday(week_no(F.col("day"))).alias("week")).agg(
        F.map_from_entries(F.collect_list(F.struct("day", F.struct(*measures)))).alias("_active"))
    weeks = weeks.join(active.hint("shuffle_hash"), ["address", "week"], "left")
    last = F.least(F.date_add("week", DAYS_A_WEEK - 1), "last_day")
    kept = weeks.select("address", "week", "_active", F.explode(F.sequence(F.greatest("week", "first_day"), last)).alias("day")) \
        .select("address", "day", "week", F.col("_active")[F.col("day")].alias("_sums"))
    out = kept.select("address", "day", "week", *[F.col("_sums")[c].alias(c) for c in measures]).fillna(0, measures)
    return out.select("address", "day", *measures, "week", _activity(activity_cols).alias("day_activity"))


# ---- weekly and monthly rollups ------------------------------------------------------

def mapped(days: DataFrame, spans: DataFrame, address_map: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Days and spans of the accounts that have a node, under its id."""
    ids = address_map.select(F.lower("address").alias("address"), "node_id").groupBy("address").agg(F.min("node_id").alias("node_id"))
    of = lambda df: df.withColumn("address", F.lower("address")).join(ids, "address")
    measures = existing(days, INT_COUNTS + ETH_NUMS)
    inside = _in_span(days.select("address", F.col("day").cast("date").alias("day"), *measures), spans)
    return of(inside).select("node_id", "day", *measures), of(spans).select("node_id", "first_day", "last_day")


def label_week_no(label: Column) -> Column:
    """``week_no`` of an ISO week label: the week of January 4 is the year's first."""
    first = F.make_date(F.substring(label, 1, 4).cast("int"), F.lit(1), F.lit(4))
    return week_no(first) + F.substring(label, 7, 2).cast("int") - 1


def _wanted(week_index: DataFrame) -> DataFrame:
    """(week_no, week) of the index, to broadcast: about 53 rows a year."""
    return F.broadcast(week_index.select("week").distinct().select(label_week_no(F.col("week")).alias("week_no"), "week"))


def _own_sums(rows: DataFrame, key: str) -> DataFrame:
    """Sums per node and active week or month, as an entry of the node's map."""
    sums = rows.where(F.col(key).isNotNull()).groupBy("node_id", key).agg(*series_aggs(rows))
    return sums.select("node_id", key, F.struct(key, F.struct(*[c for c in sums.columns if c not in ("node_id", key)])).alias("_own"))


def _filled(rows: DataFrame, key: str) -> DataFrame:
    """Output rows of (node_id, key, _inside, _sums): zeros where nothing happened, also in the maximum of a week or month of a span."""
    def value(c):
        v = F.col("_sums")[c]
        if c in ETH_NUMS:
            return F.coalesce(v, F.lit(0).cast("decimal(38,9)").cast("string"))
        zero = F.lit(0).cast("long")
        return F.coalesce(F.when(F.col("_inside"), F.greatest(v, zero)).otherwise(v) if c in MAX_ONLY else v, zero)
    return rows.select("node_id", key, *[value(c).alias(c) for c in rows.schema["_sums"].dataType.names])


#: Weeks of a block, which are bits of one number there.
BLOCK_WEEKS = 26


def _block(no: Column) -> Column:
    return F.floor(no / BLOCK_WEEKS)


def _span_ends(spans: DataFrame) -> DataFrame:
    lo, hi = week_no(F.col("first_day")), week_no(F.col("last_day"))
    return spans.where(lo.isNotNull() & hi.isNotNull()).select("node_id", F.least(lo, hi).alias("_lo"), F.greatest(lo, hi).alias("_hi"))


def weekly(days: DataFrame, spans: DataFrame, week_index: DataFrame, nodes_a_share: int | None = None) -> DataFrame:
    """Per (node, ISO week) of the index that a span touches: sums as in ``windows.s_weekly``.

    ``days`` and ``spans`` as ``mapped`` returns them; an idle week is one row of zeros.  Only active
    weeks and a row per node and block of weeks are shuffled; idle weeks are generated last.

    With ``nodes_a_share`` (for ``windows.write_parts`` with ``dealt``) a task holds the weeks of few blocks, for about so
    many nodes of a block: it writes few windows, and a window has a file per share.
    """
    own = _own_sums(days.withColumn("week_no", week_no(F.col("day"))).drop("day"), "week_no")
    active = own.select("node_id", _block(F.col("week_no")).alias("block"), "_own", F.lit(None).cast("long").alias("_in"))
    ends = _span_ends(spans)
    marks = ends.select("node_id", "_lo", "_hi", F.explode(F.sequence(_block(F.col("_lo")), _block(F.col("_hi")))).alias("block")) \
        .withColumns({"_lo": F.greatest(F.col("_lo") - F.col("block") * BLOCK_WEEKS, F.lit(0)).cast("int"),
                      "_hi": F.least(F.col("_hi") - F.col("block") * BLOCK_WEEKS, F.lit(BLOCK_WEEKS - 1)).cast("int")})
    marks = marks.select("node_id", "block", F.lit(None).cast(active.schema["_own"].dataType).alias("_own"),
                         F.expr("shiftleft(shiftleft(1L, _hi - _lo + 1) - 1L, _lo)").alias("_in"))
    rows, keys = active.unionByName(marks), ["node_id", "block"]
    if nodes_a_share:
        r = ends.agg(F.count(F.lit(1)).alias("n"), F.min(_block(F.col("_lo"))).alias("lo"), F.max(_block(F.col("_hi"))).alias("hi")).first()
        shares = max(1, -(-r["n"] // nodes_a_share))
        tasks = 4 * shares * ((r["hi"] or 0) - (r["lo"] or 0) + 1)           # few keys share a task by chance
        rows = rows.withColumn("share", F.pmod(F.xxhash64("node_id"), F.lit(shares))).repartition(tasks, "block", "share")
        keys = ["block", "share", "node_id"]
    nodes = rows.groupBy(*keys).agg(F.map_from_entries(F.collect_list("_own")).alias("_own"), F.bit_or("_in").alias("_in"))   # a block's weeks at most
    wanted = _wanted(week_index).groupBy(_block(F.col("week_no")).alias("block")).agg(F.collect_list(F.struct("week_no", "week")).alias("_wanted"))
    cells = nodes.join(F.broadcast(wanted), "block").select("node_id", "block", "_own", "_in", F.explode("_wanted").alias("_w"))
    cells = cells.select("node_id", "_w.week", F.expr(f"coalesce(getbit(_in, cast(_w.week_no - block * {BLOCK_WEEKS} as int)), 0) = 1").alias("_inside"),
                         F.col("_own")[F.col("_w.week_no")].alias("_sums"))
    return _filled(cells.where(F.col("_inside") | F.col("_sums").isNotNull()), "week")


def _week_months(spans: DataFrame) -> DataFrame:
    """(week_no, first of month) pairs of all days of all spans: a week has the month of its
    first and of its last day in the span.

    Inner weeks are whole, so of the spans that begin in a week the longest says which there are."""
    known = spans.where(F.col("first_day").isNotNull() & F.col("last_day").isNotNull()).select(
        "first_day", "last_day", week_no(F.col("first_day")).alias("_w1"), week_no(F.col("last_day")).alias("_w2"))
    sunday = lambda no: F.date_add(monday(no), DAYS_A_WEEK - 1)
    cell = lambda no, day: F.struct(no.alias("week_no"), F.trunc(day, "month").alias("month"))
    w1, w2, week = F.col("_w1"), F.col("_w2"), F.col("week_no")
    outer = known.select(F.explode(F.array(cell(w1, F.col("first_day")), cell(w1, F.least(sunday(w1), "last_day")),
                                           cell(w2, F.greatest(monday(w2), "first_day")), cell(w2, F.col("last_day")))).alias("c"))
    longest = known.groupBy("_w1").agg(F.max("_w2").alias("_w2")).where(w2 - w1 > 1)
    inner = longest.select(F.explode(F.sequence(w1 + 1, w2 - 1)).alias("week_no")).distinct()
    inner = inner.select(F.explode(F.array(cell(week, monday(week)), cell(week, sunday(week)))).alias("c"))
    return outer.unionByName(inner).select("c.week_no", "c.month").distinct()


def week_month_map(spans: DataFrame) -> DataFrame:
    """(week, month) labels of all days of all spans."""
    return _week_months(spans).select(iso_week(monday(F.col("week_no"))).alias("week"), month_label("month").alias("month"))


def monthly(days: DataFrame, spans: DataFrame, week_index: DataFrame, month_index: DataFrame) -> DataFrame:
    """Per (node, month): weeks of the index count in full in every month they touch.

    Equals ``windows.s_monthly`` over ``weekly`` and ``week_month_map``.  The active days go
    straight to their months; a node's row meets the list of months last, so idle weeks and months
    are neither shuffled nor aggregated.
    """
    pairs = _week_months(spans).join(_wanted(week_index), "week_no").select("week_no", month_label("month").alias("month"))
    pairs = pairs.join(F.broadcast(month_index.select("month").distinct()), "month", "left_semi")   # two rows a week at most
    own = _own_sums(days.withColumn("week_no", week_no(F.col("day"))).join(F.broadcast(pairs), "week_no").drop("week_no", "day"), "month")
    span = F.struct("_lo", "_hi")
    marks = _span_ends(spans).select("node_id", F.lit(None).cast(own.schema["_own"].dataType).alias("_own"), span.alias("_span"))
    rows = own.select("node_id", "_own", F.lit(None).cast(marks.schema["_span"].dataType).alias("_span")).unionByName(marks)
    nodes = rows.groupBy("node_id").agg(F.map_from_entries(F.collect_list("_own")).alias("_own"), F.collect_set("_span").alias("_spans"),
                                        F.min("_span._lo").alias("_lo"), F.max("_span._hi").alias("_hi"))
    months = pairs.groupBy("month").agg(F.collect_set("week_no").alias("_weeks"), F.min("week_no").alias("_first"), F.max("week_no").alias("_last"))
    touched = F.exists("_spans", lambda s: F.exists("_weeks", lambda w: w.between(s["_lo"], s["_hi"])))
    simple = (F.size("_spans") == 1) & (F.col("_first").between(F.col("_lo"), F.col("_hi")) | F.col("_last").between(F.col("_lo"), F.col("_hi")))
    inside = F.coalesce((F.col("_lo") <= F.col("_last")) & (F.col("_hi") >= F.col("_first")) & (simple | touched), F.lit(False))
    cells = nodes.crossJoin(F.broadcast(months)).select("node_id", "month", inside.alias("_inside"), F.col("_own")[F.col("month")].alias("_sums"))
    return _filled(cells.where(F.col("_inside") | F.col("_sums").isNotNull()), "month")
