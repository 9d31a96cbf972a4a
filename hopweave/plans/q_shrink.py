"""Registered shrink/profile queries and their SQL oracles.

Week thinning runs on the sparse order days and spans of customers (long idle
stretches); the light projection and profiles run on the daily build.
"""

from __future__ import annotations

from hopweave.operators import series
from hopweave.operators import shrink as p
from hopweave.plans import q_daily
from hopweave.plans.registry import register
from hopweave.sources import fixtures as fx

CAL = ["fx_order_calendar"]
BASE_COLS = ["address", "day", "normal_total_cnt", "erc20_total_cnt", "internal_in_cnt", "internal_out_cnt",
             "week", "day_activity"]


def _base(spark, sf_dir):
    return p.p_day_activity(fx.order_calendar(spark, sf_dir))


def _series(spark, sf_dir):
    """Days with orders, and every account's first and last one."""
    return fx.order_days(spark, sf_dir), fx.order_spans(spark, sf_dir)


def _runs_sql(strict: bool) -> str:
    """The rule over the dense table: window functions over all weeks, one scan each."""
    size = "sum(is_idle::int)" if strict else "count(*)"
    return f"""WITH base AS (select *, cast(date_trunc('week', day) as date) as week,
      normal_total_cnt + erc20_total_cnt + internal_in_cnt + internal_out_cnt as day_activity from fx_order_calendar),
    weekly AS (select address, week, sum(day_activity) as activity from base group by address, week),
    marked AS (select *, not activity > 0 as is_idle, lag(activity > 0) over (partition by address order by week) as was_active from weekly),
    numbered AS (select *, sum(case when is_idle and coalesce(was_active, {str(strict).lower()}) then 1 else 0 end)
      over (partition by address order by week) as run_no from marked),
    placed AS (select address, week, activity as week_activity, is_idle, run_no,
      case when is_idle then sum(is_idle::int) over (partition by address, run_no order by week) end as place,
      case when is_idle then {size} over (partition by address, run_no) end as run_weeks from numbered),
    kept AS (select address, week from placed
      where not is_idle or place = 1 or place = run_weeks or (run_weeks >= 3 and place % 4 = 1)) """


_BASE_OUT = ("select address, cast(day as varchar) as day, normal_total_cnt, erc20_total_cnt, internal_in_cnt, internal_out_cnt, "
             "cast(week as varchar) as week, cast(day_activity as bigint) as day_activity")


@register("p_day_activity", sql=_runs_sql(False) + _BASE_OUT + " from base", fixtures=CAL)
def q_day_activity(spark, sf_dir):
    """Week (Monday) and total activity of each day."""
    return _base(spark, sf_dir).select(*BASE_COLS)


@register("p_week_marks", sql=_runs_sql(False) +
          "select address, cast(week as varchar) as week, cast(activity as bigint) as week_activity from weekly", fixtures=CAL)
def q_week_marks(spark, sf_dir):
    """Activity per (account, week)."""
    return series.week_marks(*_series(spark, sf_dir))


# The dense form of the same rule, over the expanded calendar.
@register("p_keep_weeks_dense", sql=_runs_sql(False) + _BASE_OUT + " from base b where exists "
          "(select 1 from kept k where k.address = b.address and k.week = b.week)", fixtures=CAL)
def q_keep_weeks_dense(spark, sf_dir):
    """Week thinning of a dense daily table."""
    return p.p_keep_weeks(_base(spark, sf_dir)).select(*BASE_COLS)


_RUNS_OUT = "select address, cast(week as varchar) as week, cast(week_activity as bigint) as week_activity, is_idle, cast(run_no as bigint) as run_no"


@register("p_zero_runs", sql=_runs_sql(False) + _RUNS_OUT + " from placed", fixtures=CAL)
def q_idle_runs(spark, sf_dir):
    """Idle run numbers, source rule (an idle first week opens no run)."""
    return series.idle_runs(*_series(spark, sf_dir)).drop("place", "run_weeks")


@register("p_zero_runs_strict", sql=_runs_sql(True) + _RUNS_OUT + " from placed", fixtures=CAL)
def q_idle_runs_strict(spark, sf_dir):
    """Idle run numbers, strict rule (every stretch of idle weeks is a run)."""
    return series.idle_runs(*_series(spark, sf_dir), mode="strict").drop("place", "run_weeks")


@register("p_run_rank", sql=_runs_sql(False) + _RUNS_OUT + ", cast(place as bigint) as place, cast(run_weeks as bigint) as run_weeks from placed",
          fixtures=CAL)
def q_run_place(spark, sf_dir):
    """Place in the run and run length of each idle week."""
    return series.idle_runs(*_series(spark, sf_dir))


@register("p_keep_weeks", sql=_runs_sql(False) + _BASE_OUT + " from base b where exists "
          "(select 1 from kept k where k.address = b.address and k.week = b.week)", fixtures=CAL)
def q_keep_weeks(spark, sf_dir):
    """Daily rows of kept weeks (active, run boundary, every 4th zero week)."""
    return series.keep_weeks(*_series(spark, sf_dir)).select(*BASE_COLS)


@register("p_keep_weeks_strict", sql=_runs_sql(True) + _BASE_OUT + " from base b where exists "
          "(select 1 from kept k where k.address = b.address and k.week = b.week)", fixtures=CAL)
def q_keep_weeks_strict(spark, sf_dir):
    """Week thinning with strict zero runs."""
    return series.keep_weeks(*_series(spark, sf_dir), mode="strict").select(*BASE_COLS)


@register("p_light", sql=q_daily.oracle("final", p.LIGHT_COLUMNS), fixtures=q_daily.FX)
def q_light(spark, sf_dir):
    """28-column light daily table."""
    return p.p_light(q_daily.build(spark, sf_dir)["final"])


NULL_COLS = q_daily.CORE_COLS[2:q_daily.CORE_COLS.index("tx_cnt_18_24") + 1]


def _null_sql():
    inner = q_daily.oracle("final", ["address"])  # reuse the CTE chain
    ctes = inner[:inner.rindex(" select ")]
    cols = ", ".join(f"floor(cast(count(*) filter (where {c} is null) as double) / count(*) * 1e6 + 0.5) / 1e6 "
                     f"as {c}_null_frac" for c in NULL_COLS)
    return f"{ctes} select {cols} from final"


@register("q_null_fractions", sql=_null_sql(), fixtures=q_daily.FX)
def q_null_fracs(spark, sf_dir):
    """Null share of the 46 profiled daily columns (one row)."""
    return p.q_null_fractions(q_daily.build(spark, sf_dir)["final"], NULL_COLS)


def _zero_sql():
    inner = q_daily.oracle("final", ["address"])
    ctes = inner[:inner.rindex(" select ")]
    parts = " union all ".join(f"select '{c}' as col, cast(count(*) filter (where {c} = 0) as double) / count(*) as zero_frac "
                               f"from final" for c in p.ZERO_PROFILE_COLUMNS)
    return f"{ctes} select col, floor(zero_frac * 1e6 + 0.5) / 1e6 as zero_frac from ({parts})"


@register("q_zero_fractions", sql=_zero_sql(), fixtures=q_daily.FX)
def q_zero_fracs(spark, sf_dir):
    """Zero share of 8 light columns, long form, largest first."""
    return p.q_zero_fractions(p.p_light(q_daily.build(spark, sf_dir)["final"]))


@register("q_profile_identities", sql=(lambda i: i[:i.rindex(" select ")] + (
    " select floor(cast(count(*) filter (where normal_sent_cnt = 0) as double) / count(*) * 1e6 + 0.5) / 1e6 as zero_sent, "
    "floor(cast(count(*) filter (where eth_sent_avg is null) as double) / count(*) * 1e6 + 0.5) / 1e6 as null_sent_avg, "
    "floor(cast(count(*) filter (where burst_max_tx_5m = 0) as double) / count(*) * 1e6 + 0.5) / 1e6 as zero_burst, "
    "floor(cast(count(*) filter (where tx_cnt_00_06 is null) as double) / count(*) * 1e6 + 0.5) / 1e6 as null_hour_bucket "
    "from final"))(q_daily.oracle("final", ["address"])), fixtures=q_daily.FX)
def q_identities(spark, sf_dir):
    """Published shape identities: zero sent count ⇔ null sent average, zero burst ⇔ null hour buckets."""
    return p.zero_null_identities(q_daily.build(spark, sf_dir)["final"])
