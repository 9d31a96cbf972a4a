"""Registered account-table and balancing queries and their SQL oracles."""

from __future__ import annotations

from hopweave.operators import accounts as a
from hopweave.operators import shrink as p
from hopweave.plans.registry import register
from hopweave.sources import fixtures as fx

FX = ["fx_accounts", "fx_transactions", "fx_token_transfers", "fx_contracts"]
ENSURE_LOW, ENSURE_HIGH = 50, 250


def base_table(spark, sf_dir):
    return a.build_account_table(fx.accounts(spark, sf_dir), fx.transactions(spark, sf_dir),
                                 fx.token_transfers(spark, sf_dir), fx.contracts(spark, sf_dir))


def _bounds_sql(src):
    return (f"select a.address, min(t.block_timestamp) as first_ts, max(t.block_timestamp) as last_ts from a0 a "
            f"join {src} t on lower(t.from_address) = a.address or lower(t.to_address) = a.address group by a.address")


_RND = "CAST('0x' || substr(md5(concat('42', address)), 1, 15) AS BIGINT)"
_COLS = "address, is_scam, description, activity_start_ts, activity_end_ts, is_contract"


def _q(sel, n, src, cond):
    return (f"select {_COLS} from (select * from {src} where {cond} "
            f"qualify row_number() over (order by {_RND}, address) <= ({n}))")


def chain(ensure: int) -> str:
    ex = a.EXCHANGE_PATTERN.replace("'", "''")
    return (
        "WITH a0 AS (select distinct lower(address) as address, cast(is_scam as bigint) as is_scam, description from fx_accounts), "
        f"txb AS ({_bounds_sql('fx_transactions')}), tkb AS ({_bounds_sql('fx_token_transfers')}), "
        "comb AS (select a.address, a.is_scam, a.description, least(tx.first_ts, tk.first_ts) as f, "
        "greatest(tx.last_ts, tk.last_ts) as l from a0 a left join txb tx using (address) left join tkb tk using (address)), "
        "act AS (select address, is_scam, description, epoch_us(f) // 1000000 as activity_start_ts, "
        "epoch_us(l) // 1000000 as activity_end_ts from comb), "
        "ctr AS (select distinct lower(address) as c from fx_contracts), "
        "base AS (select a.*, cast(case when c.c is not null then 1 else 0 end as bigint) as is_contract from act a left join ctr c on a.address = c.c), "
        f"bx AS (select *, regexp_matches(lower(coalesce(description, '')), '{ex}') as is_exchange from base), "
        "tg0 AS (select count(*) filter (where is_scam = 1) as pos, "
        "count(*) filter (where is_scam = 0 and is_contract = 1 and is_exchange) as con_exch_avail, "
        "count(*) filter (where is_scam = 0 and coalesce(is_contract, 0) = 0 and is_exchange) as eoa_exch_avail from bx), "
        "tg1 AS (select *, cast(floor(pos * cast(1.1 as double) + 0.5) as bigint) as neg_total from tg0), "
        "tg2 AS (select *, neg_total // 2 as neg_contract, neg_total - neg_total // 2 as neg_eoa from tg1), "
        "tg AS (select pos, neg_total, neg_contract, neg_eoa, con_exch_avail, eoa_exch_avail, "
        "least(neg_contract, con_exch_avail) as con_exch_take, least(neg_eoa, eoa_exch_avail) as eoa_exch_take from tg2), "
        "rk AS (select * from bx where is_scam = 0), "
        "pick AS (" + " union all ".join([
            _q("", "select con_exch_take from tg", "rk", "is_contract = 1 and is_exchange"),
            _q("", "select neg_contract - con_exch_take from tg", "rk", "is_contract = 1 and not is_exchange"),
            _q("", "select eoa_exch_take from tg", "rk", "coalesce(is_contract, 0) = 0 and is_exchange"),
            _q("", "select neg_eoa - eoa_exch_take from tg", "rk", "coalesce(is_contract, 0) = 0 and not is_exchange"),
        ]) + "), "
        "sel AS (select count(*) as n from bx b join pick p using (address) where b.is_exchange), "
        "cand AS (select * from bx r where is_scam = 0 and is_exchange and not exists "
        "(select 1 from pick p where p.address = r.address)), "
        f"extra AS ({_q('', f'select greatest({ensure} - n, 0) from sel', 'cand', 'true')}), "
        "xc AS (select count(*) filter (where is_contract = 1) as c, "
        "count(*) filter (where coalesce(is_contract, 0) = 0) as e from extra), "
        "dc AS (select p.* from pick p join (select address from bx where not is_exchange) b using (address)), "
        "drops AS (" + _q("", "select c from xc", "dc", "is_contract = 1") + " union all " +
        _q("", "select e from xc", "dc", "coalesce(is_contract, 0) = 0") + "), "
        "neg AS (select * from pick except select * from drops union select * from extra), "
        f"bal AS (select {_COLS} from bx where is_scam = 1 union all select * from neg), "
        f"disc AS (select {_COLS} from base b where not exists (select 1 from bal s where s.address = b.address)) "
    )


@register("acct_distinct_labels", sql=chain(ENSURE_LOW) + "select * from a0", fixtures=FX)
def q_distinct(spark, sf_dir):
    """Distinct (lower address, is_scam, description)."""
    return a.acct_distinct_labels(fx.accounts(spark, sf_dir))


@register("acct_activity_bounds", sql=chain(ENSURE_LOW) + "select * from txb", fixtures=FX)
def q_tx_bounds(spark, sf_dir):
    """First/last transfer time per account (sender or receiver)."""
    acc = a.acct_distinct_labels(fx.accounts(spark, sf_dir))
    return a.acct_activity_bounds(acc, fx.transactions(spark, sf_dir))


@register("acct_token_bounds", sql=chain(ENSURE_LOW) + "select * from tkb", fixtures=FX)
def q_tk_bounds(spark, sf_dir):
    """First/last token transfer time per account."""
    acc = a.acct_distinct_labels(fx.accounts(spark, sf_dir))
    return a.acct_token_bounds(acc, fx.token_transfers(spark, sf_dir))


@register("acct_merge_bounds", sql=chain(ENSURE_LOW) + "select * from act", fixtures=FX)
def q_merge(spark, sf_dir):
    """Accounts with merged activity bounds in unix seconds (inactive kept)."""
    acc = a.acct_distinct_labels(fx.accounts(spark, sf_dir))
    return a.acct_merge_bounds(acc, a.acct_activity_bounds(acc, fx.transactions(spark, sf_dir)),
                               a.acct_token_bounds(acc, fx.token_transfers(spark, sf_dir)))


@register("acct_is_contract", sql=chain(ENSURE_LOW) + "select * from base", fixtures=FX)
def q_is_contract(spark, sf_dir):
    """Account table with the contract flag."""
    return base_table(spark, sf_dir)


@register("acct_is_exchange", sql=chain(ENSURE_LOW) + "select * from bx", fixtures=FX)
def q_is_exchange(spark, sf_dir):
    """Exchange flag from the description."""
    return a.acct_is_exchange(base_table(spark, sf_dir))


_SHORT = a.EXCHANGE_PATTERN_SHORT.replace("'", "''")


@register("acct_exchange_set", sql=chain(ENSURE_LOW) +
          f"select distinct lower(address) as address from base where description is not null and "
          f"regexp_matches(lower(description), '{_SHORT}')", fixtures=FX)
def q_exchange_set(spark, sf_dir):
    """Distinct exchange addresses (short pattern)."""
    return a.acct_exchange_set(base_table(spark, sf_dir))


@register("acct_non_exchange_set", sql=chain(ENSURE_LOW) +
          f"select distinct lower(address) as address from base where lower(address) not in (select lower(address) "
          f"from base where description is not null and regexp_matches(lower(description), '{_SHORT}'))", fixtures=FX)
def q_non_exchange_set(spark, sf_dir):
    """All other distinct addresses."""
    return a.acct_non_exchange_set(base_table(spark, sf_dir))


@register("acct_balance_targets", sql=chain(ENSURE_LOW) + "select * from tg", fixtures=FX)
def q_targets(spark, sf_dir):
    """Class counts and per-type negative targets (one row)."""
    return a.targets_frame(spark, a.acct_balance_targets(base_table(spark, sf_dir)))


@register("acct_balance_pick", sql=chain(ENSURE_LOW) + "select * from pick", fixtures=FX)
def q_pick(spark, sf_dir):
    """Seeded negative picks per type, exchanges first."""
    b = base_table(spark, sf_dir)
    return a.acct_balance_pick(b, a.acct_balance_targets(b))


@register("acct_balance_topup", sql=chain(ENSURE_HIGH) + "select * from neg", fixtures=FX)
def q_topup(spark, sf_dir):
    """Negatives after the exchange top-up (threshold high enough to trigger it)."""
    b = base_table(spark, sf_dir)
    return a.acct_balance_topup(b, a.acct_balance_pick(b, a.acct_balance_targets(b)), ENSURE_HIGH)


@register("acct_balanced", sql=chain(ENSURE_LOW) + "select * from bal", fixtures=FX)
def q_balanced(spark, sf_dir):
    """Scams ∪ selected negatives."""
    return a.acct_balanced(base_table(spark, sf_dir), ensure_exch=ENSURE_LOW)


@register("acct_balanced_topup", sql=chain(ENSURE_HIGH) + "select * from bal", fixtures=FX)
def q_balanced_topup(spark, sf_dir):
    """Balanced table when the top-up branch fires."""
    return a.acct_balanced(base_table(spark, sf_dir), ensure_exch=ENSURE_HIGH)


@register("acct_discarded", sql=chain(ENSURE_LOW) + "select * from disc", fixtures=FX)
def q_discarded(spark, sf_dir):
    """Accounts not in the balanced table."""
    b = base_table(spark, sf_dir)
    return a.acct_discarded(b, a.acct_balanced(b, ensure_exch=ENSURE_LOW))


def _excl_sql():
    from hopweave.plans import q_shrink
    from hopweave.sources.fixture_sql import FIXTURE_SQL
    runs = q_shrink._runs_sql(False).replace("WITH base AS", "WITH obase AS").replace(" from base ", " from obase ")
    acct = chain(ENSURE_LOW)
    body = (acct.rstrip() + ", fx_order_calendar AS (" + FIXTURE_SQL["fx_order_calendar"] + "), " + runs[5:] +
            q_shrink._BASE_OUT + " from obase b where exists (select 1 from kept k where k.address = b.address "
            "and k.week = b.week) and not exists (select 1 from disc x where lower(x.address) = lower(b.address))")
    return body


@register("p_exclude_accounts", sql=_excl_sql(), fixtures=FX)
def q_exclude(spark, sf_dir):
    """Thinned daily rows without discarded accounts (case-insensitive)."""
    from hopweave.plans import q_shrink
    b = base_table(spark, sf_dir)
    disc = a.acct_discarded(b, a.acct_balanced(b, ensure_exch=ENSURE_LOW))
    # Accounts are excluded before their days are expanded: a few rows an account are shuffled instead of all its days.
    days = fx.every_day(p.p_exclude_accounts(fx.order_days(spark, sf_dir), disc), fx.calendar_partitions(spark, sf_dir))
    return p.p_keep_weeks(p.p_day_activity(days)).select(*q_shrink.BASE_COLS)
