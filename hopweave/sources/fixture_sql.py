"""The stand-in tables of ``sources.fixtures`` as plain SQL (DuckDB oracle side).

``with_fixtures(sql, names)`` prefixes a query with the CTEs it needs.
"""

from __future__ import annotations

_ADDR = "concat('0xA', lpad(cast({x} as varchar), 39, '0'))"
_KEY = "cast(regexp_extract(props, '[0-9]+', 0) as bigint)"


def _a(x: str) -> str:
    return _ADDR.format(x=x)


FIXTURE_SQL = {
    "fx_transactions": f"""
select concat('0x', md5(cast(event_id as varchar))) as hash,
 {_a('user_id')} as from_address,
 case when event_type = 'signup' then null else {_a(_KEY)} end as to_address,
 event_id as block_number, ts as block_timestamp,
 cast(round(value * 100) as decimal(18,0)) * cast(1000000000000 as decimal(13,0)) as value,
 20000000000 + (event_id % 50) * 100000000 as gas_price,
 21000 + (event_id % 1000) * 10 as receipt_gas_used,
 20000000000 + (event_id % 50) * 100000000 as receipt_effective_gas_price,
 case when event_id % 2 = 0 then null else 40000000000 end as max_fee_per_gas,
 case when event_id % 2 = 0 then null else 1500000000 end as max_priority_fee_per_gas,
 case when event_type = 'error' then 0 else 1 end as receipt_status,
 event_id as nonce,
 case when event_type = 'click' then '0x' when event_type = 'view' then null else concat('0x', md5(event_type)) end as input
from events""",
    "fx_token_transfers": f"""
select {_a('user_id')} as from_address, {_a(_KEY)} as to_address,
 {_a('1000000 + ' + _KEY + ' % 7')} as token_address, ts as block_timestamp
from events""",
    "fx_traces": f"""
select {_a('user_id')} as from_address, {_a(_KEY)} as to_address,
 cast(round(value * 100) as decimal(18,0)) * cast(1000000000000 as decimal(13,0)) as value,
 case when event_id % 10 = 0 then 0 else 1 end as status, 'call' as call_type, ts as block_timestamp
from events""",
    "fx_contracts": f"""
select {_a('c_custkey')} as address from customer where c_custkey % 3 = 0""",
    "fx_accounts": f"""
select {_a('c_custkey')} as address, case when c_acctbal < 0 then 1 else 0 end as is_scam,
 case when c_custkey % 5 = 0 then 'Binance hot wallet' when c_custkey % 7 = 0 then null else c_mktsegment end as description,
 case when c_custkey % 3 = 0 then 1 else 0 end as is_contract
from customer""",
    "fx_seeds": f"""
select lower({_a('c_custkey')}) as address,
 case when c_custkey % 3 <> 1 then cast(make_date(2024, 1, cast(3 + c_custkey % 5 as int)) as timestamp) end as activity_start_ts,
 case when c_custkey % 4 = 0 then null else cast(make_date(2024, 1, cast(20 + c_custkey % 5 as int)) as timestamp) end as activity_end_ts
from customer""",
    "fx_seed_accounts": """
select s.address, a.is_scam, a.description, a.is_contract, s.activity_start_ts, s.activity_end_ts
from fx_seeds s join (select lower(address) as address, is_scam, description, is_contract from fx_accounts) a
 on s.address = a.address""",
    "fx_window_edges": f"""
select {_a('o_custkey')} as from_address, {_a('1000000 + l_suppkey')} as to_address, l_shipdate as timestamp,
 cast(round(l_extendedprice * 100) as decimal(18,0)) as value_wei, cast(round(l_extendedprice * l_discount * 100) as decimal(18,0)) as tx_fee_wei,
 l_orderkey as block_number, l_linenumber = 1 as contract_creation,
 md5(concat_ws('-', cast(l_orderkey as varchar), cast(l_linenumber as varchar), cast(l_partkey as varchar), cast(l_suppkey as varchar), cast(cast(l_shipdate as date) as varchar), cast(cast(l_quantity as int) as varchar), cast(cast(round(l_extendedprice*100) as bigint) as varchar))) as tx_hash
from lineitem join orders on l_orderkey = o_orderkey""",
    "fx_label_src_a": f"""
select {_a('c_custkey')} as address, case when c_acctbal < 0 then 1 else 0 end as is_scam,
 case when c_custkey % 4 = 0 then 'null' else c_mktsegment end as description, 0 as src_order, c_custkey as row_no from customer""",
    "fx_label_src_b": f"""
select concat('  ', upper({_a('o_custkey')})) as address, case when o_orderstatus = 'F' then 1 else 0 end as is_scam,
 o_orderpriority as description, 1 as src_order, o_orderkey as row_no from orders""",
    "fx_order_calendar": f"""
select c.address, c.day,
 cast(coalesce(p.normal_total_cnt, 0) as bigint) as normal_total_cnt,
 cast(coalesce(p.erc20_total_cnt, 0) as bigint) as erc20_total_cnt,
 cast(0 as bigint) as internal_in_cnt, cast(0 as bigint) as internal_out_cnt,
 cast(coalesce(p.cents, 0) as double) / 1e5 as eth_recv_sum
from (
  select address, cast(unnest(generate_series(d0, d1, interval 1 day)) as date) as day
  from (select lower({_a('o_custkey')}) as address, min(cast(o_orderdate as date)) as d0, max(cast(o_orderdate as date)) as d1
        from orders group by 1)
) c
left join (
  select lower({_a('o_custkey')}) as address, cast(o_orderdate as date) as day,
   count(*) as normal_total_cnt, sum(case when o_orderstatus = 'O' then 1 else 0 end) as erc20_total_cnt,
   sum(cast(round(o_totalprice * 100) as bigint)) as cents
  from orders group by 1, 2
) p on c.address = p.address and c.day = p.day""",
    "fx_label_sheet": f"""
select c_custkey as row_no,
 case when c_mktsegment = 'BUILDING' then concat('  ', upper({_a('c_custkey')}), ' ')
      when c_mktsegment = 'AUTOMOBILE' then concat('0x', cast(c_custkey as varchar)) else {_a('c_custkey')} end as address,
 c_name as name, case when c_acctbal < 1000 then '' else n_name end as tag,
 case when c_acctbal < 0 then '1' else '0' end as flag, c_mktsegment as segment
from customer join nation on c_nationkey = n_nationkey
union all
select 1000000000 + o_orderkey, {_a('o_custkey')}, concat('Order#', cast(o_orderkey as varchar)), o_orderpriority,
 case when o_orderstatus = 'F' then '1' else '0' end, o_orderstatus
from orders""",
}

# Order in which CTEs may reference one another.
_DEPENDS = {"fx_seed_accounts": ["fx_seeds", "fx_accounts"]}


def with_fixtures(sql: str, names) -> str:
    ordered: list[str] = []

    def add(n):
        for d in _DEPENDS.get(n, []):
            add(d)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} AS ({FIXTURE_SQL[n]}\n)" for n in ordered)
    body = sql.strip()
    if body.lower().startswith("with "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
