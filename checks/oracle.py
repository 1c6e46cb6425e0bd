"""SQL twins of the registered queries, for DuckDB over the same test tables."""

from __future__ import annotations

import hashlib

AS_OF = "timestamp '2024-01-31 01:00:00'"
AS_OF_S = 1706662800
FLOW_AS_OF_S = 1705752000
FLOW_MINUTES = 1440
NO_DEBT = 18446744073709551615
TWO64 = 18446744073709551616

UPD = """
base as (
  select s + case when s >= 4262500001 then 73873 else 0 end as slot, write_version, pubkey, event_type, lamports, props, ts
  from (select (epoch_us(ts) // 1000) // 400 as s, event_id as write_version, user_id as pubkey, event_type,
               cast(floor(value * 100) as bigint) as lamports, props, ts from events)),
known as (
  select slot, write_version, pubkey,
         case when event_type = 'signup' and slot >= 4265000000 then 'untagged:0b' else event_type end as kind, lamports,
         case when event_type = 'signup' and slot >= 4265000000 then '' else props end as data, ts as ingested_at
  from base),
upd as (
  select *, length(data) as data_len, slot // 1000000 as cell from known
  union all
  select slot, write_version, pubkey, kind, lamports, data, ingested_at + interval 1 hour, length(data), slot // 1000000
  from known where write_version % 97 = 0),
updc as (
  select * from upd
  qualify row_number() over (partition by pubkey, slot, write_version order by ingested_at desc) = 1)"""

OBL = """
once as (
  select slot, write_version, pubkey, owner, lending_market, num_deposits, dep, debt,
         case when debt <> 0 then 1 else 0 end as num_borrows,
         case when debt = 0 then cast(18446744073709551615 as hugeint) else cast(dep * 1000000 // debt as hugeint) end as hf,
         ingested_at
  from (select (epoch_us(l_shipdate) // 1000) // 400 as slot, l_orderkey * 10 + l_linenumber as write_version, l_partkey as pubkey,
               l_suppkey as owner, l_returnflag as lending_market, cast(l_linenumber as bigint) as num_deposits,
               cast(floor(l_extendedprice * 100) as bigint) as dep,
               cast(floor(l_extendedprice * l_discount * 1000 * (1 + l_tax)) as bigint) as debt,
               l_shipdate as ingested_at from lineitem)),
obl as (
  select * from once
  union all
  select * replace (ingested_at + interval 1 hour as ingested_at) from once where write_version % 97 = 0),
oblc as (
  select * from obl
  qualify row_number() over (partition by pubkey, slot, write_version order by ingested_at desc) = 1),
debt as (select * from oblc where hf <> 18446744073709551615 and hf > 0)"""

RES = """
res_once as (
  select (epoch_us(l_shipdate) // 1000) // 400 as slot, l_orderkey * 10 + l_linenumber as write_version, l_suppkey as pubkey,
         l_linestatus as mint, cast(floor(l_extendedprice * 100) as bigint) as avail,
         cast(floor(l_quantity * 1000) as bigint) as borr, l_suppkey % 10 as dec, l_shipdate as ingested_at from lineitem),
res as (
  select * from res_once
  union all
  select * replace (ingested_at + interval 1 hour as ingested_at) from res_once where write_version % 97 = 0),
resc as (
  select * from res
  qualify row_number() over (partition by pubkey, slot, write_version order by ingested_at desc) = 1),
reslast as (
  select * from resc qualify row_number() over (partition by pubkey order by slot desc, write_version desc) = 1)"""

SESSIONS = """
days as (
  select slot // 216000 as day, min(slot) as first_slot, max(slot) as last_slot, max(write_version) as last_wv,
         min(ingested_at) as first_at, max(ingested_at) as last_at from known group by 1),
sess as (
  select d.day as session_id, b.last_slot as resume_from, d.first_slot as first_account_slot, d.first_at as detected_at
  from days d left join days b on b.day = d.day - 1)"""

GAPS = """
seams as (
  select resume_from as start_slot, first_account_slot as end_slot, detected_at from sess
  where first_account_slot - resume_from > 600),
recorded as (
  select 'main' as stream, start_slot, end_slot,
         detected_at + interval 1 hour as detected_at, case when end_slot - start_slot < 2000 then 1 else 0 end as filled,
         'seam, checked' as reason from seams
  union all
  select 'main', first_account_slot + 1, first_account_slot + 1001, detected_at, 0, 'noticed only'
  from sess where resume_from is not null)"""

DUMP = """
dumped as (
  select c_custkey // 50 as page,
         case when c_nationkey < 13 then 4261000000 else 4264000000 end + c_custkey // 50 * 3 as slot,
         cast(0 as bigint) as write_version, c_custkey as pubkey, cast(c_nationkey as bigint) as owner,
         cast(floor(c_acctbal * 100 + 100000) as bigint) as lamports, c_mktsegment as segment,
         case c_mktsegment when 'BUILDING' then 'Obligation' when 'MACHINERY' then 'Reserve'
              when 'AUTOMOBILE' then 'LendingMarket' else 'UserMetadata' end as kind
  from customer),
loaded as (select * from dumped where pubkey % 50 not in (7, 9))"""

STEPS = """
slots as (select distinct slot from upd),
stepped as (select lag(slot) over (order by slot) as prev, slot from slots)"""

WIRE = """
wire as (
  select *, case when q = 1 then 0 when q = 49 then 5 when q = 2 and line = 7 then 16 when q = 2 then 40
                 when line = 7 then 16 when flag = 'N' then 256 when flag = 'A' then 312 else 160 end as size,
         case when line = 7 then 'unknown:0102030405060708' when flag = 'N' then 'Obligation'
              when flag = 'A' then 'Reserve' else 'LendingMarket' end as label,
         case when line = 6 and q = 50 then 9223372036854775807 else q end as high,
         case when line = 3 then 0 else dep end as lamports
  from (select (epoch_us(l_shipdate) // 1000) // 400 as slot, l_orderkey * 10 + l_linenumber as write_version, l_partkey as part,
               l_suppkey as supp, l_returnflag as flag, cast(l_linenumber as bigint) as line, cast(l_quantity as bigint) as q,
               cast(floor(l_extendedprice * 100) as bigint) as dep,
               cast(floor(l_extendedprice * l_discount * 1000 * (1 + l_tax)) as bigint) as debt from lineitem)),
records as (
  select *, case when size = 0 then 'untagged:0b' when size = 5 then 'untagged:5b' else label end as kind from wire),
oblrec as (
  select *, cast(high as hugeint) * case when high > 100 then 0 else 18446744073709551616 end + dep as deposited,
         cast(q // 10 as hugeint) * 18446744073709551616 + debt as adjusted, high > 100 as too_big
  from records where kind = 'Obligation' and size = 256),
oblval as (
  select *, case when adjusted = 0 or debt = 0 then cast(18446744073709551615 as hugeint)
                 else deposited * 1000000 // adjusted end as hf from oblrec)"""

UPD_S = f"with {UPD}"
OBL_S = f"with {OBL}"


def _select(*parts: str) -> str:
    """CTEs and a final select; a last part that starts with further CTEs continues the list."""
    *ctes, body = parts
    link = "" if body.lstrip().startswith("select") else ","
    return f"with {','.join(ctes)}{link}\n{body}"


_PCTS = {"p10_health": 0.1, "p25_health": 0.25, "median_health": 0.5, "p75_health": 0.75, "p90_health": 0.9, "p99_health": 0.99}
_KINDS = ("click", "view", "purchase", "signup", "error")
_COUNTS = ", ".join(f"cast(count(*) filter (where kind = '{k}') as bigint) as writes_{k}" for k in _KINDS)
_FLOW = f"""
flow as (
  select cast(epoch(date_trunc('minute', ingested_at)) as bigint) as minute, count(*) as writes, {_COUNTS},
         cast(sum(data_len) as bigint) as bytes
  from upd where ingested_at >= timestamp '2024-01-20 12:00:00' - interval {FLOW_MINUTES} minute
             and ingested_at < timestamp '2024-01-20 12:00:00' group by 1)"""
_AXIS = f"""
axis as (select {FLOW_AS_OF_S} - ({FLOW_MINUTES} - 1) * 60 + i * 60 as minute from range({FLOW_MINUTES}) t(i)),
filled as (
  select a.minute, coalesce(f.writes, 0) as writes, {", ".join(f"coalesce(f.writes_{k}, 0) as writes_{k}" for k in _KINDS)},
         coalesce(f.bytes, 0) as bytes, a.minute >= {FLOW_AS_OF_S} as "partial"
  from axis a left join flow f on a.minute = f.minute)"""
_AGE = f"{AS_OF_S} - cast(floor(epoch(max(ingested_at))) as bigint)"
_HISTORY = "slot, write_version, cast(hf as varchar) as health_factor_bps, num_deposits, cast(num_borrows as bigint) as num_borrows"
_ACTIVITY = """
select lpad(cast(cell * 1000000 as varchar), 12, '0') as slot_bucket, count(*) as updates, count(distinct pubkey) as accounts,
       cast(sum(data_len) as bigint) as payload_bytes, min(slot) as first_slot, max(slot) as last_slot,
       max(slot) - min(slot) as slot_span from {table} group by cell"""
_BUCKET = "lpad(cast(cell * 1000000 as varchar), 12, '0') as slot_bucket"
_TABLES = """
everything as (
  select 'account_updates' as table_name, pubkey, slot, write_version from upd
  union all select 'account_updates', pubkey, slot, write_version from dumped
  union all select 'obligation_snapshots', pubkey, slot, write_version from obl
  union all select 'reserve_snapshots', pubkey, slot, write_version from res)"""
_RESTORED = """
restored as (
  select c_custkey * 2 as pubkey, 4266000000 + c_custkey as slot from customer),
lost as (select * from upd where data_len = 0 and lamports > 0)"""
_STORED_OBL = """
stored as (
  select 'account_updates' as table_name, slot from records
  union all select 'obligation_snapshots', slot from oblval where not too_big
  union all select 'reserve_snapshots', slot from records where kind = 'Reserve' and size = 312
  union all select 'lending_market_snapshots', slot from records where kind = 'LendingMarket' and size = 160)"""
_REPORT = """
select kind{extra}, count(*) as records, count(*) filter (where outcome in ('ok', 'health_overflow')) as decoded,
       count(*) filter (where outcome = 'short') as short, count(*) filter (where outcome = 'overflow') as overflow,
       count(*) filter (where outcome = 'health_overflow') as health_overflow,
       round(count(*) filter (where outcome in ('ok', 'health_overflow')) / count(*), 4) as decoded_share
from (
  select kind, slot // 1000000 as cell, 'short' as outcome from records
  where kind in ('Obligation', 'Reserve', 'LendingMarket') and size = 40
  union all
  select kind, slot // 1000000, 'ok' from records where kind in ('Reserve', 'LendingMarket') and size > 40
  union all
  select kind, slot // 1000000,
         case when too_big then 'overflow' when hf >= 100000000000000000000 then 'health_overflow' else 'ok' end from oblval)
group by kind{group}"""


def _tag(kind: str) -> str:
    return hashlib.sha256(f"account:{kind}".encode()).hexdigest()[:16]


_FLAG_BITS = {"emergency": 1, "autodeleverage": 2, "borrow_disabled": 4, "immutable": 8}
_YES = ", ".join(f"case when flags & {b} <> 0 then 'YES' else 'NO' end as {n}" for n, b in _FLAG_BITS.items())
_MARKET_FLAGS = "(line % 2) + 2 * (line // 2 % 2) + 4 * (q % 2) + 8 * (q // 2 % 2)"
_TEXT = """
case when l_linenumber = 1 then cast(l_orderkey as varchar) when l_linenumber = 2 then '-' || l_orderkey
     when l_linenumber = 3 then l_orderkey || '.5' when l_linenumber = 4 then ''
     when l_linenumber = 5 then repeat('9', 38) when l_linenumber = 6 then '1' || repeat('0', 38)
     else rpad(cast(l_orderkey as varchar), 30, '7') end"""

SQL: dict[str, str] = {
    # --- collapsing and latest state
    "collapse_updates": f"{UPD_S} select slot, write_version, pubkey, kind, lamports, data, data_len, (epoch_us(ingested_at) // 1000) as ingested_ms from updc",
    "collapse_snapshots": f"{OBL_S} select slot, write_version, pubkey, cast(hf as varchar) as hf, (epoch_us(ingested_at) // 1000) as ingested_ms from oblc",
    "collapse_checkpoints": _select(UPD, SESSIONS, """
        select s.stream, last_slot - s.back as last_slot, last_wv as last_write_version, (epoch_us(last_at) // 1000) as updated_ms
        from days, (values ('main', 0), ('staging', 5)) s(stream, back)
        qualify row_number() over (partition by s.stream order by last_at desc) = 1"""),
    "collapse_reserves": _select(RES, """select slot, write_version, pubkey, avail as available_amount, borr as borrowed_amount_sf,
        (epoch_us(ingested_at) // 1000) as ingested_ms from resc"""),
    "collapse_markets": _select(WIRE, f"""select slot, write_version, part as pubkey, cast({_MARKET_FLAGS} as int) as flags
        from records where kind = 'LendingMarket' and size = 160"""),
    "collapse_gaps": _select(UPD, SESSIONS, GAPS, """select stream, start_slot, end_slot, filled, reason from recorded
        union all select 'main', first_account_slot + 7, 0, 0, 'no end' from sess where resume_from is not null"""),
    "collapse_runs": _select(DUMP, """select max(slot) as slot, 'known' as scope, count(*) as accounts, 5::bigint as duration_ms
        from dumped group by slot >= 4264000000"""),
    "distinct_accounts": _select(UPD, OBL, RES, DUMP, _TABLES, "select table_name, count(distinct pubkey) as accounts from everything group by 1"),
    "intra_slot_versions": _select(RES, "select pubkey, slot, count(*) as versions from resc group by 1, 2 having count(*) > 1"),
    "latest_state": f"""{OBL_S} select pubkey, slot, write_version, cast(hf as varchar) as hf, owner, cast(num_borrows as bigint) as flags from oblc
        qualify row_number() over (partition by pubkey order by slot desc, write_version desc) = 1""",
    "replay_share": f"""{UPD_S} select (select count(*) from upd) as raw_rows, (select count(*) from updc) as collapsed_rows,
        (select count(*) from upd) - (select count(*) from updc) as replayed_rows""",
    # --- health
    "health_distribution": f"""{OBL_S} select count(*) as valid_snapshots, round(min(hf) / 1000000, 4) as min_health,
        {", ".join(f"round(quantile_cont(cast(hf as bigint), {p}) / 1000000, 4) as {n}" for n, p in _PCTS.items())},
        round(max(hf) / 1000000, 4) as max_health, count(*) filter (where hf < 1050000) as at_risk_below_1p05,
        round(count(*) filter (where hf < 1050000) / count(*), 4) as at_risk_share from debt""",
    "health_histogram": f"""{OBL_S} select case when hf < 1000000 then '1: <1.0 liquidatable' when hf < 1050000 then '2: 1.0-1.05 at-risk'
        when hf < 1250000 then '3: 1.05-1.25' when hf < 1500000 then '4: 1.25-1.5' when hf < 2000000 then '5: 1.5-2.0'
        when hf < 3000000 then '6: 2.0-3.0' when hf < 5000000 then '7: 3.0-5.0' when hf < 10000000 then '8: 5.0-10.0'
        else '9: >=10.0' end as bucket, count(*) as n from debt group by 1""",
    "overview": _select(OBL, RES, """
        select (select count(distinct pubkey) from resc) as reserves,
               (select count(distinct pubkey) from oblc where hf <> 18446744073709551615) as active,
               (select quantile_cont(cast(hf as bigint), 0.5) / 1000000 from debt) as med_health,
               (select count(*) from oblc where hf < 1050000 and hf > 0) as at_risk,
               (select quantile_cont(cast(hf as bigint), 0.25) / 1000000 from debt where hf < 10000000) as p25"""),
    "risk_radar": f"""{OBL_S} select pubkey as pk, owner as ow, cast(hf as bigint) as hf, num_deposits as dep, cast(num_borrows as bigint) as bor
        from (select * from debt qualify row_number() over (partition by pubkey order by slot desc, write_version desc) = 1)
        where hf < 2000000 order by hf, pubkey limit 15""",
    "risk_radar_current": f"""{OBL_S} select pubkey as pk, owner as ow, cast(hf as bigint) as hf, num_deposits as dep, cast(num_borrows as bigint) as bor
        from (select * from oblc qualify row_number() over (partition by pubkey order by slot desc, write_version desc) = 1)
        where hf < 2000000 and hf > 0 order by hf, pubkey limit 15""",
    "discover_keys": f"{OBL_S} select pubkey, count(*) as n from oblc group by 1 order by n desc, pubkey limit 10",
    "account_history": f"""{OBL_S} select {_HISTORY} from oblc
        where pubkey = (select pubkey from oblc group by 1 order by count(*) desc, pubkey limit 1)""",
    "history_page": f"""{OBL_S} select pubkey, {_HISTORY} from oblc where (slot, write_version, pubkey) > (2000000000, 5000, 0)
        order by slot, write_version, pubkey limit 1000""",
    "health_factor": f"{OBL_S} select pubkey, slot, write_version, cast(hf as varchar) as hf from once",
    "health_audit": f"""{OBL_S} select pubkey, slot, write_version, cast(hf - 1 as varchar) as stored, cast(hf as varchar) as recomputed
        from once where write_version % 97 = 0""",
    "value_invariants": f"""{OBL_S} select count(*) as checked, count(*) filter (where debt >= dep * 9 // 10) as allowed_not_below_unhealthy,
        count(*) filter (where dep * 9 // 10 >= dep) as unhealthy_not_below_deposited,
        count(*) filter (where debt >= dep * 9 // 10 or dep * 9 // 10 >= dep) as violations from once where dep > 0""",
    "position_values": _select(WIRE, """
        select part as pubkey, slot, write_version, round(cast(cast(deposited as varchar) as double) / pow(2.0, 60), 6) as deposited,
               round(cast(debt as double) / pow(2.0, 60), 6) as borrowed, round(mb, 6) as max_borrow,
               round(mb - cast(debt as double) / pow(2.0, 60), 6) as headroom,
               round((cast(debt as double) / pow(2.0, 60)) / (cast(cast(deposited as varchar) as double) / pow(2.0, 60)), 9) as ltv,
               cast(8500 + line as double) / 100 as liquidation_ltv_pct,
               case when hf = 18446744073709551615 or hf = 0 or hf >= 100000000000000000000 then -1.0::double
                    else cast(cast(hf as varchar) as double) / 1000000 end as health
        from (select *, cast(cast(cast(q as hugeint) * 18446744073709551616 + dep * 8 // 10 as varchar) as double) / pow(2.0, 60) as mb from oblval)
        where not too_big and deposited > 0"""),
    # --- activity
    "activity_by_bucket": UPD_S + _ACTIVITY.format(table="upd"),
    "hot_accounts": f"""{UPD_S} select pubkey, max(kind) as kind, count(*) as updates, count(distinct slot) as slots_touched, max(slot) as last_seen
        from upd group by pubkey order by updates desc, pubkey limit 20""",
    "kind_mix": f"""{UPD_S} select kind, count(*) as updates, count(distinct pubkey) as accounts, min(slot) as first_slot, max(slot) as last_slot,
        round(count(*) * 100.0 / (select count(*) from upd), 2) as share_pct from upd group by kind""",
    "kind_length_mix": f"""{UPD_S} select kind, data_len, count(*) as updates, round(count(*) * 100.0 / (select count(*) from upd), 2) as share_pct
        from upd group by 1, 2""",
    "slot_density": f"""{UPD_S} select min(slot) as first_slot, max(slot) as last_slot, count(distinct slot) as slots_with_updates,
        max(slot) - min(slot) as slot_span, round(count(distinct slot) * 100.0 / (max(slot) - min(slot)), 4) as density_pct from upd""",
    "throughput": f"""{UPD_S}, t as (select count(*) as n, cast(sum(data_len) as bigint) as b,
          cast(floor(epoch(max(ingested_at))) as bigint) - cast(floor(epoch(min(ingested_at))) as bigint) as s from upd)
        select n as updates, b as payload_bytes, s as seconds, round(n / s, 4) as rows_per_second, round(b / 1024.0 / s, 4) as kb_per_second from t""",
    "throughput_recent": f"""{UPD_S}, t as (select count(*) as n, cast(sum(data_len) as bigint) as b,
          cast(floor(epoch(max(ingested_at))) as bigint) - cast(floor(epoch(min(ingested_at))) as bigint) as s from upd
          where ingested_at > timestamp '2024-01-20 12:00:00' - interval 1440 minute and ingested_at <= timestamp '2024-01-20 12:00:00')
        select n as updates, b as payload_bytes, s as seconds, round(n / s, 4) as rows_per_second, round(b / 1024.0 / s, 4) as kb_per_second from t""",
    "flow": _select(UPD, _FLOW, "select * from flow"),
    "flow_filled": _select(UPD, _FLOW, _AXIS, "select * from filled"),
    "flow_mean": _select(UPD, _FLOW, _AXIS, 'select count(*) as minutes, round(avg(writes), 4) as mean_writes from filled where not "partial"'),
    "liquidity_depth": _select(RES, """
        select pubkey as pk, avail, borr, dec, mint as liq_mint, avail / pow(10.0, dec) as available
        from reslast order by avail desc, pubkey limit 15"""),
    "liquidity_low": _select(RES, """
        select pubkey as pk, avail, borr, dec, mint as liq_mint, avail / pow(10.0, dec) as available
        from reslast where avail < 2000000 order by avail, pubkey limit 15"""),
    "liquidity_symbols": _select(RES, """
        select pubkey as pk, avail, borr, dec, mint as liq_mint, avail / pow(10.0, dec) as available, coalesce(symbol, mint) as symbol
        from reslast left join (select substr(r_name, 1, 3) as symbol, case when r_regionkey = 0 then 'O' else 'X' || r_regionkey end as m from region) on m = mint"""),
    "session_summary": f"""{UPD_S}, t as (select min(slot) as lo, max(slot) as hi, count(distinct slot) as active, count(*) as n,
          cast(sum(data_len) as bigint) as b from upd)
        select lo as first_slot, hi as last_slot, hi - lo as slot_span, round((hi - lo) * 0.4::double, 1) as chain_seconds,
               active as slots_with_updates, round(active * 100.0 / (hi - lo), 1) as density_pct, n as updates, b as payload_bytes,
               round(b / 1024.0 / ((hi - lo) * 0.4::double), 4) as kb_per_second from t""",
    # --- whole-dataset figures and provenance
    "dataset_summary": _select(UPD, OBL, SESSIONS, GAPS, f"""
        select (select count(*) from upd) as rows_raw, (select count(*) from updc) as rows_collapsed,
               (select count(distinct pubkey) from oblc) as ever_seen, (select count(distinct pubkey) from debt) as active,
               (select count(*) from oblc) as snapshots, (select count(*) from debt) as valid_snapshots,
               (select round(quantile_cont(cast(hf as bigint), 0.5) / 1000000, 4) from debt) as median_health,
               (select count(*) from debt where hf < 1050000) as at_risk,
               min(slot) as first_slot, (epoch_us(min(ingested_at)) // 1000) as first_ms, max(slot) as latest_slot, (epoch_us(max(ingested_at)) // 1000) as latest_ms,
               {_AGE} as lag_s, count(distinct slot) as density_slots, max(slot) - min(slot) as density_span,
               round(count(distinct slot) * 100.0 / (max(slot) - min(slot)), 4) as density_pct,
               (select count(*) from recorded where filled = 0) as unfilled_gaps from upd"""),
    "ingest_stats": _select(UPD, OBL, SESSIONS, GAPS, f"""
        select count(*) as total_rows, count(distinct pubkey) as distinct_pubkeys, max(slot) as latest_slot,
               (select last_slot from days order by last_at desc limit 1) as checkpoint, {_AGE} as ingest_age_s,
               (select count(*) from recorded where filled = 0) as unfilled_gaps, (select count(*) from oblc) as snap_rows from upd"""),
    "system_status": _select(UPD, OBL, RES, SESSIONS, GAPS, f"""
        select max(slot) as latest_slot, (select last_slot from days order by last_at desc limit 1) as checkpoint, {_AGE} as ingest_age_s,
               (select count(*) from recorded where filled = 0) as unfilled_gaps, count(*) as total_rows,
               (select count(*) from oblc) as snap_rows, (select max(slot) from resc) as reserve_max from upd"""),
    "provenance_counts": _select(UPD, OBL, RES, DUMP, _TABLES, """
        select table_name, count(*) filter (where write_version = 0) as snapshot_rows, count(*) filter (where write_version <> 0) as stream_rows,
               count(distinct pubkey) as accounts from everything group by 1"""),
    "table_status": _select(UPD, OBL, RES, DUMP, _TABLES, "select table_name, count(*) as n, max(slot) as max_slot from everything group by 1"),
    "provenance_runs": _select(UPD, DUMP, """
        runs as (select max(slot) as run_slot from dumped group by slot >= 4264000000),
        rows0 as (select pubkey, slot from upd where write_version = 0 union all select pubkey, slot from dumped)
        select pubkey, slot, (select min(run_slot) from runs where run_slot >= slot) as run_slot, 'known' as scope
        from rows0 where slot <= (select max(run_slot) from runs)"""),
    "freeze_manifest": _select(UPD, OBL, """
        select max(slot) as last_slot, count(*) as account_updates_rows, (epoch_us(max(ingested_at)) // 1000) as last_ingested_ms,
               (select count(distinct pubkey) from oblc) as obligations_distinct, (select count(*) from oblc) as obligation_snapshots_rows from upd"""),
    # --- gaps
    "gaps": _select(UPD, STEPS, "select prev as start_slot, slot as end_slot, slot - prev - 1 as slots_missed from stepped where slot - prev - 1 > 600"),
    "gaps_live_rule": _select(UPD, STEPS, "select prev as start_slot, slot as end_slot, slot - prev - 1 as slots_missed from stepped where slot - prev > 600"),
    "top_steps": _select(UPD, STEPS, """
        select prev as prev_slot, slot as next_slot, slot - prev as delta from stepped where slot - prev > 100 order by delta desc, prev limit 10"""),
    "slot_steps": _select(UPD, STEPS, "select prev as prev_slot, slot from stepped where prev is not null"),
    "arrival_silences": f"""{UPD_S}, secs as (select distinct cast(floor(epoch(ingested_at)) as bigint) as s from upd),
        d as (select s - lag(s) over (order by s) as silence from secs)
        select count(*) as ingest_seconds, round(quantile_cont(silence, 0.5), 4) as p50_s, round(quantile_cont(silence, 0.99), 4) as p99_s,
               round(quantile_cont(silence, 0.999), 4) as p999_s, max(silence) as max_s from d""",
    "resume_verdicts": _select(UPD, SESSIONS, """
        select session_id, coalesce(resume_from, -1) as resume_from, first_account_slot,
               case when resume_from is null then 'not_applicable' when first_account_slot - resume_from > 600 then 'gap' else 'clean' end as verdict,
               case when resume_from is null then -1 else greatest(first_account_slot - resume_from, 0) end as drift,
               case when first_account_slot - resume_from > 600 then first_account_slot - resume_from - 1 else -1 end as slots_missed
        from sess"""),
    "recorded_gaps": _select(UPD, SESSIONS, GAPS, """
        select 'main' as stream, start_slot, end_slot, (epoch_us(detected_at) // 1000) as detected_ms, 0 as filled,
               'silent start-up seam: stream opened ' || (end_slot - start_slot) || ' slots late' as reason from seams"""),
    "current_gaps": _select(UPD, SESSIONS, GAPS, "select stream, start_slot, end_slot, filled, reason from recorded"),
    "failure_gaps": _select(UPD, SESSIONS, """
        select 'main' as stream, resume_from as start_slot, first_account_slot as end_slot, (epoch_us(detected_at) // 1000) as detected_ms, 0 as filled,
               case when session_id % 2 = 0 then 'position too old: the source no longer replays it' else 'stream broke before its first record' end as reason
        from sess where resume_from is not null and session_id % 5 <> 0 and first_account_slot > resume_from"""),
    "gap_status": _select(UPD, SESSIONS, GAPS, """
        select cast(sum(end_slot - start_slot - 1) as bigint) as total_missed_slots, count(*) as gap_count,
               (epoch_us(max(detected_at)) // 1000) as latest_gap_ms from recorded where filled = 0"""),
    "reconcile_gaps": _select(UPD, SESSIONS, GAPS, STEPS, """
        shown as (select prev as start_slot, slot as end_slot from stepped where slot - prev - 1 > 600),
        noticed as (select distinct start_slot, end_slot from recorded where end_slot - start_slot - 1 > 600)
        select coalesce(a.start_slot, b.start_slot) as start_slot, coalesce(a.end_slot, b.end_slot) as end_slot,
               case when b.start_slot is null then 'only_derived' when a.start_slot is null then 'only_recorded' else 'matched' end as status
        from shown a full join noticed b on a.start_slot = b.start_slot and a.end_slot = b.end_slot"""),
    "coverage": f"""{UPD_S}, s as (select distinct kind, slot from upd),
        p as (select kind, slot, lag(slot) over (partition by kind order by slot) as prev from s),
        g as (select kind, slot, sum(case when prev is null or slot - prev - 1 > 600 then 1 else 0 end) over (partition by kind order by slot) as island from p)
        select kind, min(slot) as from_slot, max(slot) as to_slot, max(slot) - min(slot) + 1 as slot_span from g group by kind, island""",
    "gaps_companion": _select(UPD, STEPS, """
        select 'outage' as hole, 'all' as kind, prev as start_slot, slot as end_slot, slot - prev - 1 as size from stepped where slot - prev - 1 > 600
        union all
        select 'payload', kind, min(slot), max(slot), cast(sum(bad) as bigint) from (
          select *, count(*) filter (where bad = 0 and good > 0) over (partition by kind order by slot) as run from (
            select kind, slot, count(*) filter (where data_len = 0 and lamports > 0) as bad, count(*) filter (where data_len > 0) as good
            from upd group by kind, slot)) where bad > 0 group by kind, run"""),
    # --- payload shape and freshness
    "payload_shapes": f"""{UPD_S} select case when data_len > 0 then 'ok' when lamports = 0 then 'closed' else 'impossible_empty' end as shape,
        count(*) as n from upd group by 1""",
    "payload_guard": f"""{UPD_S} select count(*) filter (where data_len = 0 and lamports > 0) as impossible,
        count(*) filter (where data_len = 0 and lamports = 0) as closed,
        coalesce(min(slot) filter (where data_len = 0 and lamports > 0), -1) as first_slot,
        coalesce(max(slot) filter (where data_len = 0 and lamports > 0), -1) as last_slot,
        count(*) filter (where data_len = 0 and lamports > 0) > 0 as firing from upd""",
    "payload_alarms": f"""{UPD_S}, r as (select *, row_number() over (order by slot, write_version, pubkey, ingested_at) as n
          from upd where data_len = 0 and lamports > 0)
        select n, slot, write_version, pubkey, case when n = 1 then 'first' else 'repeat' end as alarm from r where n = 1 or n % 10 = 0""",
    "loss_report": _select(UPD, _RESTORED, """
        select count(*) as lost_rows, count(distinct kind) as lost_kinds, count(distinct pubkey) as lost_keys,
               (select count(distinct pubkey) from lost where pubkey in (select pubkey from restored)) as confirmed_keys,
               min(slot) as first_slot, max(slot) as last_slot, (epoch_us(min(ingested_at)) // 1000) as first_ms, (epoch_us(max(ingested_at)) // 1000) as last_ms,
               (epoch_us(max(ingested_at)) // 1000) // 1000 - (epoch_us(min(ingested_at)) // 1000) // 1000 as window_seconds,
               round(((epoch_us(max(ingested_at)) // 1000) // 1000 - (epoch_us(min(ingested_at)) // 1000) // 1000) / 3600.0, 2) as window_hours,
               coalesce((select min(slot) from restored where slot > (select max(slot) from lost)), -1) as first_restored_slot from lost"""),
    "lost_keys_known": _select(UPD, _RESTORED, "select distinct pubkey from lost where pubkey in (select pubkey from restored)"),
    "lost_keys_unknown": _select(UPD, _RESTORED, "select distinct pubkey from lost where pubkey not in (select pubkey from restored)"),
    "kind_freeze_audit": f"""{UPD_S}, k as (select kind, count(*) as updates, count(distinct pubkey) as keys, min(slot) as lo, max(slot) as hi from upd group by kind),
        f as (select *, (select max(hi) from k) - hi as lag_slots, (select max(hi) from k) - hi > 500000 as frozen from k),
        s as (select f.*, case when frozen then (select b.kind from k b where b.lo > f.hi order by b.lo, b.kind limit 1) end as successor from f)
        select kind, updates, lo as first_slot, hi as last_slot, lag_slots, frozen, coalesce(successor, '') as successor,
               case when successor is null then 0 else (select count(distinct a.pubkey) from upd a where a.kind = s.kind
                 and a.pubkey in (select b.pubkey from upd b where b.kind = s.successor)) end as shared_keys,
               round(coalesce(case when successor is null then 0.0 else (select count(distinct a.pubkey) from upd a where a.kind = s.kind
                 and a.pubkey in (select b.pubkey from upd b where b.kind = s.successor)) / (select keys from k where k.kind = s.successor) end, 0.0), 4) as shared_share
        from s""",
    "freshness": f"""{UPD_S} select {_AGE} as age_s, case when {_AGE} < 120 then 'fresh' when {_AGE} < 900 then 'slow' else 'stale' end as state from upd""",
    "health_check": f"""{UPD_S}, r as (select cast(floor(epoch(ingested_at)) as bigint) as s from upd where floor(epoch(ingested_at)) > {AS_OF_S} - 1440 * 60)
        select count(*) as updates, count(distinct pubkey) as accounts, max(slot) as last_slot, {_AGE} as lag_s,
               (select round(coalesce(count(*) / nullif(max(s) - min(s), 0), 0.0), 2) from r) as rate_per_s,
               case when {_AGE} <= 300 then 'HEALTHY' else 'STALE' end as status from upd""",
    # --- cold copy
    "export_cold": f"""{UPD_S} select {_BUCKET}, slot, write_version, pubkey, kind, lamports, data, data_len, (epoch_us(ingested_at) // 1000) as ingested_ms from updc""",
    "export_cold_snapshots": f"""{OBL_S} select lpad(cast(slot // 1000000 * 1000000 as varchar), 12, '0') as slot_bucket, slot, write_version, pubkey,
        cast(hf as varchar) as hf, dep as deposited_value, (epoch_us(ingested_at) // 1000) as ingested_ms from oblc""",
    "export_incremental": f"{UPD_S} select {_BUCKET}, count(*) as exported_rows, cell >= 4263 as rewritten from updc group by cell",
    "reconcile_export": f"{UPD_S} select {_BUCKET}, count(*) as expected_rows, count(*) as exported_rows, 'ok' as status from updc group by cell",
    "cold_activity": UPD_S + _ACTIVITY.format(table="updc"),
    "cold_sql": f"""{UPD_S}, per as (select cell, kind, count(*) as n from updc group by 1, 2)
        select {_BUCKET}, max(n) as most, count(*) as kinds from per group by cell""",
    "slot_range": f"{UPD_S} select slot, write_version, pubkey, lamports from updc where slot >= 4261900000 and slot < 4262100000",
    "slot_buckets": f"{UPD_S} select {_BUCKET}, slot // 10000000 as hot_bucket, count(*) as updates from upd group by cell, 2",
    "late_columns": f"""{OBL_S} select slot >= 2200000000 as late, count(*) as n, count(*) filter (where slot >= 2200000000 and dep > 0) as with_value,
        cast(sum(case when slot >= 2200000000 then dep else 0 end) as bigint) as total, cast(0 as bigint) as borrowed from once group by 1""",
    # --- decoding
    "kinds_of_payloads": _select(WIRE, "select kind, count(*) as n from records group by 1"),
    "decode_obligations": _select(WIRE, """
        select slot, write_version, part as pubkey, part as owner, supp as lending_market, q as referrer,
               cast((line <> 0)::int + (line > 3)::int as int) as num_deposits, cast(case when debt <> 0 then 1 else 0 end as int) as num_borrows,
               cast((case when debt <> 0 then 1 else 0 end) + (case when line % 3 <> 0 then 2 else 0 end) + (case when line = 5 and dep <> 0 then 4 else 0 end) as int) as flags,
               cast(line % 3 as int) as elevation_group,
               case when too_big then 'overflow' else cast(deposited as varchar) end as deposited_value_sf, cast(debt as varchar) as borrowed_value_sf,
               cast(adjusted as varchar) as borrow_factor_adjusted_debt_sf,
               cast(cast(q as hugeint) * 18446744073709551616 + dep * 8 // 10 as varchar) as allowed_borrow_value_sf,
               cast(cast(q as hugeint) * 18446744073709551616 + dep * 9 // 10 as varchar) as unhealthy_borrow_value_sf,
               cast(8500 + line as varchar) as lowest_deposit_liquidation_ltv,
               case when adjusted = 0 or debt = 0 then '18446744073709551615' when too_big or hf >= 100000000000000000000 then 'overflow' else cast(hf as varchar) end as health_factor_bps,
               case when too_big then 'overflow' when hf >= 100000000000000000000 then 'health_overflow' else 'ok' end as decode_status
        from oblval"""),
    "decode_reserves": _select(WIRE, """
        select slot, write_version, part as pubkey, part as lending_market, supp as liquidity_mint, line as supply_vault, q as fee_vault,
               cast(dep as varchar) as available_amount, cast(cast(q as hugeint) * 18446744073709551616 + debt as varchar) as borrowed_amount_sf,
               cast(dep as varchar) as market_price_sf, cast(line as varchar) as acc_protocol_fees_sf, cast(q as varchar) as acc_referrer_fees_sf,
               supp % 10 as mint_decimals from records where kind = 'Reserve' and size = 312"""),
    "decode_markets": _select(WIRE, f"""
        select slot, write_version, part as pubkey, supp as owner, part as quote_currency, cast({_MARKET_FLAGS} as int) as flags,
               cast(q * 10 as int) as referral_fee_bps, cast(q as int) as close_factor, 'market-' || supp as name
        from records where kind = 'LendingMarket' and size = 160"""),
    "market_settings": _select(WIRE, f"""
        m as (select *, {_MARKET_FLAGS} as flags from records where kind = 'LendingMarket' and size = 160
              qualify row_number() over (partition by part order by slot desc, write_version desc) = 1)
        select part as pubkey, {_YES.replace("as emergency", "as emergency_mode")}, q * 10 / 100.0 as referral_fee_pct, 'market-' || supp as name_str from m"""),
    "redecode_counts": _select(WIRE, _STORED_OBL, "select table_name, count(*) as n, max(slot) as max_slot from stored where table_name <> 'account_updates' group by 1"),
    "redecode_stored": "select kind, records, decoded, short, overflow from (" + _select(WIRE, _REPORT.format(extra="", group="")) + ")",
    "decode_report": _select(WIRE, _REPORT.format(extra="", group="")),
    "decode_report_by_bucket": _select(WIRE, _REPORT.format(extra=f", {_BUCKET}", group=", cell")),
    "obligation_flags": """
        select cast((case when l_discount <> 0 then 1 else 0 end) + (case when l_linenumber % 3 <> 0 then 2 else 0 end)
               + (case when l_tax <> 0 then 4 else 0 end) as int) as flags, count(*) as n from lineitem group by 1""",
    "market_flags": f"""
        with f as (select l_suppkey % 16 as flags from lineitem)
        select cast(flags as int) as flags, {_YES}, count(*) as n from f group by all""",
    "parse_fractions": f"""
        with t as (select (epoch_us(l_shipdate) // 1000) // 400 as slot, l_orderkey, cast(l_linenumber as bigint) as line, {_TEXT} as v from lineitem)
        select l_orderkey, line, case when line in (1, 5, 7) then v else 'rejected' end as parsed,
               case when line in (1, 5, 7) then '' when line = 6 then 'deposit at slot ' || slot || ' exceeds 10^38 - 1: ' || v
                    else 'deposit at slot ' || slot || ' is not an unsigned integer: ' || v end as error from t""",
    "key_integrity": """
        select c_nationkey, count(*) filter (where c_nationkey < 20) as good, count(*) filter (where c_nationkey >= 20) as bad from customer group by 1""",
    # --- state dumps
    "state_dump": _select(DUMP, "select slot, write_version, pubkey, owner, kind, lamports, case when pubkey % 2 = 0 then 320 else 16 end as data_len from loaded"),
    "state_dump_errors": _select(DUMP, """
        select case when pubkey % 50 = 7 then 'pubkey is not a base58 key' else 'data is not base64' end as reason, count(*) as n
        from dumped where pubkey % 50 in (7, 9) group by 1"""),
    "state_dump_run": _select(DUMP, """
        select max(slot) as slot, 'known' as scope, (select count(*) from dumped) as accounts, count(*) as rows_written,
               count(*) filter (where pubkey % 2 = 1) as decode_failures from loaded where kind <> 'UserMetadata'"""),
    "owner_pages": _select(WIRE, """
        select case when size < 96 then '' else printf('%02X', case when kind = 'Obligation' then part % 256 else 0 end) end as owner_page,
               count(*) as accounts from records group by 1"""),
    # --- streaming
    "stream_ingest": _select(WIRE, _STORED_OBL, "select table_name, count(*) as n, max(slot) as max_slot from stored group by 1"),
    "stream_resume": _select(WIRE, """
        select 'main' as stream, a as start_slot, b as end_slot, 0 as filled, 'silent start-up seam: stream opened ' || (b - a) || ' slots late' as reason
        from (select max(slot) filter (where slot <= 2200000000) as a, min(slot) filter (where slot > 2200000000) + 10000000 as b from records) where b - a > 600"""),
    "stream_restart_new_offsets": _select(WIRE, _STORED_OBL, "select table_name, count(*) as n, max(slot) as max_slot from stored group by 1"),
    "stream_positions": _select(WIRE, """
        select 'main' as stream, max(slot) filter (where slot <= 2200000000) as position from records
        union all select 'main-old', max(slot) from records"""),
    "compacted_bronze": _select(WIRE, """
        select lpad(cast(slot // 1000000 * 1000000 as varchar), 12, '0') as slot_bucket, count(*) as n, cast(sum(size) as bigint) as bytes,
               cast(1 as bigint) as most_batches from records group by 1"""),
    "decode_rejects": _select(WIRE, """
        select kind, slot, write_version, part as pubkey, 'short' as reason, '' as field
        from records where kind in ('Obligation', 'Reserve', 'LendingMarket') and size = 40
        union all select kind, slot, write_version, part, 'overflow', 'deposited_value_sf' from oblrec where too_big"""),
    "stream_guard": _select(WIRE, """
        select count(*) filter (where size = 0 and lamports > 0) as impossible, count(*) filter (where size = 0 and lamports = 0) as closed,
               min(slot) filter (where size = 0 and lamports > 0) as first_slot, max(slot) filter (where size = 0 and lamports > 0) as last_slot from records"""),
    "stream_budget": _select(WIRE, """
        select count(*) as n, min(slot) as first_slot, max(slot) as last_slot from records where slot <= (select min(slot) from records) + 100000000"""),
    "stream_restart_out_of_order": _select(WIRE, "select count(*) as n, min(slot) as first_slot, max(slot) as last_slot from records"),
    "stream_replays": _select(WIRE, """
        select kind, count(*) as n, min(slot) as first_slot, max(slot) as last_slot, cast(sum(size) as bigint) as bytes from records group by kind"""),
    "stream_source": _select(WIRE, """
        select kind, count(*) as n, min(slot) as first_slot, max(slot) as last_slot, cast(sum(size) as bigint) as bytes
        from records where slot >= 2000000000 and kind in ('Obligation', 'Reserve') group by kind"""),
    "stream_rollups": _select(WIRE, """
        select kind, count(*) as updates, cast(sum(size) as bigint) as bytes, max(slot) as last_slot from records group by kind"""),
    "stream_freshness": _select(UPD, """
        select distinct kind, state from upd, (values ('fresh'), ('slow'), ('stale')) s(state) union all select 'never seen', 'unknown'"""),
    "stream_frontier": _select(WIRE, """
        select prev as start_slot, slot as end_slot from (select slot, lag(slot) over (order by slot) as prev from (select distinct slot from records))
        where slot - prev > 600"""),
    "stream_alarms": _select(WIRE, """
        select n, slot, write_version, part as pubkey, case when n = 1 then 'first' else 'repeat' end as alarm
        from (select *, row_number() over (order by slot, write_version, part) as n from records where size = 0 and lamports > 0) where n = 1 or n % 10 = 0"""),
    "stream_sessions": _select(WIRE, """t as (select min(slot) as lo, max(slot) as hi, count(distinct slot) as active, count(*) as n,
          cast(sum(size) as bigint) as b from records where slot > 2200000000)
        select lo as first_slot, hi as last_slot, hi - lo as slot_span, round((hi - lo) * 0.4::double, 1) as chain_seconds,
               active as slots_with_updates, round(active * 100.0 / (hi - lo), 1) as density_pct, n as updates, b as payload_bytes,
               round(b / 1024.0 / ((hi - lo) * 0.4::double), 4) as kb_per_second from t"""),
    "stream_lost_position": _select(WIRE, """
        select 'main' as stream, a as start_slot, b as end_slot, 0 as filled, 'position too old: the source no longer replays it' as reason
        from (select max(slot) filter (where slot <= 2200000000) as a, min(slot) filter (where slot > 2200000000) + 10000000 as b from records)"""),
    "key_states_hot": _select(WIRE, """
        select count(*) as n, cast(sum(size) as bigint) as bytes, (select count(distinct part) from records) as accounts,
               cast((select sum(size) from (select size from records qualify row_number() over (partition by part order by slot desc, write_version desc) = 1)) as bigint) as newest_bytes,
               max(slot) as last_slot from records"""),
    "stream_dedup": f"{UPD_S} select slot, write_version, pubkey, kind, data from updc",
    "stream_flow": f"""{UPD_S}, m as (select date_trunc('minute', ingested_at) as t, * from upd)
        select cast(epoch(t) as bigint) as minute, count(*) as writes, {_COUNTS}, cast(sum(data_len) as bigint) as bytes from m group by t""",
    "stream_lag": f"""{UPD_S}, p as (select max(slot) as s, count(*) as n from upd where slot < 4266000000)
        select max(slot) + 17 as tip_slot, (select s from p) as processed_slot, max(slot) + 17 - (select s from p) as behind_slots,
               round((max(slot) + 17 - (select s from p)) * 0.4::double, 1) as behind_s,
               round(({AS_OF_S}000 - (epoch_us(max(ingested_at)) // 1000)) / 1000.0, 1) as stream_lag_s,
               round((select n from p) / 10.0, 4) as updates_per_s from upd""",
    "stream_lag_monitor": f"""{UPD_S}, m as (select *, slot % 2 = 0 and slot < 4266000000 as account from upd),
        t as (select max(slot) filter (where not account) as tip, max(slot) filter (where account) as done, count(*) filter (where account) as n,
              (epoch_us(max(ingested_at)) // 1000) as newest from m)
        select tip as tip_slot, done as processed_slot, tip - done as behind_slots, round((tip - done) * 0.4::double, 1) as behind_s,
               n as updates, newest as newest_ms from t""",
    "running_shapes": f"""{UPD_S} select case when data_len > 0 then 'ok' when lamports = 0 then 'closed' else 'impossible_empty' end as shape,
        count(*) as n, min(slot) as first_slot, max(slot) as last_slot from upd group by 1""",
}

# The same rows by another way.
SQL["dashboard_incremental"], SQL["flow_incremental"] = SQL["system_status"], SQL["flow"]
SQL["account_history_hot"], SQL["history_page_seek"] = SQL["account_history"], SQL["history_page"]

_P = ", ".join(f"('{n}', true)" for n in _PCTS)
SQL["health_distribution_rank_error"] = f"select * from (values {_P}) t(percentile, within)"
SQL["stream_source_refill"] = SQL["stream_source"]
SQL["dashboard_risk"] = SQL["risk_radar"]
SQL["dashboard_system"] = SQL["system_status"]
SQL["dashboard_export"] = f"""select cast({AS_OF_S} as bigint) as generated_s, 'overview' as section, cast(1 as bigint) as n
union all select {AS_OF_S}, 'system', 1
union all select {AS_OF_S}, 'risk', (select count(*) from ({SQL["risk_radar"]}))
union all select {AS_OF_S}, 'reserves', (select count(*) from ({SQL["liquidity_depth"]}))
union all select {AS_OF_S}, 'flow', (with {UPD} select count(distinct date_trunc('minute', ingested_at)) from upd
  where ingested_at >= {AS_OF} - interval 60 minute and ingested_at < {AS_OF})"""
