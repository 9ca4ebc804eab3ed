"""DuckDB twins of the registered queries, for the correctness check.

DuckDB only has the driver's test tables, so every twin carries the whole
chain as CTEs: derived raw tables (NA already NULL, as after the strict CSV
load) -> staging -> date dim, two store snapshots, fact -> the query. Types
are pinned (INTEGER years, DECIMAL(38,s) sums) so both engines agree.
"""

from __future__ import annotations

import re

from weekly_mart.sources.fixtures import BUILD_AT, CHANGE_AT, FIRST_LOAD_AT

T0, T1, TB = f"TIMESTAMP '{FIRST_LOAD_AT}'", f"TIMESTAMP '{CHANGE_AT}'", f"TIMESTAMP '{BUILD_AT}'"
FAR = "TIMESTAMP '9999-12-31 00:00:00'"

_HOLIDAY = (
    "case when ((month(d)=2 and day(d) between 6 and 12) or (month(d)=9 and day(d) between 4 and 10)"
    " or (month(d)=11 and day(d) between 22 and 28) or (month(d)=12 and day(d) between 25 and 31))"
    " then 'TRUE' else 'FALSE' end"
)


def _md(i: int, mod: int, mult: int) -> str:
    return (
        f"case when (sk + w + {i}) % {mod} < 2 then NULL else cast(cast(((sk*{3 + i} + w*{mult}) % 9000)"
        f" * 0.25 as decimal(14,2)) as varchar) end markdown{i}"
    )


def _stores(size: str, listed: str) -> str:
    return (
        "select cast(s_suppkey+1 as varchar) store, concat(' ', case s_nationkey % 3 when 0 then 'A'"
        f" when 1 then 'B' else 'C' end, ' ') type, cast({size} as varchar) size from supplier where {listed}"
    )


def _src(stores: str) -> str:
    return (
        "select s.store_id, d.dept_id, s.store_type, s.store_size from (select cast(store as int) store_id,"
        f" trim(type) store_type, cast(size as int) store_size from {stores}) s"
        " cross join (select distinct dept_id from stg_department) d"
    )


_CHANGED = "a.store_type is distinct from b.store_type or a.store_size is distinct from b.store_size"


def _fact(boundary: str) -> str:
    """Sales with the store lists as they were uploaded, not with the dimension.

    A store of the first list is valid from the first load up to the change, or
    for good where the second list has it unchanged; a new or changed store of
    the second list is valid from the change. On the change day itself both
    rules apply under the closed boundary.
    """
    last_old = "<=" if boundary == "closed" else "<"
    change = f"date '{CHANGE_AT[:10]}'"
    columns = (
        "s.store_id, s.dept_id, x.date_id, s.weekly_sales store_weekly_sales, w.fuel_price,"
        " w.temperature store_temperature, w.unemployment, w.cpi, w.markdown1, w.markdown2, w.markdown3,"
        " w.markdown4, w.markdown5"
    )
    tables = (
        " from stg_department s join date_dim x using (store_date)"
        " join stg_fact w on w.store_id = s.store_id and w.store_date = s.store_date"
    )
    same = "(select a.* from stg_stores0 a semi join stg_stores1 b using (store_id, store_type, store_size))"
    old = "(select a.* from stg_stores0 a anti join stg_stores1 b using (store_id, store_type, store_size))"
    new = "(select b.* from stg_stores1 b anti join stg_stores0 a using (store_id, store_type, store_size))"

    def part(stores: str, start: str, end: str, where: str) -> str:
        return (
            f"select {columns}, {start} vrsn_start_date, {end} vrsn_end_date, {TB} insert_date, {TB} update_date"
            f"{tables} semi join {stores} l on l.store_id = s.store_id where {where}"
        )

    return " union all ".join([
        part(same, T0, "cast(null as timestamp)", f"s.store_date >= date '{FIRST_LOAD_AT[:10]}'"),
        part(old, T0, T1, f"s.store_date {last_old} {change}"),
        part(new, T1, "cast(null as timestamp)", f"s.store_date >= {change}"),
    ])


CHAIN: list[tuple[str, str]] = [
    ("department_raw",
     "select cast(sk+1 as varchar) store, cast(dept as varchar) dept, cast(d as varchar) date,"
     " cast(case when (sk + dept) % 23 = 0 then null else v end as varchar) weekly_sales,"
     f" {_HOLIDAY} isholiday from (select l_suppkey sk, l_partkey % 99 + 1 dept,"
     " cast(date_trunc('week', l_shipdate) as date) + 4 d,"
     " sum(cast(l_extendedprice as decimal(14,2)) * case when l_returnflag='R' then -1 else 1 end) v"
     " from lineitem group by 1,2,3) x"),
    ("fact_raw",
     "select cast(sk+1 as varchar) store, cast(d as varchar) date,"
     " case when (sk+w) % 41 = 0 then NULL else cast(cast(((sk*37 + w*53) % 1300) * 0.1 - 15"
     " as decimal(10,4)) as varchar) end temperature,"
     " cast(cast(2.5 + ((sk*3 + w) % 170) * 0.01 as decimal(10,4)) as varchar) fuel_price, "
     + ", ".join([_md(1, 4, 18), _md(2, 3, 25), _md(3, 4, 32), _md(4, 3, 39), _md(5, 4, 46)])
     + ", case when w % 29 = 0 then NULL else cast(cast(126 + ((sk*13) % 100) + w * 0.00317"
     " as decimal(14,6)) as varchar) end cpi,"
     " cast(cast(4 + ((sk*7 + w) % 90) * 0.1 as decimal(10,4)) as varchar) unemployment,"
     f" {_HOLIDAY} isholiday"
     " from (select sk, d, datediff('day', cast('1995-01-01' as date), d) // 7 w from (select distinct"
     " l_suppkey sk, cast(date_trunc('week', l_shipdate) as date) + 4 d from lineitem) y) x"),
    ("stores_raw0", _stores("30000 + (s_suppkey*7919) % 190000", "s_suppkey % 20 <> 7")),
    ("stores_raw1", _stores("30000 + (s_suppkey*7919) % 190000 + case when s_suppkey % 10 = 3 then 5000"
                            " else 0 end", "s_suppkey % 50 <> 49")),
    ("stg_department",
     "select cast(store as int) store_id, cast(dept as int) dept_id, cast(date as date) store_date,"
     " cast(weekly_sales as decimal(14,2)) weekly_sales, cast(isholiday as boolean) is_holiday"
     " from department_raw where weekly_sales is not null"),
    ("stg_fact",
     "select cast(store as int) store_id, cast(date as date) store_date,"
     " cast(temperature as decimal(10,4)) temperature, cast(fuel_price as decimal(10,4)) fuel_price,"
     " cast(markdown1 as decimal(14,2)) markdown1, cast(markdown2 as decimal(14,2)) markdown2,"
     " cast(markdown3 as decimal(14,2)) markdown3, cast(markdown4 as decimal(14,2)) markdown4,"
     " cast(markdown5 as decimal(14,2)) markdown5, cast(cpi as decimal(14,6)) cpi,"
     " cast(unemployment as decimal(10,4)) unemployment, cast(isholiday as boolean) is_holiday"
     " from fact_raw"),
    ("stg_stores0", "select cast(store as int) store_id, trim(type) store_type, cast(size as int) store_size"
                    " from stores_raw0"),
    ("stg_stores1", "select cast(store as int) store_id, trim(type) store_type, cast(size as int) store_size"
                    " from stores_raw1"),
    ("src0", _src("stores_raw0")),
    ("src1", _src("stores_raw1")),
    ("date_dim",
     "select cast(row_number() over (order by store_date, is_holiday) as integer) date_id, store_date,"
     f" is_holiday, {TB} insert_date, {TB} update_date"
     " from (select distinct store_date, is_holiday from stg_fact) x"),
    ("store_dim_run1",
     f"select store_id, dept_id, store_type, store_size, {T0} vrsn_start_date,"
     f" cast(null as timestamp) vrsn_end_date, {T0} insert_date, {T0} update_date from src0"),
    ("store_dim",
     f"select a.store_id, a.dept_id, a.store_type, a.store_size, {T0} vrsn_start_date,"
     f" case when b.store_id is null or {_CHANGED} then {T1} end vrsn_end_date, {T0} insert_date,"
     f" case when b.store_id is null or {_CHANGED} then {T1} else {T0} end update_date"
     " from src0 a left join src1 b on a.store_id=b.store_id and a.dept_id=b.dept_id"
     f" union all select b.store_id, b.dept_id, b.store_type, b.store_size, {T1}, cast(null as timestamp),"
     f" {T1}, {T1} from src1 b left join src0 a on a.store_id=b.store_id and a.dept_id=b.dept_id"
     f" where a.store_id is null or {_CHANGED}"),
    ("fact_closed", _fact("closed")),
    ("fact_half", _fact("half_open")),
]


def with_chain(body: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` with the CTEs it needs, directly or through others, each
    computed once."""
    chain = CHAIN + (extra or [])
    needed, text = [], body
    for name, sql in reversed(chain):
        if re.search(rf"\b{name}\b", text):
            needed.append((name, sql))
            text += " " + sql
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({sql})" for name, sql in reversed(needed))
    return f"WITH {ctes}\n{body}" if needed else body
