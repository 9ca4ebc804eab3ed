"""Registered queries: name -> (Spark builder over a Mart, DuckDB twin or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weekly_mart.plans import datasets, reports
from weekly_mart.plans.oracle import FAR, with_chain
from weekly_mart.plans.pipeline import Mart, mart

Builder = Callable[[Mart], DataFrame]
_REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, oracle: str | None, extra: list[tuple[str, str]] | None = None, raw: bool = False):
    """Register a builder; ``oracle`` is the final SELECT over the CTE chain
    (plus ``extra`` CTEs), or with ``raw`` the complete DuckDB text."""
    def deco(fn: Builder) -> Builder:
        sql = oracle if raw or not oracle else with_chain(oracle, extra)
        _REGISTRY[name] = (fn, sql)
        return fn
    return deco


# -- SQL fragments for the report twins -------------------------------------
FD = "fact_closed f JOIN date_dim d ON f.date_id = d.date_id"
# The interval is wrapped in CASE so DuckDB keeps it as a residual filter on
# the equi-join (its optimizer otherwise plans the range first, as a
# near-cartesian merge join, from poor CTE size estimates).
FDS = (
    f"{FD} JOIN store_dim s ON f.store_id = s.store_id AND f.dept_id = s.dept_id"
    f" AND (CASE WHEN d.store_date BETWEEN s.vrsn_start_date AND COALESCE(s.vrsn_end_date, {FAR})"
    " THEN 1 ELSE 0 END) = 1"
)
SALES = "CAST(SUM(f.store_weekly_sales) AS DECIMAL(38,2)) AS weekly_sales"
YEAR = "CAST(YEAR(d.store_date) AS INTEGER) AS year"
MONTH = "CAST(MONTH(d.store_date) AS INTEGER) AS month, MONTHNAME(d.store_date) AS month_name"
# Ten-degree buckets written out on their own: by division, not by the engine's list of bounds.
_T = "CAST(floor(f.store_temperature / 10) AS INTEGER)"
BUCKET_ORD = (
    "CASE WHEN f.store_temperature IS NULL OR f.store_temperature >= 90 THEN 10"
    f" WHEN f.store_temperature < 0 THEN 0 ELSE {_T} + 1 END"
)
BUCKET = (
    "CASE WHEN f.store_temperature IS NULL OR f.store_temperature >= 90 THEN '> 90'"
    f" WHEN f.store_temperature < 0 THEN '< 0' ELSE concat({_T} * 10, '-', {_T} * 10 + 10) END AS temp_bucket,"
    f" CAST({BUCKET_ORD} AS INTEGER) AS bucket_ord"
)
FUEL = "CAST(SUM(f.fuel_price) AS DECIMAL(38,4)) AS fuel_price"
MDS = ", ".join(f"CAST(SUM(f.markdown{i}) AS DECIMAL(38,2)) AS markdown{i}" for i in range(1, 6))

REPORT_SQL = {
    "r1_holiday": f"SELECT d.is_holiday AS is_holiday, {SALES} FROM {FD} GROUP BY 1",
    "r1_store": f"SELECT f.store_id AS store, d.is_holiday AS is_holiday, {SALES} FROM {FD} GROUP BY 1, 2",
    "r1_kpi": "SELECT CAST(SUM(f.store_weekly_sales) AS DECIMAL(38,2)) AS total_sales,"
              f" MIN(d.is_holiday) AS first_is_holiday FROM {FD}",
    "r2": f"SELECT {BUCKET}, {YEAR}, {SALES}, MIN(d.store_date) AS earliest_date FROM {FDS} GROUP BY 1, 2, 3",
    "r3": f"SELECT s.store_id AS store, s.store_size AS size, {SALES} FROM {FDS} GROUP BY 1, 2",
    "r4": f"SELECT {MONTH}, s.store_type AS type, {SALES} FROM {FDS} GROUP BY 1, 2, 3",
    "r5": f"SELECT {YEAR}, {MDS} FROM {FD} GROUP BY 1",
    "r6_type": f"SELECT s.store_type AS type, {SALES} FROM {FDS} GROUP BY 1",
    "r6_store": f"SELECT s.store_type AS type, f.store_id AS store, {SALES} FROM {FDS} GROUP BY 1, 2",
    "r7_year": f"SELECT {YEAR}, {FUEL} FROM {FD} GROUP BY 1",
    "r7_store": f"SELECT f.store_id AS store, {YEAR}, {FUEL} FROM {FD} GROUP BY 1, 2",
    "r8_year": f"SELECT {YEAR}, {SALES} FROM {FD} GROUP BY 1",
    "r8_month": f"SELECT {MONTH}, {SALES} FROM {FD} GROUP BY 1, 2",
    "r8_day": f"SELECT CAST(DAY(d.store_date) AS INTEGER) AS day, {SALES} FROM {FD} GROUP BY 1",
    "r9": f"SELECT CAST(ROUND(f.cpi, 2) AS DECIMAL(14,2)) AS cpi, {SALES} FROM fact_closed f"
          " WHERE f.cpi IS NOT NULL GROUP BY 1",
    "r10": f"SELECT f.dept_id AS dept, {SALES} FROM fact_closed f GROUP BY 1",
}

for _name, _fn in reports.REPORTS.items():
    register(_name, REPORT_SQL[_name])(lambda m, _fn=_fn: _fn(m.gold()))


# -- layers -----------------------------------------------------------------
register("department_raw", "SELECT * FROM department_raw")(lambda m: m.bronze("department"))
register("fact_raw", "SELECT * FROM fact_raw")(lambda m: m.bronze("fact"))
register("stores_raw", "SELECT * FROM stores_raw1")(lambda m: m.bronze("stores"))
register("stores_raw_v0", "SELECT * FROM stores_raw0")(lambda m: m.bronze("stores_v0"))
register("stg_stores", "SELECT * FROM stg_stores1")(lambda m: m.stg_stores(1))
register("stg_fact", "SELECT * FROM stg_fact")(lambda m: m.stg_fact())
register("stg_department", "SELECT * FROM stg_department")(lambda m: m.stg_department())
register("date_dim", "SELECT * FROM date_dim")(lambda m: m.date_dim())
register("store_dim_source", "SELECT * FROM src1")(lambda m: m.store_dim_source(1))
register("store_dim_initial", "SELECT * FROM store_dim_run1")(lambda m: m.store_dim_initial())
register("store_dim_scd2", "SELECT * FROM store_dim")(lambda m: m.store_dim())
register("store_dim_current", "SELECT * FROM store_dim WHERE vrsn_end_date IS NULL")(
    lambda m: m.store_dim().where("vrsn_end_date IS NULL")
)
# Dates of the first increment come before the store change and after the first quarter; its April
# days are called holidays. The second increment holds all dates with their true flags.
_FIRST = "store_date < DATE '1998-07-03' AND quarter(store_date) > 1"
register(
    "date_dim_scd1",
    f"SELECT CAST(row_number() OVER (ORDER BY CASE WHEN {_FIRST} THEN 0 ELSE 1 END, store_date) AS INTEGER) AS date_id,"
    f" store_date, is_holiday, CASE WHEN {_FIRST} THEN TIMESTAMP '1990-01-01 00:00:00'"
    " ELSE TIMESTAMP '1998-07-03 00:00:00' END AS insert_date,"
    f" CASE WHEN {_FIRST} AND (month(store_date) <> 4 OR is_holiday) THEN TIMESTAMP '1990-01-01 00:00:00'"
    " ELSE TIMESTAMP '1998-07-03 00:00:00' END AS update_date"
    " FROM (SELECT store_date, max(is_holiday) AS is_holiday FROM stg_fact GROUP BY 1) x",
)(lambda m: m.date_dim_scd1())
register("fact_closed", "SELECT * FROM fact_closed")(lambda m: m.fact("closed"))
register("fact_bucketed", "SELECT * FROM fact_closed")(lambda m: m.fact_bucketed())
register("fact_pit_binned", "SELECT * FROM fact_closed")(lambda m: m.fact_binned())
register(
    "fact_by_year",
    "SELECT f.*, CAST(year(d.store_date) AS INTEGER) AS sale_year FROM fact_closed f JOIN date_dim d ON f.date_id = d.date_id",
)(lambda m: m.fact_by_year())
# The summaries, grouped in the twins by the fact's own rows.
register(
    "sales_daily_by_year",
    "SELECT f.store_id, d.store_date, d.is_holiday, f.cpi, CAST(SUM(f.store_weekly_sales) AS DECIMAL(38,2)) AS weekly_sales,"
    f" {FUEL}, {MDS}, CAST(YEAR(d.store_date) AS INTEGER) AS sale_year FROM {FD} GROUP BY 1, 2, 3, 4",
)(lambda m: m.sales_daily_by_year())
VERSIONED = (
    "SELECT s.store_id, s.store_type, s.store_size, d.store_date, {bucket}, CAST(SUM(f.store_weekly_sales) AS DECIMAL(38,2))"
    " AS weekly_sales{more} FROM {src} GROUP BY 1, 2, 3, 4, 5, 6"
)
register(
    "sales_versioned_by_year",
    VERSIONED.format(bucket=BUCKET, more=", CAST(YEAR(d.store_date) AS INTEGER) AS sale_year", src=FDS),
)(lambda m: m.sales_versioned_by_year())
register("sales_versioned_bucketed", VERSIONED.format(bucket=BUCKET, more="", src=FDS))(lambda m: m.sales_versioned_bucketed())
register("fact_half_open", "SELECT * FROM fact_half")(lambda m: m.fact("half_open"))
register(
    "r3_half_open",
    f"SELECT s.store_id AS store, s.store_size AS size, {SALES} FROM fact_half f JOIN date_dim d ON f.date_id = d.date_id"
    " JOIN store_dim s ON f.store_id = s.store_id AND f.dept_id = s.dept_id AND (CASE WHEN d.store_date >="
    f" s.vrsn_start_date AND d.store_date < COALESCE(s.vrsn_end_date, {FAR}) THEN 1 ELSE 0 END) = 1 GROUP BY 1, 2",
)(lambda m: reports.r3(m.gold("half_open")))


# -- report data sets ---------------------------------------------------------
def _ds(name: str):
    fn = datasets.DATASETS[name]
    return lambda m: fn(m.gold())


def _top(src: str, cols: str, order: str, k: int) -> str:
    return (
        f"SELECT * FROM (SELECT {cols}, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS rank"
        f" FROM {src}) t WHERE rank <= {k}"
    )


def _share(src: str, key: str, value: str) -> str:
    return (
        f"SELECT {key}, {value}, CAST(ROUND(CAST({value} AS DOUBLE) / (SELECT CAST(SUM({value}) AS DOUBLE)"
        f" FROM {src}) * 100, 4) AS DECIMAL(10,4)) AS share_pct FROM {src}"
    )


# Years of the derived sale dates (ship dates of the line items).
YEARS = range(1995, 2002)


def _by_year(value: str, dtype: str) -> str:
    return ", ".join(
        f"CAST(COALESCE(SUM(CASE WHEN year = {y} THEN {value} END), 0) AS {dtype}) AS \"{y}\"" for y in YEARS
    )


R = {k: (f"x_{k}", v) for k, v in REPORT_SQL.items()}
register(
    "report1_grid",
    "SELECT st.store, fl.is_holiday, COALESCE(r.weekly_sales, CAST(0 AS DECIMAL(38,2))) AS weekly_sales"
    " FROM (SELECT DISTINCT store FROM x_r1_store) st CROSS JOIN (SELECT DISTINCT is_holiday FROM x_r1_store) fl"
    " LEFT JOIN x_r1_store r ON r.store = st.store AND r.is_holiday IS NOT DISTINCT FROM fl.is_holiday",
    [R["r1_store"]],
)(_ds("report1_grid"))
register(
    "report2_pivot",
    f"SELECT temp_bucket, bucket_ord, {_by_year('weekly_sales', 'DECIMAL(38,2)')} FROM x_r2 GROUP BY 1, 2",
    [R["r2"]],
)(_ds("report2_pivot"))
register(
    "report2_earliest",
    "SELECT MIN(earliest_date) AS earliest_date, strftime(MIN(earliest_date), '%b %d, %Y') AS earliest_label"
    " FROM x_r2",
    [R["r2"]],
)(_ds("report2_earliest"))
register("report3_top6", _top("x_r3", "store, size, weekly_sales", "weekly_sales DESC, size, store", 6),
         [R["r3"]])(_ds("report3_top6"))
register("report4_lines", "SELECT * FROM x_r4", [R["r4"]])(_ds("report4_lines"))
register("report3_area", "SELECT * FROM x_r3", [R["r3"]])(_ds("report3_area"))
register("report5_markdowns", "SELECT * FROM x_r5", [R["r5"]])(_ds("report5_markdowns"))
register("report8_days", "SELECT * FROM x_r8_day", [R["r8_day"]])(_ds("report8_days"))
register("report9_curve", "SELECT * FROM x_r9", [R["r9"]])(_ds("report9_curve"))
register("report10_depts", "SELECT * FROM x_r10", [R["r10"]])(_ds("report10_depts"))
register(
    "report5_long",
    " UNION ALL ".join(f"SELECT year, 'markdown{i}' AS markdown, markdown{i} AS amount FROM x_r5" for i in range(1, 6)),
    [R["r5"]],
)(_ds("report5_long"))
register(
    "report6_bars",
    "SELECT type, store, weekly_sales, concat_ws('-', type, CAST(store AS VARCHAR)) AS label,"
    " CAST(row_number() OVER (PARTITION BY type ORDER BY weekly_sales, store) AS INTEGER) AS bar_pos"
    " FROM x_r6_store",
    [R["r6_store"]],
)(_ds("report6_bars"))
register("report6_share", _share("x_r6_type", "type", "weekly_sales"), [R["r6_type"]])(_ds("report6_share"))
register(
    "report7_top15",
    "SELECT * FROM (SELECT *, CAST(row_number() OVER (ORDER BY \"2001\" DESC, store) AS INTEGER) AS rank FROM"
    f" (SELECT store, {_by_year('fuel_price', 'DECIMAL(38,4)')} FROM x_r7_store GROUP BY 1) w) t WHERE rank <= 15",
    [R["r7_store"]],
)(_ds("report7_top15"))
register("report7_share", _share("x_r7_year", "year", "fuel_price"), [R["r7_year"]])(_ds("report7_share"))
register(
    "report8_best_month",
    "SELECT month, month_name, weekly_sales FROM x_r8_month ORDER BY weekly_sales DESC, month LIMIT 1",
    [R["r8_month"]],
)(_ds("report8_best_month"))
register("report9_peaks", _top("x_r9", "cpi, weekly_sales", "weekly_sales DESC, cpi", 6), [R["r9"]])(
    _ds("report9_peaks"))
register("report10_top5", _top("x_r10", "dept, weekly_sales", "weekly_sales DESC, dept", 5), [R["r10"]])(
    _ds("report10_top5"))
register("report10_total", "SELECT CAST(SUM(weekly_sales) AS DECIMAL(38,2)) AS grand_total FROM x_r10",
         [R["r10"]])(_ds("report10_total"))


# -- data tests and counts ----------------------------------------------------
def _dq_sql() -> str:
    def nn(t, c):
        return (f"SELECT 'not_null' AS test, '{t}' AS table_name, '{c}' AS column_name,"
                f" CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failures FROM {t if t != 'fact' else 'fact_closed'}")

    def uq(t, c, test="unique", where="TRUE"):
        return (f"SELECT '{test}' AS test, '{t}' AS table_name, '{c}' AS column_name,"
                f" CAST(COUNT(*) AS BIGINT) AS failures FROM (SELECT {c} FROM"
                f" {t} WHERE {where} GROUP BY {c} HAVING COUNT(*) > 1) x")

    parts = [
        uq("date_dim", "date_id"), uq("date_dim", "store_date"),
        nn("date_dim", "date_id"), nn("date_dim", "store_date"),
        nn("fact", "store_id"), nn("fact", "dept_id"), nn("fact", "store_weekly_sales"),
        "SELECT 'positive', 'fact', 'store_weekly_sales', CAST(COUNT(*) FILTER (WHERE store_weekly_sales < 0)"
        " AS BIGINT) FROM fact_closed",
        uq("store_dim", "store_id,dept_id", "one_open_version", "vrsn_end_date IS NULL").replace(
            "SELECT store_id,dept_id FROM", "SELECT store_id, dept_id FROM").replace(
            "GROUP BY store_id,dept_id", "GROUP BY store_id, dept_id"),
        "SELECT 'no_overlap', 'store_dim', 'store_id,dept_id', CAST(COUNT(*) FILTER (WHERE prev_end >"
        " vrsn_start_date) AS BIGINT) FROM (SELECT vrsn_start_date, lag(COALESCE(vrsn_end_date,"
        " TIMESTAMP '9999-12-31 00:00:00')) OVER (PARTITION BY store_id, dept_id ORDER BY vrsn_start_date)"
        " AS prev_end FROM store_dim) x",
    ]
    return " UNION ALL ".join(parts)


register("dq_results", _dq_sql())(lambda m: m.dq_results())
register(
    "row_counts",
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, CAST(COUNT(*) AS BIGINT) AS rows FROM {t}"
        for n, t in [("department_raw", "department_raw"), ("fact_raw", "fact_raw"),
                     ("stores_raw", "stores_raw1"), ("stores_raw_v0", "stores_raw0"),
                     ("stg_department", "stg_department"), ("stg_fact", "stg_fact"),
                     ("stg_stores", "stg_stores1"), ("date_dim", "date_dim"), ("store_dim", "store_dim"),
                     ("store_dim_live", "store_dim WHERE vrsn_end_date IS NULL"), ("fact", "fact_closed")]
    ),
)(lambda m: m.row_counts())
_LISTED = (
    "(EXISTS (SELECT 1 FROM stg_stores0 o WHERE o.store_id = s.store_id AND (s.store_date <= DATE '1998-07-03' OR"
    " EXISTS (SELECT 1 FROM stg_stores1 n WHERE n.store_id = o.store_id AND n.store_type = o.store_type AND"
    " n.store_size = o.store_size))) OR EXISTS (SELECT 1 FROM stg_stores1 n WHERE n.store_id = s.store_id AND"
    " s.store_date >= DATE '1998-07-03'))"
)
register(
    "dropped_sales",
    "SELECT 'no_amount' AS reason, CAST(COUNT(*) AS BIGINT) AS rows FROM department_raw WHERE weekly_sales IS NULL"
    " UNION ALL SELECT 'no_date', CAST(COUNT(*) AS BIGINT) FROM stg_department s WHERE s.store_date NOT IN"
    " (SELECT store_date FROM date_dim)"
    f" UNION ALL SELECT 'no_store_version', CAST(COUNT(*) AS BIGINT) FROM stg_department s WHERE NOT {_LISTED}"
    f" UNION ALL SELECT 'no_store_week', CAST(COUNT(*) AS BIGINT) FROM stg_department s WHERE {_LISTED} AND NOT EXISTS"
    " (SELECT 1 FROM stg_fact w WHERE w.store_id = s.store_id AND w.store_date = s.store_date)",
)(lambda m: m.dropped_sales())
register("department_raw_incremental", "SELECT * FROM department_raw")(
    lambda m: m.bronze_incremental("department"))


# -- public accessors ---------------------------------------------------------
def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        name: (lambda spark, sf_dir, _fn=fn: _fn(mart(spark, sf_dir)))
        for name, (fn, _) in _REGISTRY.items()
    }


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _REGISTRY.items() if sql}
