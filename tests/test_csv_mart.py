"""The pipeline over user CSV files in the reference's layout, checked
against a brute-force pandas computation on the same rows."""

import os

import pandas as pd

STORES = "Store,Type,Size\r\n1,A,151315\r\n2,B,202307\r\n3,A,37392\r\n"
FACT = (
    "Store,Date,Temperature,Fuel_Price,MarkDown1,MarkDown2,MarkDown3,MarkDown4,MarkDown5,CPI,Unemployment,IsHoliday\n"
    "1,2010-02-05,42.31,2.572,NA,NA,NA,NA,NA,211.0963582,8.106,FALSE\n"
    "1,2010-02-12,38.51,2.548,NA,NA,NA,NA,NA,211.2421698,8.106,TRUE\n"
    "2,2010-02-05,40.19,2.572,10.5,NA,NA,NA,NA,210.7526053,8.324,FALSE\n"
    "2,2010-02-12,NA,2.548,1.25,NA,NA,NA,NA,NA,8.324,TRUE\n"
    "3,2010-02-05,95.0,2.6,NA,NA,NA,NA,NA,214.4248812,7.368,FALSE\n"
)
DEPT = (
    "Store,Dept,Date,Weekly_Sales,IsHoliday\n"
    "1,1,2010-02-05,24924.5,FALSE\n1,1,2010-02-12,46039.49,TRUE\n1,2,2010-02-05,50605.27,FALSE\n"
    "2,1,2010-02-05,35034.06,FALSE\n2,1,2010-02-12,-60.0,TRUE\n2,2,2010-02-12,NA,TRUE\n"
    "3,1,2010-02-05,1000.0,FALSE\n3,3,2010-02-12,5.0,TRUE\n"
)


def _local(tmp_path, name, text):
    p = tmp_path / f"{name}.csv"
    p.write_text(text)
    return str(p)


def test_csv_pipeline_matches_brute_force(spark, scratch, tmp_path):
    from weekly_mart.plans import reports
    from weekly_mart.plans.pipeline import CsvMart
    from weekly_mart.sources.landing import upload

    landing = scratch.path("landing")
    upload(spark, {"stores": _local(tmp_path, "stores", STORES), "fact": _local(tmp_path, "fact", FACT),
                   "department": _local(tmp_path, "department", DEPT)}, landing)
    m = CsvMart(spark, landing, as_of="2013-01-01 00:00:00")
    g = m.gold()

    dept = pd.read_csv(os.path.join(tmp_path, "department.csv"), na_values=["NA"]).dropna(subset=["Weekly_Sales"])
    fact = pd.read_csv(os.path.join(tmp_path, "fact.csv"), na_values=["NA"])
    j = dept.merge(fact[["Store", "Date"]], on=["Store", "Date"])  # inner joins; every store has a version
    assert g.fact.count() == len(j)
    by_dept = {r.dept: float(r.weekly_sales) for r in reports.r10(g).collect()}
    assert by_dept == {k: round(v, 2) for k, v in j.groupby("Dept")["Weekly_Sales"].sum().items()}
    by_type = {r.type: float(r.weekly_sales) for r in reports.r6_type(g).collect()}
    st = pd.read_csv(os.path.join(tmp_path, "stores.csv"))
    want = j.merge(st, on="Store").groupby("Type")["Weekly_Sales"].sum()
    assert by_type == {k: round(v, 2) for k, v in want.items()}
    # first load is backdated, so 2010 sales find their version
    assert {str(r.vrsn_start_date) for r in g.store_dim.collect()} == {"1900-01-01 00:00:00"}


def test_second_upload_adds_versions_once(spark, scratch, tmp_path):
    from weekly_mart.plans.pipeline import CsvMart
    from weekly_mart.sources.landing import upload

    landing = scratch.path("landing2")
    files = {"stores": _local(tmp_path, "stores", STORES), "fact": _local(tmp_path, "fact", FACT),
             "department": _local(tmp_path, "department", DEPT)}
    upload(spark, files, landing)
    CsvMart(spark, landing, as_of="2011-01-01 00:00:00").store_dim()
    CsvMart(spark, landing, as_of="2011-06-01 00:00:00").store_dim()  # same files: no new run
    upload(spark, {"stores": _local(tmp_path, "stores2", STORES.replace("37392", "40000"))}, landing)
    d = CsvMart(spark, landing, as_of="2012-01-01 00:00:00").store_dim()
    rows = sorted((r.store_id, r.dept_id, r.store_size, str(r.vrsn_end_date)) for r in d.where("store_id = 3").collect())
    # store 3 changed size: each of its departments has one closed and one open version
    assert [r for r in rows if r[1] == 1] == [(3, 1, 37392, "2012-01-01 00:00:00"), (3, 1, 40000, "None")]


def test_one_new_week_rewrites_one_year(spark, scratch, tmp_path):
    import contextlib
    import glob
    import io

    from weekly_mart.operators import fact as facts
    from weekly_mart.plans.pipeline import CsvMart
    from weekly_mart.sources.landing import upload

    landing = scratch.path("landing3")
    more_weeks = FACT + "1,2011-03-04,50,2.6,NA,NA,NA,NA,NA,212,8,FALSE\n"
    more_sales = DEPT.rstrip() + "\n1,1,2011-03-04,100.5,FALSE\n"
    files = {"stores": _local(tmp_path, "stores", STORES), "fact": _local(tmp_path, "fact", more_weeks),
             "department": _local(tmp_path, "department", more_sales)}
    upload(spark, files, landing)
    first = CsvMart(spark, landing, as_of="2013-01-01 00:00:00")
    ids = {r.store_date: r.date_id for r in first.date_dim().collect()}
    first.fact()
    home = first.home.replace("file:", "")
    builds = lambda: {os.path.relpath(p, home) for p in glob.glob(f"{home}/gold/fact_closed/*/build=*")}
    before = builds()
    assert len(before) == 2

    # one more week of 2011, and a date before all others
    files["fact"] = _local(tmp_path, "fact2", more_weeks + "1,2011-03-11,50,2.6,NA,NA,NA,NA,NA,212,8,FALSE\n")
    files["department"] = _local(tmp_path, "department2", more_sales + "1,1,2011-03-11,7.5,FALSE\n")
    upload(spark, files, landing)
    second = CsvMart(spark, landing, as_of="2014-01-01 00:00:00")
    got = second.fact()
    new = builds() - before
    assert len(new) == 1 and "sale_year=2011" in new.pop()
    later = {r.store_date: r.date_id for r in second.date_dim().collect()}
    assert {d: later[d] for d in ids} == ids and len(later) == len(ids) + 1

    full = facts.build_fact(second.stg_department(), second.store_dim(), second.stg_fact(), second.date_dim())
    kept = [c for c in facts.FACT_COLUMNS if c not in ("insert_date", "update_date")]
    assert sorted(map(str, got.select(kept).collect())) == sorted(map(str, full.select(kept).collect()))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        second.fact_by_year().where("sale_year = 2011").explain()
    assert "PartitionFilters: [isnotnull(sale_year" in buf.getvalue()


def test_cli_runs_from_uploaded_files(spark, scratch, tmp_path, capsys):
    import json

    from weekly_mart.__main__ import main

    landing, out = scratch.path("landing_cli"), scratch.path("reports_cli")
    main(["--landing", landing, "--as-of", "2013-01-01 00:00:00", "--out", out, "--format", "csv",
          "--upload", f"stores={_local(tmp_path, 'stores', STORES)}", f"fact={_local(tmp_path, 'fact', FACT)}",
          f"department={_local(tmp_path, 'department', DEPT)}"])
    res = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    # dept 3 sold only on a week with no store-week row: the inner join drops it
    assert res["report_rows"]["r10"] == 2 and res["report_rows"]["r1_kpi"] == 1
    assert len(res["report_rows"]) == 35
    r10 = spark.read.option("header", "true").csv(f"{out}/r10")
    assert r10.count() == 2
    tests = {(t["test"], t["column_name"]): t["failures"] for t in res["data_tests"]}
    assert tests[("positive", "store_weekly_sales")] == 1  # the -60.0 week


def test_fingerprint_sees_a_rewrite(spark, scratch, tmp_path):
    from weekly_mart.sources.landing import upload

    landing = scratch.path("fp")
    upload(spark, {"stores": _local(tmp_path, "s1", STORES)}, landing)
    a = scratch.fingerprint(f"{landing}/stores")
    assert a == scratch.fingerprint(f"{landing}/stores")
    upload(spark, {"stores": _local(tmp_path, "s2", STORES.replace("37392", "400000"))}, landing)
    assert scratch.fingerprint(f"{landing}/stores") != a


def test_a_file_uploaded_again_replaces_its_rows(spark, scratch, tmp_path):
    from weekly_mart.sources.landing import upload
    from weekly_mart.streaming.uploads import load_uploads, read_uploads

    landing, target = scratch.path("again"), scratch.path("again_raw")
    upload(spark, {"stores": _local(tmp_path, "s1", STORES)}, landing)
    assert load_uploads(scratch, f"{landing}/stores", "stores", target) == 1
    assert load_uploads(scratch, f"{landing}/stores", "stores", target) == 0
    first = sorted(tuple(r) for r in read_uploads(scratch, target).collect())
    assert first == [("1", "A", "151315"), ("2", "B", "202307"), ("3", "A", "37392")]
    with open(os.path.join(landing.replace("file:", ""), "stores", "more.csv"), "w") as fh:
        fh.write("Store,Type,Size\n9,C,1\n")
    upload(spark, {"stores": _local(tmp_path, "s2", "Store,Type,Size\r\n1,A,7\r\n4,B,8\r\n")}, landing)
    assert load_uploads(scratch, f"{landing}/stores", "stores", target) == 2
    assert sorted(tuple(r) for r in read_uploads(scratch, target).collect()) == [
        ("1", "A", "7"), ("4", "B", "8"), ("9", "C", "1")]


def test_cli_expected_counts(spark, scratch, tmp_path, capsys):
    import json

    import pytest

    from weekly_mart.__main__ import main

    landing = scratch.path("landing_expect")
    files = [f"stores={_local(tmp_path, 'stores', STORES)}", f"fact={_local(tmp_path, 'fact', FACT)}",
             f"department={_local(tmp_path, 'department', DEPT)}"]
    main(["--landing", landing, "--as-of", "2013-01-01 00:00:00", "--upload", *files,
          "--expect", "department_raw=8", "stores_raw=3"])
    res = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    got = {r["table_name"]: r["ok"] for r in res["row_counts"] if r["expected"] is not None}
    assert got == {"department_raw": True, "stores_raw": True}
    with pytest.raises(AssertionError, match="row counts differ"):
        main(["--landing", landing, "--as-of", "2013-01-01 00:00:00", "--strict",
              "--expect", "department_raw=421570"])
