"""Strict CSV loading of the raw tables."""

import pytest

from weekly_mart.sources.landing import read_raw


def _write(ws, folder, text):
    import os

    path = ws.path("landing", folder)
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.csv"), "w") as fh:
        fh.write(text)
    return ws.path("landing")


def test_na_and_empty_become_null_text_kept(spark, scratch):
    landing = _write(scratch, "stores", "Store,Type,Size\r\n1, A ,NA\r\n2,B,\r\n3,\"\",7\r\n")
    rows = sorted(read_raw(spark, landing, "stores").collect())
    assert rows[0] == ("1", " A ", None)
    assert rows[1] == ("2", "B", None)
    assert rows[2] == ("3", "", "7")


def test_swapped_header_fails(spark, scratch):
    landing = _write(scratch, "stores", "type,store,size\nA,1,10\n")
    with pytest.raises(Exception):
        read_raw(spark, landing, "stores").collect()


def test_malformed_row_aborts(spark, scratch):
    landing = _write(scratch, "stores", "store,type,size\n1,A,10\n2,B\n")
    with pytest.raises(Exception):
        read_raw(spark, landing, "stores").collect()


def test_bad_number_aborts_cast(spark, scratch):
    from weekly_mart.operators import silver

    landing = _write(scratch, "stores", "store,type,size\nx1,A,10\n")
    with pytest.raises(Exception):
        silver.stg_stores(read_raw(spark, landing, "stores")).collect()


def test_shipped_store_file_shape(spark, scratch):
    lines = ["Store,Type,Size"] + [f"{i},{'ABC'[i % 3]},{150000 + i}" for i in range(1, 46)]
    landing = _write(scratch, "stores", "\r\n".join(lines) + "\r\n")
    from weekly_mart.operators import silver

    stg = silver.stg_stores(read_raw(spark, landing, "stores"))
    assert stg.count() == 45
    assert dict(stg.dtypes) == {"store_id": "int", "store_type": "string", "store_size": "int"}


def test_na_between_spaces_is_null(spark, scratch):
    landing = _write(scratch, "stores", "store,type,size\n1, NA ,\" NA\"\n2,NAN, N A\n")
    assert sorted(read_raw(spark, landing, "stores").collect()) == [("1", None, None), ("2", "NAN", " N A")]


def test_bad_rows_are_named_with_file_and_line(spark, scratch, monkeypatch):
    import os

    from weekly_mart.plans.pipeline import CsvMart
    from weekly_mart.sources import landing as module
    from weekly_mart.sources.landing import LoadError, bad_rows

    lines = ["store,type,size"] + [f"{k},A,{k}" for k in range(40)]
    lines[7], lines[33] = "7,A", "33,A,1,extra"
    landing = _write(scratch, "stores", "\r\n".join(lines) + "\r\n")
    with open(os.path.join(landing.replace("file:", ""), "stores", "more.csv"), "w") as fh:
        fh.write("store,type,size\n\n1,A,1\n2\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")  # several blocks a file
    try:
        found = [(os.path.basename(r.file), r.line, r.record) for r in bad_rows(spark, "stores", f"{landing}/stores").collect()]
        assert sorted(found) == [("more.csv", 4, "2"), ("part-0.csv", 8, "7,A"), ("part-0.csv", 34, "33,A,1,extra")]
        for table in ("fact", "department"):
            _write(scratch, table, ",".join(f.name for f in module.RAW_SCHEMAS[table]) + "\n")
        mart = CsvMart(spark, landing, scratch)
        with pytest.raises(LoadError) as error:
            mart.bronze("stores")
        assert "part-0.csv:8: 7,A" in str(error.value) and "more.csv:4: 2" in str(error.value)
        assert not scratch.is_complete(f"{mart.base}/bronze/stores_raw")
        monkeypatch.setattr(module, "NAMED_ROWS", 1)
        assert "3 in all" in str(LoadError("stores", bad_rows(spark, "stores", f"{landing}/stores")))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
