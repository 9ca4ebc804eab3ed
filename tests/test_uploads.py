"""The stream of uploads: replaced files, a crash between batches, removed and emptied files."""

import os

import pytest

from weekly_mart.sources.landing import upload
from weekly_mart.streaming import uploads
from weekly_mart.streaming.uploads import load_uploads, read_uploads

HEAD = "Store,Type,Size\n"


def _put(landing, name, text):
    path = os.path.join(landing.replace("file:", ""), "stores", name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def _rows(ws, target):
    return sorted(tuple(r) for r in read_uploads(ws, target, "stores").collect())


def _upload(spark, tmp_path, landing, text):
    local = tmp_path / "stores.csv"
    local.write_text(HEAD + text)
    upload(spark, {"stores": str(local)}, landing)


def test_replaced_emptied_and_removed_files(spark, scratch, tmp_path):
    landing, target = scratch.path("up"), scratch.path("up_raw")
    _upload(spark, tmp_path, landing, "1,A,10\n2,B,20\n")
    _put(landing, "2010.csv", HEAD + "9,C,1\n")  # a name that could be taken for a number
    assert load_uploads(scratch, f"{landing}/stores", "stores", target) == 2
    assert _rows(scratch, target) == [("1", "A", "10"), ("2", "B", "20"), ("9", "C", "1")]
    assert load_uploads(scratch, f"{landing}/stores", "stores", target) == 0
    _upload(spark, tmp_path, landing, "1,A,11\n")
    _upload(spark, tmp_path, landing, "1,A,12\n")  # twice before the next load: the file as it is now
    assert load_uploads(scratch, f"{landing}/stores", "stores", target) == 1
    assert _rows(scratch, target) == [("1", "A", "12"), ("9", "C", "1")]
    os.unlink(os.path.join(landing.replace("file:", ""), "stores", "2010.csv"))
    _upload(spark, tmp_path, landing, "")
    assert load_uploads(scratch, f"{landing}/stores", "stores", target) == 1
    assert _rows(scratch, target) == [("9", "C", "1")]  # removed files keep their rows, emptied ones do not


def test_crash_after_the_write_of_a_batch(spark, scratch, monkeypatch):
    landing, target = scratch.path("crash"), scratch.path("crash_raw")
    for k in range(4):
        _put(landing, f"f{k}.csv", HEAD + f"{k},A,{k}\n")
    seen, real = [], uploads.read_files

    def dies_in_the_third(spark, table, paths):
        seen.append(paths)
        if len(seen) == 3:
            raise RuntimeError("executor lost")
        return real(spark, table, paths)

    monkeypatch.setattr(uploads, "read_files", dies_in_the_third)
    with pytest.raises(Exception, match="executor lost"):
        load_uploads(scratch, f"{landing}/stores", "stores", target, max_files_per_trigger=1)
    assert len(_rows(scratch, target)) == 2
    assert load_uploads(scratch, f"{landing}/stores", "stores", target, max_files_per_trigger=1) == 2
    assert _rows(scratch, target) == [(str(k), "A", str(k)) for k in range(4)]
    assert seen[2] == seen[3]  # the batch that died is run again


def test_malformed_file_loads_nothing_of_its_batch(spark, scratch):
    landing, target = scratch.path("bad"), scratch.path("bad_raw")
    _put(landing, "a.csv", HEAD + "1,A,1\n")
    _put(landing, "b.csv", HEAD + "2,A\n")
    with pytest.raises(Exception):
        load_uploads(scratch, f"{landing}/stores", "stores", target)
    assert not scratch.exists(f"{target}/rows/_file=a.csv")
    _put(landing, "b.csv", HEAD + "2,A,2\n")
    assert load_uploads(scratch, f"{landing}/stores", "stores", target) == 2
    assert _rows(scratch, target) == [("1", "A", "1"), ("2", "A", "2")]
