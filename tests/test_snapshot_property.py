"""SCD2 snapshot vs a brute-force model over random sequences of uploads."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from weekly_mart.operators import dims

KEYS, CHECK = ["store_id", "dept_id"], ["store_type", "store_size"]
SRC = "store_id int, dept_id int, store_type string, store_size int"
TIMES = ["2010-01-01 00:00:00", "2010-06-04 00:00:00", "2011-01-07 00:00:00", "2011-08-05 00:00:00"]

upload = st.dictionaries(
    keys=st.tuples(st.integers(1, 3), st.integers(1, 2)),
    values=st.tuples(st.sampled_from(["A", "B"]), st.one_of(st.none(), st.integers(1, 2))),
    max_size=6,
)


def model(uploads):
    """Check-strategy SCD2 with hard deletes, written the obvious way."""
    live, closed = {}, []
    for i, up in enumerate(uploads):
        t = TIMES[i]
        for k in list(live):
            if k not in up or live[k][0] != up[k]:
                closed.append((*k, *live[k][0], live[k][1], t))
                del live[k]
        for k, v in up.items():
            if k not in live:
                live[k] = (v, t)
    return sorted(closed + [(*k, *v, start, None) for k, (v, start) in live.items()], key=repr)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(upload, min_size=1, max_size=4))
def test_snapshot_matches_model(spark, uploads):
    dim = None
    for i, up in enumerate(uploads):
        src = spark.createDataFrame([(*k, *v) for k, v in up.items()], SRC)
        dim = dims.snapshot(dim, src, KEYS, CHECK, as_of=TIMES[i])
        dim = spark.createDataFrame(dim.collect(), dim.schema)  # keep plans small between runs
    got = sorted(
        ((r.store_id, r.dept_id, r.store_type, r.store_size, str(r.vrsn_start_date),
          None if r.vrsn_end_date is None else str(r.vrsn_end_date)) for r in dim.collect()),
        key=repr,
    )
    assert got == model(uploads)
