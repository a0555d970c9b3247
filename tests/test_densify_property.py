"""densify against a brute-force statement of the reference's grid: every
calendar month >= the key's first purchase month, facts on purchase months."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from spendgrid.operators.snapshot import densify


def month(i: int) -> dt.date:
    return dt.date(2019 + i // 12, i % 12 + 1, 1)


def brute(facts, start, end):
    first = {}
    for k, m, _ in facts:
        first[k] = min(first.get(k, m), m)
    val = {(k, m): v for k, m, v in facts}
    out = set()
    for k, f in first.items():
        for i in range(start, end + 1):
            if i >= f:
                out.add((k, month(i), val.get((k, i))))
    return out


facts_st = st.lists(
    st.tuples(st.integers(0, 4), st.integers(0, 30), st.integers(1, 9)),
    min_size=1, max_size=25,
    unique_by=lambda t: (t[0], t[1]))


@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(facts=facts_st, start=st.integers(0, 30), span=st.integers(0, 20))
def test_densify_matches_brute_force(spark, facts, start, span):
    end = start + span
    df = spark.createDataFrame(
        [(k, month(m), float(v)) for k, m, v in facts],
        "k long, sale_month date, v double")
    got = {(r.k, r.dt, None if r.v is None else int(r.v)) for r in densify(
        df, calendar_start=month(start), calendar_end=month(end), keys=["k"]).collect()}
    assert got == brute(facts, start, end)
