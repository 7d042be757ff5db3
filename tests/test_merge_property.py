"""Property: upsert equals a plain model of SQL MERGE (UPDATE SET * / INSERT *)."""

import datetime as dt
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stayledger.operators import table as TB

SCHEMA = "transaction_id bigint, check_in_date date, revenue double"
DATES = [dt.date(2024, 1, 1), dt.date(2024, 2, 1), None]

row = st.tuples(st.sampled_from([None, 1, 2, 3, 4, 5]), st.sampled_from(DATES),
                st.integers(0, 9).map(float))


def model(target, source):
    """Expected state and changes of merging ``source`` into ``target``."""
    by_key = {s[0]: s for s in source if s[0] is not None}
    tkeys = {t[0] for t in target if t[0] is not None}
    state, changes = [], []
    for t in target:
        s = by_key.get(t[0]) if t[0] is not None else None
        if s is None:
            state.append(t)
        else:
            state.append(s)
            changes += [t + ("UPDATE_BEFORE",), s + ("UPDATE_AFTER",)]
    for s in source:
        if s[0] is None or s[0] not in tkeys:
            state.append(s)
            changes.append(s + ("INSERT",))
    return Counter(state), Counter(changes)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=st.lists(row, min_size=1, max_size=6), source=st.lists(row, max_size=5))
def test_upsert_matches_merge_model(spark, scratch, target, source):
    # a target key matched by two source rows is a MERGE error: keep one source row per key
    seen, src = set(), []
    for s in source:
        if s[0] is None or s[0] not in seen:
            src.append(s)
            seen.add(s[0]) if s[0] is not None else None
    spec = TB.TableSpec(scratch("prop"))
    TB.create_table(spark, spec, spark.createDataFrame(target, SCHEMA))
    res = TB.upsert(spark, spec, spark.createDataFrame(src, SCHEMA))
    state, changes = model(target, src)
    got_state = Counter(tuple(r) for r in TB.read_table(spark, spec).collect())
    got_changes = Counter((r.transaction_id, r.check_in_date, r.revenue, r._change_type)
                          for r in TB.changes(spark, spec, 1, 2).collect())
    assert got_state == state
    assert got_changes == changes
    assert res.inserted == sum(n for c, n in changes.items() if c[3] == "INSERT")
    assert res.updated == sum(n for c, n in changes.items() if c[3] == "UPDATE_AFTER")
    assert res.row_count == sum(state.values())
