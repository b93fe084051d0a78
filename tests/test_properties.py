"""Property tests (hypothesis): rule marking equals a plain-Python
evaluation, splits partition the input, hubs are the distinct keys, and the
sliced lag equals a plain window - on random rows with NULLs and ties."""

import datetime as dt
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from vaultline.functions import checks
from vaultline.operators import quality, vault
from vaultline.operators.ordered import ordered_lag
from vaultline.plans.rules import Rule

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
ints = st.one_of(st.none(), st.integers(-20, 20))
texts = st.one_of(st.none(), st.text(alphabet="aAbB1 -", max_size=6))


def expected_failures(v, s, lo, hi):
    out = []
    if v is not None and not (lo <= v <= hi):
        out.append("range:v")
    if s is not None and len(s) > 3:
        out.append("max_length:s")
    if s is not None and len(s) < 2:
        out.append("min_length:s")
    if s is not None and not re.search("^[a-z]", s):
        out.append("regex:s")
    if v is None:
        out.append("not_null:v")
    if s is not None and s not in ("a", "B"):
        out.append("accepted_values:s")
    return sorted(out)


@SETTINGS
@given(st.lists(st.tuples(ints, texts), max_size=40), st.integers(-10, 10), st.integers(0, 10))
def test_marking_matches_python(spark, data, lo, span):
    hi = lo + span
    rules = [Rule(column="v", kind="range", args=(lo, hi), handling="discard"),
             Rule(column="s", kind="max_length", args=(3,), handling="log"),
             Rule(column="s", kind="min_length", args=(2,), handling="log"),
             Rule(column="s", kind="regex", args=("^[a-z]",), handling="quarantine"),
             Rule(column="v", kind="not_null", handling="quarantine"),
             Rule(column="s", kind="accepted_values", args=("a", "B"), handling="log")]
    df = spark.createDataFrame([(i, v, s) for i, (v, s) in enumerate(data)], "id int, v int, s string")
    got = {r["id"]: sorted(r["failed_rules"]) for r in quality.mark_failures(df, rules).collect()}
    assert got == {i: expected_failures(v, s, lo, hi) for i, (v, s) in enumerate(data)}
    sp = quality.split(quality.mark_failures(df, rules), rules)
    parts = [set(r["id"] for r in p.select("id").collect()) for p in (sp.clean, sp.quarantine, sp.discarded)]
    assert sum(len(p) for p in parts) == len(data) and set().union(*parts) == set(range(len(data)))


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(0, 15)), max_size=60))
def test_hub_is_distinct_non_null_keys(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k int")
    h = vault.hub(df, "k", "x", "2024-01-01 00:00:00", "src")
    rows = h.collect()
    assert sorted(r["k"] for r in rows) == sorted({k for k in keys if k is not None})
    assert len({r["hub_x_key"] for r in rows}) == len(rows)
    assert h.filter(checks.hash_key_format("hub_x_key")).count() == 0


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.integers(0, 50))),
                min_size=1, max_size=60),
       st.sampled_from([2, 3, 17, 1024]))
def test_sliced_lag_equals_window(spark, data, slices):
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(i, k, None if h is None else t0 + dt.timedelta(hours=h))
                                for i, (k, h) in enumerate(data)], "id int, k int, ts timestamp_ntz")
    got = ordered_lag(df, "k", ["ts", "id"], ["id"], slices=slices)
    want = ordered_lag(df, "k", ["ts", "id"], ["id"], skew_safe=False)
    assert sorted(tuple(r) for r in got.select("id", "prev_id").collect()) == \
        sorted(tuple(r) for r in want.select("id", "prev_id").collect())
