"""Metadata sheets -> specs -> job (E10), both header spellings."""

import pytest

from vaultline.metadata import normalize
from vaultline.plans import template as tpl
from vaultline.plans.jobs import LookupSpec, TargetSpec, build_target, checked_target, run_job, specs_from_metadata
from vaultline.plans.rules import parse_cell
from vaultline.session import scratch_path
from tests.conftest import SF001, rows


def test_both_header_spellings(spark):
    guide = spark.createDataFrame([("crm", "customers", "customer_id", "INTEGER")],
                                  ["Source System Name", "Source Table Name", "Source Column Name", "Data Type"])
    short = spark.createDataFrame([("customers", "customer_id", "INTEGER", "id")],
                                  ["Table Name", "Column Name", "Data Type", "Description"])
    a, b = normalize(guide, "source_columns"), normalize(short, "source_columns")
    assert a.columns == b.columns
    assert rows(a, "table_name", "column_name") == rows(b, "table_name", "column_name")
    with pytest.raises(ValueError):
        normalize(spark.createDataFrame([("x",)], ["Data Type"]), "source_columns")


def test_dq_sheet_headers(spark):
    dq = spark.createDataFrame([("email", "Regex(^[^@]+@[^@]+$)", "quarantine", 10)],
                               ["Column Name", "Validations", "Reject Handling", "Record Count Expected"])
    n = normalize(dq, "rules").first()
    assert (n["column_name"], n["rule"], n["record_count_expected"]) == ("email", "Regex(^[^@]+@[^@]+$)", 10)


def test_specs_from_template(spark):
    specs = {s.name: s for s in specs_from_metadata(tpl.target_columns(spark), tpl.mappings(spark), tpl.loads(spark))}
    o = specs["orders"]
    assert o.source == "orders" and o.filter.startswith("o_orderdate >")
    assert o.joins == [("customer", "orders.o_custkey = customer.c_custkey", "inner")]
    assert o.load_mode == "incremental" and o.watermark_column == "o_orderdate"
    assert [r.kind for r in specs["customer"].rules] == ["not_null", "unique", "not_null", "max_length"]


def test_filter_reaches_scan(spark):
    specs = {s.name: s for s in specs_from_metadata(tpl.target_columns(spark), tpl.mappings(spark))}
    df = build_target(specs["orders"], tpl.sources(spark, SF001))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderdate" in plan


def test_lookup_and_aggregation_spec(spark):
    srcs = tpl.sources(spark, SF001)
    spec = TargetSpec(name="seg", source="customer", columns={"nation": "n_name", "bal": "c_acctbal"},
                      lookups=[LookupSpec("nation", [("c_nationkey", "n_nationkey")], ["n_name"])],
                      aggregation="COUNT(*) AS n GROUP BY nation")
    out = build_target(spec, srcs)
    assert out.agg({"n": "sum"}).first()[0] == srcs["customer"].count()


def test_run_job_writes_targets(spark):
    specs = specs_from_metadata(tpl.target_columns(spark), tpl.mappings(spark))
    targets = {s.name: scratch_path(spark, s.name) for s in specs}
    q = scratch_path(spark, "quarantine")
    reps = run_job(spark, specs, tpl.sources(spark, SF001), targets, q, tpl.LOAD_TS)
    assert [r["valid"] for r in reps] == [True, True]
    assert spark.read.parquet(targets["customer"]).count() == spark.read.parquet(f"{SF001}/customer.parquet").count()
    s = checked_target(specs[1], tpl.sources(spark, SF001))
    assert s.quarantine.count() == 0


def test_failed_casts_are_rejects(spark):
    src = spark.createDataFrame([(1, "10"), (2, "x"), (3, None)], "id int, qty string")
    spec = TargetSpec(name="t", source="s", columns={"id": "id", "qty": "qty"}, types={"qty": "INTEGER"})
    s = checked_target(spec, {"s": src})
    assert rows(s.clean, "id", "qty") == [(1, 10), (3, None)]          # NULL is not a failed cast
    assert [(r["id"], r["failed_rules"]) for r in s.quarantine.collect()] == [(2, ["cast_failed"])]
    assert "_cast_failures" not in s.clean.columns


def test_incremental_run_job(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    src = spark.createDataFrame([(i, t0 + dt.timedelta(days=i)) for i in range(5)], "id bigint, ts timestamp_ntz")
    spec = TargetSpec(name="t", source="s", columns={"id": "id", "ts": "ts"}, load_mode="incremental",
                      watermark_column="ts", rules=[])
    target, state = scratch_path(spark, "inc_t"), scratch_path(spark, "inc_state")
    r1 = run_job(spark, [spec], {"s": src}, {"t": target}, None, tpl.LOAD_TS, state_path=state, batch_id="1")
    r2 = run_job(spark, [spec], {"s": src}, {"t": target}, None, tpl.LOAD_TS, state_path=state, batch_id="2")
    more = src.unionByName(spark.createDataFrame([(9, t0 + dt.timedelta(days=9))], "id bigint, ts timestamp_ntz"))
    r3 = run_job(spark, [spec], {"s": more}, {"t": target}, None, tpl.LOAD_TS, state_path=state, batch_id="3")
    assert (r1[0]["clean_rows"], r2[0]["clean_rows"], r3[0]["clean_rows"]) == (5, 0, 1)
    assert spark.read.parquet(target).count() == 6
    assert r3[0]["watermark"] == "2024-01-10 00:00:00"


def test_incremental_run_job_replay_safe(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    src = spark.createDataFrame([(i, t0 + dt.timedelta(days=i)) for i in range(4)], "id bigint, ts timestamp_ntz")
    spec = TargetSpec(name="t", source="s", columns={"id": "id", "ts": "ts"}, load_mode="incremental",
                      watermark_column="ts", rules=[])
    target = scratch_path(spark, "inc_replay")
    run_job(spark, [spec], {"s": src}, {"t": target}, None, tpl.LOAD_TS, state_path=scratch_path(spark, "s1"))
    run_job(spark, [spec], {"s": src}, {"t": target}, None, tpl.LOAD_TS, state_path=scratch_path(spark, "s2"))
    assert spark.read.parquet(target).count() == 4


def test_guide_headers_flags_and_expected_count(spark):
    from vaultline.metadata import canonical_name
    tgt = spark.createDataFrame(
        [("dw", "s", "cust", "cid", "BIGINT", "c_custkey", "Y", "business key", "not null")],
        ["Target System", "Target Schema", "Target Table Name", "Target Column Name", "Target Data Type",
         "Transformation Logic", "Partition Key?", "Hash Key or Business Key?", "Validations"])
    n = normalize(tgt, "target_columns").first()
    assert (n["table_name"], n["column_name"], n["partition_key"], n["key_kind"]) == ("cust", "cid", True, "business key")
    assert canonical_name("  Load Order / Priority ") == "load_order"
    maps = [dict(rule_id="1", target_table="cust", source_table="customer")]
    dq = [dict(table_name="cust", column_name="cid", rule="range(0, 10)", reject_handling="discard",
               record_count_expected=10)]
    spec = specs_from_metadata(normalize(tgt, "target_columns"), maps, None, dq)[0]
    assert [r.kind for r in spec.rules] == ["not_null", "range"] and spec.expected_count == 10
    assert spec.partition_cols == ["cid"]


def test_join_cell_spellings():
    from vaultline.plans.jobs import _join_of
    assert _join_of("LEFT OUTER JOIN customer ON o_custkey = c_custkey", "orders") == \
        ("customer", "o_custkey = c_custkey", "left")
    assert _join_of("join customer on a = b", "orders") == ("customer", "a = b", "inner")
    assert _join_of("orders.o_custkey = customer.c_custkey", "orders") == \
        ("customer", "orders.o_custkey = customer.c_custkey", "inner")
    with pytest.raises(ValueError):
        _join_of("a = b", "orders")


def test_bare_lookup_table_from_sheet(spark):
    tcols = [dict(table_name="cust", column_name="cid", transformation="c_custkey"),
             dict(table_name="cust", column_name="nation", transformation="n_name")]
    maps = [dict(rule_id="1", target_table="cust", source_table="customer", lookup_table="nation",
                 join_condition="customer.c_nationkey = nation.n_nationkey")]
    spec = specs_from_metadata(tcols, maps)[0]
    assert spec.joins == [] and spec.lookups[0].on == [("c_nationkey", "n_nationkey")]
    srcs = tpl.sources(spark, SF001)
    out = build_target(spec, srcs)
    assert out.count() == srcs["customer"].count()            # a lookup never fans out
    assert out.filter("nation IS NULL").count() == 0


def test_declared_lengths_and_string_only_length_rules(spark):
    tcols = [dict(table_name="t", column_name="name", data_type="VARCHAR(5)", transformation="name"),
             dict(table_name="t", column_name="code", data_type="VARCHAR(3)", transformation="code",
                  rule="max_length(2)"),
             dict(table_name="t", column_name="qty", data_type="INTEGER", transformation="qty", rule="max_length(2)")]
    spec = specs_from_metadata(tcols, [dict(rule_id="1", target_table="t", source_table="s")])[0]
    by_col = {(r.column, r.kind): r for r in spec.rules}
    assert by_col[("name", "max_length")].args == (5,)                 # implied by VARCHAR(5)
    assert by_col[("code", "max_length")].args == (2,)                 # explicit rule wins
    assert by_col[("qty", "max_length")].status == "malformed"         # not a string column
    src = spark.createDataFrame([("abcdef", "ab", 123), ("abc", "abc", 1)], "name string, code string, qty int")
    s = checked_target(spec, {"s": src})
    assert s.clean.count() == 0 and s.quarantine.count() == 2


def test_dq_suite_from_sheet(spark):
    from vaultline.plans.jobs import dq_suite
    df = spark.createDataFrame([(1, "ann"), (2, None), (2, "x1")], "id int, name string")
    sheet_rows = [dict(table_name="t", column_name="id", rule="not null; unique"),
                  dict(table_name="t", column_name="name", rule="Regex(^[a-z]+$); Unsupported"),
                  dict(table_name="other", column_name="id", rule="not null")]
    report, verdict = dq_suite(df, sheet_rows, "t")
    got = {(r["column_name"], r["rule_text"]): (r["status"], r["failures"]) for r in report.collect()}
    assert got == {("id", "not null"): ("ok", 0), ("id", "unique"): ("ok", 2),
                   ("name", "Regex(^[a-z]+$)"): ("ok", 1), ("name", "Unsupported"): ("unsupported", None)}
    v = verdict.first()
    assert (v["success"], v["failed_tests"], v["failing_rows"]) == (False, 2, 3)


def test_run_job_protects_outputs(spark):
    from pyspark.sql import functions as F
    from vaultline.metadata import sheet
    src = spark.createDataFrame([(1, "Alice", "111-22"), (2, None, "333-44")], "id bigint, name string, ssn string")
    spec = TargetSpec(name="p", source="s", columns={"id": "id", "name": "name", "ssn": "ssn"},
                      rules=parse_cell("not null", "name"))
    prot = sheet(spark, "protection", [dict(table_name="p", column_name="name", pii=True, mask=True, encrypt=False),
                                       dict(table_name="p", column_name="ssn", pii=True, mask=False, encrypt=True)])
    target, q = scratch_path(spark, "prot_t"), scratch_path(spark, "prot_q")
    run_job(spark, [spec], {"s": src}, {"p": target}, q, tpl.LOAD_TS, protection=prot, key=F.lit("0123456789abcdef"))
    row = spark.read.parquet(target).first()
    assert row["name"] == "Xxxxx" and row["ssn"] not in ("111-22", None)
    qjson = spark.read.parquet(q).first()["row_json"]
    assert "333-44" not in qjson                     # no clear PII in the quarantine store


def test_read_sheet_from_csv(spark):
    from vaultline.metadata import read_sheet
    path = scratch_path(spark, "sheet")
    spark.createDataFrame([("crm", "customers", "customer_id", "INTEGER", "Y"), ("crm", "customers", "name", "VARCHAR(20)", "N")],
                          ["Source System Name", "Source Table Name", "Source Column Name", "Data Type", "Primary Key?"]
                          ).coalesce(1).write.option("header", "true").csv(path)
    got = read_sheet(spark, path, "source_columns")
    assert rows(got, "column_name", "primary_key") == [("customer_id", True), ("name", False)]


def test_bad_numeric_cell_reads_as_unspecified(spark):
    df = spark.createDataFrame([("t", "c", "high")], ["Target Table Name", "Target Column Name", "Load Order / Priority"])
    assert normalize(df, "target_columns").first()["load_order"] is None


GUIDE_T = [dict(table_name="t", column_name=c, transformation=e, rule=r) for c, e, r in
           (("id", "", "not null; unique"), ("one", "1", ""), ("name", "c_name", ""))]
JOIN = "c ON o.cust = c.cid"


def _guide_sources(spark):
    return {"o": spark.createDataFrame([(1, 10, "x"), (2, 11, None), (3, 12, "z")], "oid bigint, cust int, note string"),
            "c": spark.createDataFrame([(10, "ann", 5), (11, "bob", 50), (12, "cy", 70)], "cid int, c_name string, bal int")}


def test_guide_sheet_rows_without_target_table(spark):
    maps = [dict(rule_id="1", source_table="o", expression="id = oid", join_condition=JOIN),
            dict(rule_id="2", source_table="o", filter_condition="c.bal > 10", join_condition=JOIN)]
    spec, = specs_from_metadata(GUIDE_T, maps)
    assert len(spec.joins) == 1 and spec.columns["id"] == "oid"
    got = build_target(spec, _guide_sources(spark)).collect()
    assert sorted((r["id"], r["one"], r["name"]) for r in got) == [(2, 1, "bob"), (3, 1, "cy")]
    two = GUIDE_T + [dict(table_name="u", column_name="x", transformation="oid")]
    with pytest.raises(ValueError):
        specs_from_metadata(two, [dict(rule_id="9", source_table="o", filter_condition="oid > 1")])
    assert [s.columns["id"] for s in specs_from_metadata(two, maps[:1]) if s.name == "t"] == ["oid"]


def test_source_defaults_error_handling_and_pattern(spark):
    cols = [dict(table_name="t", column_name="id", transformation="oid", data_type="BIGINT"),
            dict(table_name="t", column_name="note", transformation="note", rule="in('x', 'none')")]
    maps = [dict(rule_id="1", source_table="o", expression="id = oid")]
    loads = [dict(table_name="t", load_mode="full", error_handling="Drop the row", file_pattern="part*.parquet")]
    source = [dict(table_name="o", column_name="note", default_value="none", nullable=True),
              dict(table_name="o", column_name="oid", nullable=False)]
    spec, = specs_from_metadata(cols, maps, loads, source_columns=source)
    assert spec.defaults == {"note": "none"} and {r.effective_handling for r in spec.rules} == {"discard"}
    assert any(r.kind == "not_null" and r.column == "id" for r in spec.rules)
    root = scratch_path(spark, "pattern")
    _guide_sources(spark)["o"].coalesce(1).write.parquet(f"{root}/o.parquet")
    target, q = scratch_path(spark, "pat_t"), scratch_path(spark, "pat_q")
    rep, = run_job(spark, [spec], {}, {"t": target}, q, tpl.LOAD_TS, source_root=root)
    out = spark.read.parquet(target)
    assert out.columns == ["id", "note"] and sorted(map(tuple, out.collect())) == [(1, "x"), (2, "none")]
    assert rep["quarantined"] == 0 and rep["rule_problems"] == []


def test_job_reports_rules_that_cannot_run(spark):
    src = {"s": spark.createDataFrame([(1, 2)], "id int, v int")}
    spec = TargetSpec(name="t", source="s", columns={"id": "id", "v": "v"}, rules=parse_cell("rnge(0, 5)", "v"))
    target = scratch_path(spark, "bad_t")
    rep, = run_job(spark, [spec], src, {"t": target}, None, tpl.LOAD_TS)
    assert rep["rule_problems"][0]["rule"] == "rnge(0, 5)" and spark.read.parquet(target).columns == ["id", "v"]
    spec.rules = parse_cell("rnge(0, 5)", "v", handling="fail_job")
    with pytest.raises(Exception, match="cannot run"):
        run_job(spark, [spec], src, {"t": scratch_path(spark, "bad_u")}, None, tpl.LOAD_TS)


def test_incremental_job_edges_and_keys(spark):
    """NULL watermarks, late ties, a key that an earlier batch holds, stale rejects."""
    def src(*r):
        return {"s": spark.createDataFrame(list(r), "id int, day int, v int")}
    spec = TargetSpec(name="t", source="s", columns={"id": "id", "v": "v"}, load_mode="incremental", watermark_column="day",
                      rules=parse_cell("unique", "id") + parse_cell("not null", "v"))
    target, q, state = (scratch_path(spark, f"edge_{x}") for x in "tqs")

    def go(*r):
        return run_job(spark, [spec], src(*r), {"t": target}, q, tpl.LOAD_TS, state_path=state)[0]
    one = [(1, 1, 1), (2, 2, 2), (3, None, 3), (4, 2, None)]
    rep = go(*one)
    assert (rep["clean_rows"], rep["quarantined"], rep["null_watermarks"]) == (3, 1, 1)
    late = [*one, (5, 2, 5), (6, None, 6), (1, 9, 1)]
    rep = go(*late)
    assert (rep["clean_rows"], rep["quarantined"]) == (2, 1)      # id 1 is there already
    assert "skipped" in go(*late)
    assert sorted(r["id"] for r in spark.read.parquet(target).collect()) == [1, 2, 3, 5, 6]


def test_full_reload_drops_stale_partitions(spark):
    spec = TargetSpec(name="t", source="s", columns={"id": "id", "p": "p"}, partition_cols=["p"], rules=parse_cell("not null", "id"))
    target, q = scratch_path(spark, "stale_t"), scratch_path(spark, "stale_q")

    def go(*r):
        run_job(spark, [spec], {"s": spark.createDataFrame(list(r), "id int, p string")}, {"t": target}, q, tpl.LOAD_TS)
    go((1, "007"), (2, "b"), (None, "b"))
    assert spark.read.parquet(q).count() == 1
    go((1, "007"))
    from vaultline.sources.writers import read_partitioned
    assert [tuple(r) for r in read_partitioned(spark, target, "id int, p string").collect()] == [(1, "007")]
    assert spark.read.parquet(q).count() == 0                     # the rerun had no rejects
