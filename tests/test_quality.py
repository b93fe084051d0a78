"""Marking, splitting and summarising DQ rules on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vaultline.operators import quality
from vaultline.plans.rules import Rule, parse_cell
from tests.conftest import rows

DATA = [(1, "ann", 5, "A"), (2, None, 5, "B"), (3, "bob", 50, "A"), (4, "cy", -1, "C"), (4, "dee", 3, "A"),
        (5, "", None, None)]
SCHEMA = "id int, name string, qty int, seg string"


def rules():
    return (parse_cell("not null", "name", handling="quarantine")
            + parse_cell("range(0, 10)", "qty", handling="discard")
            + parse_cell("in('A', 'B')", "seg", handling="log")
            + parse_cell("unique", "id", handling="quarantine"))


def test_mark_failures(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    m = quality.mark_failures(df, rules())
    got = {(r["id"], r["name"]): sorted(r["failed_rules"]) for r in m.collect()}
    assert got[(1, "ann")] == []
    assert got[(2, None)] == ["not_null:name"]
    assert got[(3, "bob")] == ["range:qty"]
    assert got[(4, "cy")] == ["accepted_values:seg", "range:qty", "unique:id"]
    assert got[(4, "dee")] == ["unique:id"]
    assert got[(5, "")] == []                  # NULL passes range and in(); '' is not NULL


def test_split_partitions_the_input(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    s = quality.apply_rules(df, rules())
    ids = lambda d: sorted((r["id"], r["name"]) for r in d.collect())
    assert ids(s.quarantine) == [(2, None), (4, "cy"), (4, "dee")]   # quarantine beats discard
    assert ids(s.discarded) == [(3, "bob")]
    assert ids(s.clean) == [(1, "ann"), (5, "")]
    assert s.clean.count() + s.quarantine.count() + s.discarded.count() + s.failing.count() == df.count()


def test_severity_warn_acts_as_log_and_fail_job_raises(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    warn = parse_cell("range(0, 10)", "qty", handling="quarantine", severity="warn")
    s = quality.apply_rules(df, warn)
    assert s.clean.count() == df.count()
    fail = parse_cell("not null", "name", handling="fail_job")
    with pytest.raises(quality.DataQualityError):
        quality.enforce_fail_rules(quality.apply_rules(df, fail), "t")
    quality.enforce_fail_rules(quality.apply_rules(df.filter("name IS NOT NULL"), fail), "t")


def test_summary_one_pass_and_keyed(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    got = dict(rows(quality.summarize(df, rules())))
    assert got == {"not_null:name": 1, "range:qty": 2, "accepted_values:seg": 1, "unique:id": 2}


def test_unsupported_rules_reported_not_dropped(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    rs = parse_cell("not null; Unsupported; range(1)", "name")
    rep = {r["rule_text"]: (r["status"], r["failures"]) for r in quality.rule_report(df, rs).collect()}
    assert rep == {"not null": ("ok", 1), "Unsupported": ("unsupported", None), "range(1)": ("malformed", None)}


def test_unique_combination_keeps_null_groups(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2), (2, 2)], "a int, b int")
    assert rows(quality.duplicate_combinations(df, ["a", "b"])) == [(1, None, 2)]
    assert quality.duplicates(df, "b").count() == 2


def test_chronology_finds_equal_load_times(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, t), (1, t), (1, t + dt.timedelta(1)), (2, t)], "k int, ts timestamp_ntz")
    got = quality.chronology_failures(df, "k", "ts")
    assert rows(got, "k", "ts", "prev_ts") == [(1, t, t)]


def test_relationships_rule(spark):
    child = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id int, fk int")
    parent = spark.createDataFrame([(10,)], "pk int")
    r = Rule(column="fk", kind="relationships", args=("parent", "pk"))
    m = quality.mark_failures(child, [r], parents={"parent": parent})
    assert rows(m.filter(F.size("failed_rules") > 0), "id") == [(2,)]


def test_record_source_not_in_with_null_in_list(spark):
    df = spark.createDataFrame([(1, "crm"), (2, "erp"), (3, " "), (4, None)], "id int, rs string")
    known = spark.createDataFrame([("crm",)], "record_source string")
    assert rows(quality.record_source_failures(df, "rs", known), "id") == [(2,), (3,), (4,)]
    with_null = spark.createDataFrame([("crm",), (None,)], "record_source string")
    # NOT IN a list holding NULL is never true: only NULL/blank fail
    assert rows(quality.record_source_failures(df, "rs", with_null), "id") == [(3,), (4,)]


def test_audit_failures(spark):
    df = spark.createDataFrame([(None, "x"), (dt.datetime(2024, 1, 1), " ")], "load_datetime timestamp_ntz, record_source string")
    assert dict(rows(quality.audit_failures(df))) == {"load_datetime_not_null": 1, "record_source_not_null": 1}


def test_quarantine_rows_uniform_schema(spark):
    a = quality.mark_failures(spark.createDataFrame([(1, None)], "id int, v string"), parse_cell("not null", "v"))
    b = quality.mark_failures(spark.createDataFrame([(7.5,)], "x double"), parse_cell("range(0, 1)", "x"))
    q = quality.collect_quarantine({"a": a, "b": b}, "2024-01-01 00:00:00")
    assert q.columns == ["table_name", "failed_rules", "row_json", "load_datetime"]
    assert rows(q, "table_name", "row_json") == [("a", '{"id":1}'), ("b", '{"x":7.5}')]


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    s = quality.apply_rules(df, rules())
    assert s.clean.count() == 0 and s.quarantine.count() == 0
    assert dict(rows(quality.summarize(df, rules()))) == {"not_null:name": 0, "range:qty": 0,
                                                            "accepted_values:seg": 0, "unique:id": 0}


def test_text_columns_are_ansi_safe(spark):
    df = spark.createDataFrame([(1, "01"), (2, "AB"), (3, "7"), (4, None)], "id int, code string")
    rs = parse_cell("in('01', '02')", "code") + parse_cell("range(1, 5)", "code", handling="log")
    got = {r["id"]: sorted(r["failed_rules"]) for r in quality.mark_failures(df, rs).collect()}
    assert got == {1: [], 2: ["accepted_values:code", "range:code"], 3: ["accepted_values:code", "range:code"], 4: []}
    assert dict(rows(quality.summarize(df, rs))) == {"accepted_values:code": 2, "range:code": 2}
    nums = spark.createDataFrame([(1, 1), (2, 3)], "id int, v int")
    m = quality.mark_failures(nums, parse_cell("in(1, 2)", "v"))
    assert rows(m.filter(F.size("failed_rules") > 0), "id") == [(2,)]


def test_rules_of_one_kind_are_told_apart(spark):
    """Two ranges and two regexes on one column: each row fails only what it breaks,
    and the action follows the rule broken."""
    df = spark.createDataFrame([(1, 20, "ab"), (2, 70, "AB"), (3, 170, "12")], "id int, v int, s string")
    rs = (parse_cell("range(0, 100)", "v", handling="quarantine") + parse_cell("range(0, 50)", "v", handling="log")
          + parse_cell("regex(^[a-z]+$)", "s", handling="log") + parse_cell("regex(^[A-Za-z]+$)", "s", handling="discard"))
    s = quality.apply_rules(df, rs)
    assert {r["id"]: (r["dq_action"], len(r["failed_rules"])) for r in s.marked.collect()} == {
        1: ("pass", 0), 2: ("log", 2), 3: ("quarantine", 4)}
    report = quality.rule_report(df, rs).collect()
    assert sorted((r["rule_text"], r["failures"]) for r in report) == [
        ("range(0, 100)", 1), ("range(0, 50)", 2), ("regex(^[A-Za-z]+$)", 1), ("regex(^[a-z]+$)", 2)]
    twice = parse_cell("range(0, 100); range(0, 100)", "v")
    assert [r["failures"] for r in quality.rule_report(df, twice).collect()] == [1, 1]


def test_rules_that_cannot_run_are_not_success(spark):
    df = spark.createDataFrame([(1, 2)], "id int, v int")
    rs = parse_cell("rnge(0, 5); not null", "v")
    verdict = quality.suite_verdict(quality.rule_report(df, rs)).first()
    assert not verdict["success"] and verdict["failed_tests"] == 0
    assert quality.enforce_runnable(rs)[0]["rule"] == "rnge(0, 5)"
    with pytest.raises(quality.DataQualityError):
        quality.enforce_runnable(parse_cell("rnge(0, 5)", "v", handling="fail_job"))
