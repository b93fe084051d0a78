"""Aggregation rules (D1) and the record-count check."""

from vaultline.operators.aggregate import aggregate_rule, parse_aggregation, record_count_check
from tests.conftest import rows


def test_parse_aggregation_rule_cells():
    groups, aggs = parse_aggregation("SUM(x) AS total, MAX(coalesce(y, 0)) AS top GROUP BY a, b")
    assert groups == ["a", "b"] and aggs == {"total": "SUM(x)", "top": "MAX(coalesce(y, 0))"}
    groups, aggs = parse_aggregation("count(*) as n")
    assert groups == [] and aggs == {"n": "count(*)"}
    groups, aggs = parse_aggregation("SUM(x) group by k")
    assert groups == ["k"] and aggs == {"SUM(x)": "SUM(x)"}


def test_aggregate_rule_and_record_count(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 5)], "k string, v int")
    assert rows(aggregate_rule(df, "SUM(v) AS s, COUNT(*) AS n GROUP BY k")) == [("a", 3, 2), ("b", 5, 1)]
    r = record_count_check(df, "t", 3).first()
    assert (r["record_count"], r["status"]) == (3, "failed")          # valid only when count > expected
    assert record_count_check(df, "t", None).first()["status"] == "skipped"
    assert record_count_check(df.limit(0), "t", 0).first()["status"] == "failed"
