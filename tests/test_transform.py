"""Projection, filter and scalar transforms (B1-B9) on hand-made rows."""

import pytest

from vaultline.operators import transform
from tests.conftest import rows


def test_map_columns_names_and_expressions(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    out = transform.map_columns(df, {"key": "id", "label": "upper(name)"})
    assert out.columns == ["key", "label"] and rows(out) == [(1, "A"), (2, "B")]


def test_cleanse_every_string_column(spark):
    df = spark.createDataFrame([(1, " x ", "  "), (2, "", "y")], "id int, a string, b string")
    assert rows(transform.cleanse_strings(df)) == [(1, "x", None), (2, None, "y")]


def test_fill_default_keeps_the_column_type(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "id int, qty int")
    out = transform.fill_default(df, {"qty": "0"})
    assert dict(out.dtypes)["qty"] == "int" and rows(out) == [(1, 0), (2, 5)]


def test_bad_rule_text_names_the_rule(spark):
    df = spark.createDataFrame([(1,)], "id int")
    with pytest.raises(ValueError, match="rule 'r7'"):
        transform.derive_column(df, "x", "no_such_column + 1", rule_id="r7")
    with pytest.raises(ValueError, match="rule 'r8'"):
        transform.filter_rows(df, "id >", rule_id="r8")
    assert transform.filter_rows(df, None).count() == 1 and transform.filter_rows(df, "  ").count() == 1


def test_require_keys_and_audit_columns(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (2, None)], "k int, j string")
    assert rows(transform.require_keys(df, ["k", "j"])) == [(1, "a")]
    out = transform.audit_columns(df, "2024-01-01 00:00:00", "crm")
    assert dict(out.dtypes)["load_datetime"] == "timestamp_ntz" and out.select("record_source").distinct().count() == 1
