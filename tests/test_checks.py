"""Row rules on hand-made rows: pass, fail, NULL, empty, blank, both range
ends and just outside them, values differing only in case."""

from pyspark.sql import functions as F

from vaultline.functions import checks


def failing_ids(spark, rows, schema, pred):
    df = spark.createDataFrame(rows, schema)
    return sorted(r[0] for r in df.filter(pred).select("id").collect())


def test_not_null(spark):
    rows = [(1, "a"), (2, None), (3, ""), (4, " ")]
    assert failing_ids(spark, rows, "id int, v string", checks.not_null("v")) == [2]


def test_range_inclusive_and_null_passes(spark):
    rows = [(1, 1), (2, 10), (3, 0), (4, 11), (5, None), (6, 5)]
    assert failing_ids(spark, rows, "id int, v int", checks.in_range("v", 1, 10)) == [3, 4]
    assert failing_ids(spark, rows, "id int, v int", checks.in_range("v", None, 5)) == [2, 4]


def test_accepted_values_case_sensitive(spark):
    rows = [(1, "A"), (2, "a"), (3, None), (4, "B")]
    assert failing_ids(spark, rows, "id int, v string", checks.accepted("v", ["A", "B"])) == [2]


def test_regex_search_semantics(spark):
    rows = [(1, "abc"), (2, "ABC"), (3, None), (4, "ab1"), (5, "")]
    assert failing_ids(spark, rows, "id int, v string", checks.matches("v", "^[a-z]+$")) == [2, 4, 5]
    # unanchored pattern: a search, not a full match
    assert failing_ids(spark, rows, "id int, v string", checks.matches("v", "b")) == [2, 5]


def test_lengths(spark):
    rows = [(1, "ab"), (2, "abcd"), (3, None), (4, ""), (5, "abc")]
    schema = "id int, v string"
    assert failing_ids(spark, rows, schema, checks.max_length("v", 3)) == [2]
    assert failing_ids(spark, rows, schema, checks.min_length("v", 3)) == [1, 4]
    assert failing_ids(spark, rows, schema, checks.length_between("v", 2, 3)) == [2, 4]


def test_expression_null_passes(spark):
    rows = [(1, 5), (2, -1), (3, None)]
    assert failing_ids(spark, rows, "id int, v int", checks.is_true("v >= 0")) == [2]


def test_blank_and_hash_key_format(spark):
    rows = [(1, "x"), (2, None), (3, ""), (4, "   ")]
    assert failing_ids(spark, rows, "id int, v string", checks.blank("v")) == [2, 3, 4]
    good = "0123456789ABCDEF0123456789ABCDEF"
    keys = [(1, good), (2, good.lower()), (3, good[:-1]), (4, None), (5, good[:-1] + "G")]
    assert failing_ids(spark, keys, "id int, v string", checks.hash_key_format("v")) == [2, 3, 4, 5]


def test_any_null(spark):
    rows = [(1, 1, 1), (2, None, 1), (3, 1, None)]
    assert failing_ids(spark, rows, "id int, a int, b int", checks.any_null(["a", "b"])) == [2, 3]


def test_empty_table(spark):
    df = spark.createDataFrame([], "id int, v int")
    assert df.filter(checks.in_range("v", 0, 1)).count() == 0
    assert df.agg(F.count_if(checks.not_null("v"))).first()[0] == 0
