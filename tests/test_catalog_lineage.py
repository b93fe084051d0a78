"""Key detection, relationships, lineage tables and documents."""

import json

from pyspark.sql import functions as F

from vaultline.metadata import sheet
from vaultline.operators import catalog, lineage
from tests.conftest import rows


def cat(spark, names):
    return spark.createDataFrame([("t", n, "string", i) for i, n in enumerate(names)],
                                 "table_name string, column_name string, data_type string, ordinal int")


def test_key_names_words_vs_literal(spark):
    names = ["customer_id", "c_custkey", "paid", "valid", "update_id", "zip_code", "customerId", "width", "amount"]
    words = {r["column_name"] for r in catalog.key_candidates(cat(spark, names)).collect()}
    literal = {r["column_name"] for r in catalog.key_candidates(cat(spark, names), mode="literal").collect()}
    assert words == {"customer_id", "c_custkey", "update_id", "zip_code", "customerId"}
    assert literal == {"customer_id", "c_custkey", "paid", "valid", "zip_code", "customerId", "width"}


def test_profile_keys(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", 1), (3, "b", 2)], "id int, s string, n int")
    got = {r["column_name"]: (r["rows"], r["nulls"], r["distinct_values"], r["is_unique"])
           for r in catalog.profile_keys(df, "t").collect()}
    assert got == {"id": (3, 0, 3, True), "s": (3, 0, 2, False), "n": (3, 1, 2, False)}
    approx = {r["column_name"]: r["distinct_values"] for r in catalog.profile_keys(df, "t", exact=False).collect()}
    assert approx["id"] == 3


def test_satellite_groups(spark):
    c = cat(spark, ["id", "b", "a"]).withColumn("is_key", F.col("column_name") == "id")
    assert [tuple(r) for r in catalog.satellite_groups(c).collect()] == [("t", ["a", "b"])]


def test_relationships_from_join_conditions(spark):
    m = sheet(spark, "mappings", [dict(rule_id="1", join_condition="orders.o_custkey = customer.c_custkey AND "
                                                                  "orders.o_x = region.r_x"),
                                  dict(rule_id="2", join_condition=None)])
    got = rows(catalog.relationships(m), "rule_id", "left_table", "left_column", "right_table", "right_column")
    assert got == [("1", "orders", "o_custkey", "customer", "c_custkey"), ("1", "orders", "o_x", "region", "r_x")]


def test_lineage_literal_mode_reproduces_original_naming(spark):
    m = sheet(spark, "mappings", [dict(rule_id="0", expression="customer_id = c_custkey"),
                                  dict(rule_id="1", expression="order_id = o_orderkey"),
                                  dict(rule_id="2", expression="total = a + b")])
    e = lineage.edges(m, mode="literal")
    assert e.filter("NOT matched").count() == 1
    e = e.filter("matched")
    assert rows(e, "source", "target") == [("c.c_custkey", "customer.customer"), ("o.o_orderkey", "order.order")]
    n = lineage.nodes(e)
    assert n.count() == 4


def test_lineage_full_mode_keeps_names_and_reports_unmatched(spark):
    m = sheet(spark, "mappings", [dict(rule_id="0", target_table="customer", source_table="customer",
                                       expression="customer_id = c_custkey"),
                                  dict(rule_id="1", expression="dim.order_id = orders.o_orderkey"),
                                  dict(rule_id="2", expression="total = a + b")])
    e = lineage.edges(m, include_unmatched=True)
    got = rows(e, "edge_id", "source", "target", "matched")
    assert got == [("edge_0", "customer.c_custkey", "customer.customer_id", True),
                   ("edge_1", "orders.o_orderkey", "dim.order_id", True),
                   ("edge_2", None, None, False)]


def test_lineage_document_shape(spark):
    m = sheet(spark, "mappings", [dict(rule_id="0", target_table="t", source_table="s", expression="target_id = source_id")])
    e = lineage.edges(m)
    docs = lineage.document(lineage.nodes(e), e, per_target_table=False).collect()
    assert len(docs) == 1
    d = json.loads(docs[0]["lineage_json"])
    assert set(d) == {"codeGraph", "sourceProperties", "targetProperties", "script"}
    assert len(d["codeGraph"]["nodes"]) == 2 and len(d["codeGraph"]["edges"]) == 1
    assert d["codeGraph"]["edges"][0]["source"] == "s.source_id"
    parents = sorted(n["parent"]["id"] for n in d["codeGraph"]["nodes"])
    assert parents == ["s", "t"]
    per_table = lineage.document(lineage.nodes(e), e).collect()
    assert [r["target_table"] for r in per_table] == ["t"]
    assert json.loads(per_table[0]["lineage_json"]) == d


def test_find_keys_is_exact(spark):
    from tests.conftest import SF01
    c = spark.read.parquet(f"{SF01}/customer.parquet")
    got = {r["column_name"]: r for r in catalog.find_keys(c, "customer").collect()}
    assert got["c_custkey"]["is_unique"] and not got["c_mktsegment"]["is_unique"]
    assert got["c_nationkey"]["distinct_values"] == c.select("c_nationkey").distinct().count()
    nulls = spark.createDataFrame([(1, None), (2, None), (3, 4)], "a int, b int")
    rows_ = {r["column_name"]: (r["rows"], r["nulls"], r["distinct_values"], r["is_unique"])
             for r in catalog.profile_keys(nulls, "t").collect()}
    assert rows_ == {"a": (3, 0, 3, True), "b": (3, 2, 1, False)}
    # An estimate decides nothing.
    assert {r["is_unique"] for r in catalog.profile_keys(nulls, "t", exact=False).collect()} == {None}


def test_one_key_name_rule(spark):
    """The driver's form of the rule agrees with the Column form."""
    names = ["id", "custKey", "c_custkey", "keyed", "code_page", "paid", "width", "monkey", "orderId", "id_date", "uuid", ""]
    df = spark.createDataFrame([(n,) for n in names], "column_name string")
    got = {r[0] for r in df.filter(catalog.key_name_match()).collect()}
    assert got == {n for n in names if catalog.is_key_name(n)}
