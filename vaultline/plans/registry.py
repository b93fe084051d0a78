"""Registered queries: one per operator of the inventory, each a Spark
DataFrame over the given tables plus (where SQL can express it) the same
result as DuckDB SQL over the same parquet files.

Every query reads whole tables; fixed values below are cut-offs and load
times, never row subsets.
"""

from __future__ import annotations

import secrets
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.functions import checks
from vaultline.functions.hashing import NULL_SENTINEL, surrogate_key
from vaultline.operators import aggregate as agg
from vaultline.operators import catalog, incremental, joins, lineage, ordered, protect, quality, transform, vault
from vaultline.plans import template as tpl
from vaultline.metadata import normalize
from vaultline.plans.jobs import checked_target, run_job, specs_from_metadata
from vaultline.plans.rules import Rule, rules_from_rows
from vaultline.operators.transform import require_keys
from vaultline.session import scratch_path
from vaultline.sources import readers, writers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# SQL helpers: the same hash text rules as vaultline.functions.hashing.
def sk(*exprs: str) -> str:
    parts = ", ".join(f"coalesce(CAST({e} AS VARCHAR), '{NULL_SENTINEL}')" for e in exprs)
    return f"upper(md5(concat_ws('-', {parts})))"


def hd(*exprs: str) -> str:
    """The framed hash of ``hash_diff``."""
    parts = ", ".join(f"coalesce(length(CAST({e} AS VARCHAR)) || ':' || CAST({e} AS VARCHAR), '~')" for e in exprs)
    return f"upper(md5(concat_ws('|', {parts})))"


TS1 = f"TIMESTAMP '{tpl.LOAD_TS}'"
TS2 = f"TIMESTAMP '{tpl.LOAD_TS2}'"


def _lit_ts(v: str):
    return F.lit(v).cast("timestamp_ntz")


# ====================================================================== A: sources and sinks

@query("scan_csv", "SELECT * FROM customer")
def q_scan_csv(spark, sf):
    src = _t(spark, sf, "customer")
    path = scratch_path(spark, "csv_customer")
    src.write.option("header", "true").csv(path)
    return readers.scan_csv(spark, path, schema=src.schema)


@query("scan_table", "SELECT * FROM orders")
def q_scan_table(spark, sf):
    return readers.scan_table(spark, f"{sf}/orders.parquet")


@query("scan_glob", "SELECT * FROM supplier")
def q_scan_glob(spark, sf):
    return readers.scan_glob(spark, sf, "supp*.parquet")


@query("sink_overwrite", "SELECT c_custkey AS customer_id, c_name AS customer_name FROM customer")
def q_sink_overwrite(spark, sf):
    out = transform.map_columns(_t(spark, sf, "customer"), {"customer_id": "c_custkey", "customer_name": "c_name"})
    path = scratch_path(spark, "sink_overwrite")
    writers.write_overwrite(out, path)
    writers.write_overwrite(out, path)          # second run replaces, not doubles
    return spark.read.parquet(path)


@query("sink_append", "SELECT * FROM orders")
def q_sink_append(spark, sf):
    o = _t(spark, sf, "orders")
    path = scratch_path(spark, "sink_append")
    writers.write_append(o.filter(F.col("o_orderdate") < _lit_ts("1998-01-01 00:00:00")), path)
    writers.write_append(o.filter(~(F.col("o_orderdate") < _lit_ts("1998-01-01 00:00:00"))), path)
    return spark.read.parquet(path)


@query("sink_partitioned", "SELECT * FROM orders WHERE o_orderstatus = 'F'")
def q_sink_partitioned(spark, sf):
    path = scratch_path(spark, "sink_partitioned")
    orders = _t(spark, sf, "orders")
    writers.write_partitioned(orders, path, ["o_orderstatus"])
    return writers.read_partitioned(spark, path, orders.schema).filter(F.col("o_orderstatus") == "F")


@query("dq_store_failures", """
SELECT 'customer' AS table_name, 'range:c_acctbal' AS rule, 'run-1' AS run_id,
       CAST(to_json(struct_pack(c_custkey := c_custkey, c_name := c_name)) AS VARCHAR) AS row_json
FROM customer WHERE NOT coalesce(c_acctbal >= 0 AND c_acctbal <= 9000, true)""")
def q_store_failures(spark, sf):
    c = _t(spark, sf, "customer")
    r = Rule(column="c_acctbal", kind="range", args=(0, 9000))
    failing = c.filter(quality.rule_predicate(r)).select("c_custkey", "c_name")
    path = scratch_path(spark, "failures")
    writers.store_failures(failing, path, "run-1", r.name, "customer")
    return spark.read.parquet(path)


# ====================================================================== B: projection, filter, scalar

@query("map_columns", "SELECT c_custkey AS customer_id, c_name AS customer_name FROM customer")
def q_map_columns(spark, sf):
    return transform.map_columns(_t(spark, sf, "customer"), {"customer_id": "c_custkey", "customer_name": "c_name"})


@query("direct_mapping", "SELECT o_orderkey, o_custkey, o_orderkey AS order_id FROM orders")
def q_direct_mapping(spark, sf):
    return transform.direct_mapping(_t(spark, sf, "orders").select("o_orderkey", "o_custkey"), "order_id", "o_orderkey")


NET_PRICE = ("CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))) "
             "AS DECIMAL(38,4))")


@query("derive_column", f"SELECT l_orderkey, l_linenumber, {NET_PRICE} AS net_price FROM lineitem")
def q_derive_column(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount")
    return transform.derive_column(li, "net_price", NET_PRICE).drop("l_extendedprice", "l_discount")


@query("cast_columns", """
SELECT c_custkey, TRY_CAST(c_acctbal AS DECIMAL(5,2)) AS c_acctbal,
       (c_acctbal IS NOT NULL AND TRY_CAST(c_acctbal AS DECIMAL(5,2)) IS NULL) AS cast_failed
FROM customer""")
def q_cast_columns(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", "c_acctbal")
    out = transform.cast_columns(c, {"c_acctbal": "DECIMAL(5,2)"})
    return out.select("c_custkey", "c_acctbal", (F.size("cast_failures") > 0).alias("cast_failed"))


@query("fill_default", """
SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), 'UNKNOWN') AS segment FROM customer""")
def q_fill_default(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", F.expr("nullif(c_mktsegment, 'BUILDING')").alias("segment"))
    return transform.fill_default(c, {"segment": "UNKNOWN"})


@query("filter_rows", f"SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '{tpl.ORDER_CUTOFF}'")
def q_filter_rows(spark, sf):
    return transform.filter_rows(_t(spark, sf, "orders"), f"o_orderdate > '{tpl.ORDER_CUTOFF[:10]}'")


@query("audit_columns", f"""
SELECT c_custkey, {TS1} AS load_datetime, 'tpch' AS record_source FROM customer""")
def q_audit_columns(spark, sf):
    return transform.audit_columns(_t(spark, sf, "customer").select("c_custkey"), tpl.LOAD_TS, tpl.RECORD_SOURCE)


@query("cleanse_strings", """
SELECT c_custkey, nullif(trim(c_name), '') AS c_name, nullif(trim(c_mktsegment), '') AS c_mktsegment
FROM customer""")
def q_cleanse_strings(spark, sf):
    return transform.cleanse_strings(_t(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"))


# ====================================================================== C: joins

@query("join_inner", """
SELECT o_orderkey, o_custkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey""")
def q_join_inner(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = _t(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return joins.join_inner(o, c, [("o_custkey", "c_custkey")]).drop("c_custkey")


@query("join_lookup", """
SELECT o_orderkey, o_custkey, l.v.c_name AS c_name, l.v.c_mktsegment AS c_mktsegment
FROM orders LEFT JOIN (
  SELECT c_custkey, min(struct_pack(c_name := c_name, c_mktsegment := c_mktsegment)) AS v
  FROM customer GROUP BY c_custkey) l ON o_custkey = l.c_custkey""")
def q_join_lookup(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return joins.join_lookup(o, _t(spark, sf, "customer"), [("o_custkey", "c_custkey")], ["c_name", "c_mktsegment"])


@query("anti_not_in", """
SELECT c_custkey, c_nationkey FROM customer
WHERE c_nationkey NOT IN (SELECT CASE WHEN s_acctbal > 5000 THEN s_nationkey ELSE -1 END FROM supplier)""")
def q_anti_not_in(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    # The whole list; poorer suppliers' nations are replaced, so that some are missing.
    s = _t(spark, sf, "supplier").select(F.when(F.col("s_acctbal") > 5000, F.col("s_nationkey")).otherwise(-1).alias("s_nationkey"))
    return joins.anti_not_in(c, "c_nationkey", s, "s_nationkey")


@query("dq_relationships", """
SELECT o_orderkey, o_custkey FROM orders o
WHERE o_custkey IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM customer c WHERE CASE WHEN c.c_mktsegment <> 'BUILDING' THEN c.c_custkey ELSE -1 END = o.o_custkey)""")
def q_relationships_check(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    # The whole parent table; one segment's keys are replaced, so that there are orphans.
    parent = _t(spark, sf, "customer").select(
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey")).otherwise(-1).alias("c_custkey"))
    return joins.orphans(o, "o_custkey", parent, "c_custkey")


# ====================================================================== D: aggregation

AGG_RULE = ("CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS sum_qty, "
            "MAX(l_extendedprice) AS max_price, COUNT(*) AS n_lines GROUP BY l_returnflag, l_linestatus")


@query("aggregate_rule", f"""
SELECT l_returnflag, l_linestatus, {AGG_RULE.split(' GROUP BY ')[0]}
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def q_aggregate_rule(spark, sf):
    return agg.aggregate_rule(_t(spark, sf, "lineitem"), AGG_RULE)


@query("distinct_keys", "SELECT DISTINCT o_custkey FROM orders")
def q_distinct_keys(spark, sf):
    return agg.distinct_keys(_t(spark, sf, "orders"), ["o_custkey"])


def _summary_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS test_name, CAST(count_if({cond}) AS BIGINT) AS failures FROM s" for n, cond, _ in tpl.CUSTOMER_RULES_SQL)


@query("dq_summary", f"WITH s AS ({tpl.CUSTOMER_STAGE_SQL}) {_summary_sql()}")
def q_dq_summary(spark, sf):
    rules = rules_from_rows(tpl.CUSTOMER_RULE_ROWS)
    return quality.summarize(tpl.customer_stage(spark, sf), rules)


@query("dq_suite_verdict", f"""
WITH s AS ({tpl.CUSTOMER_STAGE_SQL}), t AS ({_summary_sql()})
SELECT coalesce(max(failures), 0) = 0 AS success, CAST(count_if(failures > 0) AS BIGINT) AS failed_tests,
       CAST(coalesce(sum(failures), 0) AS BIGINT) AS failing_rows FROM t""")
def q_suite_verdict(spark, sf):
    """The verdict of the whole customer rule suite."""
    rules = rules_from_rows(tpl.CUSTOMER_RULE_ROWS)
    return quality.suite_verdict(quality.summarize(tpl.customer_stage(spark, sf), rules))


@query("dq_record_count", f"""
SELECT 'orders' AS table_name, count(*) AS record_count, CAST(0 AS BIGINT) AS expected,
       CASE WHEN count(*) > 0 THEN 'passed' ELSE 'failed' END AS status
FROM orders""")
def q_record_count(spark, sf):
    return agg.record_count_check(_t(spark, sf, "orders"), "orders", 0)


# ====================================================================== W: current row per key

@query("sat_current", """
SELECT user_id, event_type, ts, event_id FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def q_sat_current(spark, sf):
    e = _t(spark, sf, "events").select("user_id", "event_type", "ts", "event_id")
    return ordered.current_rows(e, "user_id", ["ts", "event_id"])


# ====================================================================== Q: rules (failing rows)

@query("dq_not_null", f"SELECT c_custkey, segment FROM ({tpl.CUSTOMER_STAGE_SQL}) WHERE segment IS NULL")
def q_not_null(spark, sf):
    s = tpl.customer_stage(spark, sf).select("c_custkey", "segment")
    return s.filter(quality.rule_predicate(Rule(column="segment", kind="not_null")))


@query("dq_unique", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (
  SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey HAVING count(*) > 1)""")
def q_unique(spark, sf):
    return quality.duplicates(_t(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_custkey")


@query("dq_range", """
SELECT c_custkey, c_acctbal FROM customer WHERE NOT coalesce(c_acctbal >= 0 AND c_acctbal <= 5000, true)""")
def q_range(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return c.filter(quality.rule_predicate(Rule(column="c_acctbal", kind="range", args=(0, 5000))))


@query("dq_accepted_values", """
SELECT c_custkey, c_mktsegment FROM customer
WHERE NOT coalesce(c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD'), true)""")
def q_accepted(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return c.filter(quality.rule_predicate(
        Rule(column="c_mktsegment", kind="accepted_values", args=("BUILDING", "MACHINERY", "HOUSEHOLD"))))


@query("dq_regex", """
SELECT c_custkey, c_name FROM customer WHERE NOT coalesce(regexp_matches(c_name, '^Customer#[0-9]*[02468]$'), true)""")
def q_regex(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", "c_name")
    return c.filter(quality.rule_predicate(Rule(column="c_name", kind="regex", args=("^Customer#[0-9]*[02468]$",))))


@query("dq_max_length", "SELECT p_partkey, p_name FROM part WHERE NOT coalesce(length(p_name) <= 8, true)")
def q_max_length(spark, sf):
    p = _t(spark, sf, "part").select("p_partkey", "p_name")
    return p.filter(quality.rule_predicate(Rule(column="p_name", kind="max_length", args=(8,))))


@query("dq_min_length", "SELECT p_partkey, p_name FROM part WHERE NOT coalesce(length(p_name) >= 9, true)")
def q_min_length(spark, sf):
    p = _t(spark, sf, "part").select("p_partkey", "p_name")
    return p.filter(quality.rule_predicate(Rule(column="p_name", kind="min_length", args=(9,))))


@query("dq_length_between", """
SELECT p_partkey, p_type FROM part WHERE NOT coalesce(length(p_type) BETWEEN 10 AND 20, true)""")
def q_length_between(spark, sf):
    p = _t(spark, sf, "part").select("p_partkey", "p_type")
    return p.filter(quality.rule_predicate(Rule(column="p_type", kind="length_between", args=(10, 20))))


@query("dq_expression", """
SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE NOT coalesce(l_discount <= 0.05, true)""")
def q_expression(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount")
    return li.filter(quality.rule_predicate(Rule(column=None, kind="expression", args=("l_discount <= 0.05",))))


@query("dq_chronology", """
SELECT user_id, load_day, prev_load_day FROM (
  SELECT user_id, load_day, lag(load_day) OVER (PARTITION BY user_id ORDER BY load_day) AS prev_load_day
  FROM (SELECT user_id, date_trunc('day', ts) AS load_day FROM events))
WHERE load_day <= prev_load_day""")
def q_chronology(spark, sf):
    # Wall-clock day of a TIMESTAMP_NTZ (date_trunc would go through the session time zone).
    e = _t(spark, sf, "events").select("user_id", F.col("ts").cast("date").cast("timestamp_ntz").alias("load_day"))
    return quality.chronology_failures(e, "user_id", "load_day")


@query("dq_hash_key_format", f"""
SELECT c_custkey, candidate_key FROM (
  SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN lower({sk('c_custkey')}) ELSE {sk('c_custkey')} END
         AS candidate_key FROM customer)
WHERE candidate_key IS NULL OR length(candidate_key) <> 32 OR NOT regexp_matches(candidate_key, '^[A-F0-9]+$')""")
def q_hash_key_format(spark, sf):
    c = _t(spark, sf, "customer")
    key = surrogate_key(["c_custkey"], c.schema)
    k = c.select("c_custkey", F.when(F.col("c_mktsegment") == "BUILDING", F.lower(key)).otherwise(key)
                 .alias("candidate_key"))
    return quality.hash_key_failures(k, "candidate_key")


@query("dq_hub_integrity", """
SELECT c_custkey, business_key FROM (
  SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN '  ' ELSE c_name END AS business_key FROM customer)
WHERE business_key IS NULL OR trim(CAST(business_key AS VARCHAR)) = ''""")
def q_hub_integrity(spark, sf):
    c = _t(spark, sf, "customer")
    s = c.select("c_custkey", F.when(F.col("c_mktsegment") == "BUILDING", F.lit("  "))
                 .otherwise(F.col("c_name")).alias("business_key"))
    return quality.hub_integrity_failures(s, "business_key")


@query("dq_link_relationship", f"""
SELECT link_key, hub_order_key, hub_customer_key FROM (
  SELECT {sk('o_orderkey', 'o_custkey')} AS link_key, {sk('o_orderkey')} AS hub_order_key,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE {sk('o_custkey')} END AS hub_customer_key FROM orders)
WHERE hub_order_key IS NULL OR hub_customer_key IS NULL""")
def q_link_relationship(spark, sf):
    o = _t(spark, sf, "orders")
    s = o.schema
    lk = o.select(surrogate_key(["o_orderkey", "o_custkey"], s).alias("link_key"),
                  surrogate_key(["o_orderkey"], s).alias("hub_order_key"),
                  F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(surrogate_key(["o_custkey"], s))
                  .alias("hub_customer_key"))
    return quality.link_failures(lk, ["hub_order_key", "hub_customer_key"])


KNOWN_SOURCES = ("tpch.building", "tpch.machinery", "tpch.household")


@query("dq_record_source", f"""
SELECT c_custkey, record_source FROM (SELECT c_custkey, 'tpch.' || lower(c_mktsegment) AS record_source FROM customer)
WHERE record_source IS NULL OR trim(record_source) = ''
   OR record_source NOT IN (SELECT * FROM (VALUES {', '.join(f"('{s}')" for s in KNOWN_SOURCES)}) t(rs))""")
def q_record_source(spark, sf):
    c = _t(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit("tpch."), F.lower("c_mktsegment")).alias("record_source"))
    known = spark.createDataFrame([(s,) for s in KNOWN_SOURCES], "record_source string")
    return quality.record_source_failures(c, "record_source", known)


@query("dq_unique_combination", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def q_unique_combination(spark, sf):
    return quality.duplicate_combinations(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


REPORT_RULES = [("customer", "c_custkey", "not null; unique"), ("customer", "c_acctbal", "Range(0, 5000); Range(0, 9000)"),
                ("customer", "c_name", "Regex(^Customer#00000[0-4]); Regex([02468]$); Unsupported"),
                ("customer", "c_phone", "format(phone)"), ("customer", "c_mktsegment", "range(1)")]


RULE_REPORT_SQL = """
WITH meta(table_name, column_name, rule_text, rule_kind, status, message, test_name) AS (VALUES
  ('customer', 'c_custkey', 'not null', 'not_null', 'ok', '', 'not_null:c_custkey'),
  ('customer', 'c_custkey', 'unique', 'unique', 'ok', '', 'unique:c_custkey'),
  ('customer', 'c_acctbal', 'Range(0, 5000)', 'range', 'ok', '', 'range 5000'),
  ('customer', 'c_acctbal', 'Range(0, 9000)', 'range', 'ok', '', 'range 9000'),
  ('customer', 'c_name', 'Regex(^Customer#00000[0-4])', 'regex', 'ok', '', 'regex start'),
  ('customer', 'c_name', 'Regex([02468]$)', 'regex', 'ok', '', 'regex end'),
  ('customer', 'c_name', 'Unsupported', 'unsupported', 'unsupported', 'unsupported rule ''Unsupported''', NULL),
  ('customer', 'c_phone', 'format(phone)', 'unsupported', 'unsupported', 'unsupported rule ''format(phone)''',
   NULL),
  ('customer', 'c_mktsegment', 'range(1)', 'range', 'malformed', 'range needs two bounds', NULL)),
counts AS (
  SELECT 'not_null:c_custkey' AS test_name, count_if(c_custkey IS NULL) AS failures FROM customer
  UNION ALL SELECT 'range 5000', count_if(NOT coalesce(c_acctbal >= 0 AND c_acctbal <= 5000, true)) FROM customer
  UNION ALL SELECT 'range 9000', count_if(NOT coalesce(c_acctbal >= 0 AND c_acctbal <= 9000, true)) FROM customer
  UNION ALL SELECT 'regex start', count_if(NOT coalesce(regexp_matches(c_name, '^Customer#00000[0-4]'), true)) FROM customer
  UNION ALL SELECT 'regex end', count_if(NOT coalesce(regexp_matches(c_name, '[02468]$'), true)) FROM customer
  UNION ALL SELECT 'unique:c_custkey', CAST(coalesce(sum(n), 0) AS BIGINT) FROM (
            SELECT count(*) AS n FROM customer WHERE c_custkey IS NOT NULL GROUP BY c_custkey HAVING count(*) > 1))
SELECT meta.table_name, meta.column_name, meta.rule_text, meta.rule_kind, meta.status, meta.message,
       CAST(counts.failures AS BIGINT) AS failures
FROM meta LEFT JOIN counts ON meta.test_name = counts.test_name"""


@query("dq_rule_report", RULE_REPORT_SQL)
def q_rule_report(spark, sf):
    rules = rules_from_rows([dict(table_name=t, column_name=c, rule=r) for t, c, r in REPORT_RULES])
    return quality.rule_report(_t(spark, sf, "customer"), rules)


# ====================================================================== E: applying DQ

def _customer_split(spark, sf):
    rules = rules_from_rows(tpl.CUSTOMER_RULE_ROWS)
    return quality.apply_rules(tpl.customer_stage(spark, sf), rules)


def _failed_sql() -> str:
    items = ", ".join(f"CASE WHEN {cond} THEN '{n}' END" for n, cond, _ in tpl.CUSTOMER_RULES_SQL)
    return f"array_to_string(list_sort(list_filter([{items}], lambda x: x IS NOT NULL)), ',')"


def _action_sql() -> str:
    def any_of(h):
        conds = [c for _, c, hh in tpl.CUSTOMER_RULES_SQL if hh == h]
        return "(" + " OR ".join(conds) + ")" if conds else "false"
    return (f"CASE WHEN failed = '' THEN 'pass' WHEN {any_of('fail_job')} THEN 'fail_job' "
            f"WHEN {any_of('quarantine')} THEN 'quarantine' WHEN {any_of('discard')} THEN 'discard' ELSE 'log' END")


MARKED_SQL = f"WITH s AS ({tpl.CUSTOMER_STAGE_SQL}), m AS (SELECT *, {_failed_sql()} AS failed FROM s), " \
             f"a AS (SELECT *, {_action_sql()} AS dq_action FROM m)"


def _failed_text(df: DataFrame) -> DataFrame:
    return df.withColumn("failed", F.array_join(F.sort_array(F.col(quality.FAILED)), ","))


@query("dq_failed_rules", f"{MARKED_SQL} SELECT c_custkey, failed FROM a")
def q_failed_rules(spark, sf):
    return _failed_text(_customer_split(spark, sf).marked).select("c_custkey", "failed")


@query("dq_clean", f"{MARKED_SQL} SELECT c_custkey, c_name, segment FROM a WHERE dq_action IN ('pass', 'log')")
def q_clean(spark, sf):
    return _customer_split(spark, sf).clean.select("c_custkey", "c_name", "segment")


@query("dq_quarantine", f"{MARKED_SQL} SELECT c_custkey, c_name, failed FROM a WHERE dq_action = 'quarantine'")
def q_quarantine(spark, sf):
    return _failed_text(_customer_split(spark, sf).quarantine).select("c_custkey", "c_name", "failed")


@query("dq_log", f"{MARKED_SQL} SELECT c_custkey, failed FROM a WHERE dq_action = 'log'")
def q_log(spark, sf):
    clean = _failed_text(_customer_split(spark, sf).clean)
    return clean.filter(F.col("failed") != "").select("c_custkey", "failed")


@query("dq_discard", f"{MARKED_SQL} SELECT c_custkey, c_acctbal FROM a WHERE dq_action = 'discard'")
def q_discard(spark, sf):
    return _customer_split(spark, sf).discarded.select("c_custkey", "c_acctbal")


@query("dq_severity", f"{MARKED_SQL} SELECT c_custkey, dq_action FROM a")
def q_severity(spark, sf):
    return _customer_split(spark, sf).marked.select("c_custkey", "dq_action")


@query("dq_quarantine_all", f"""
{MARKED_SQL},
oq AS (SELECT o_orderkey, o_totalprice FROM orders WHERE NOT coalesce(o_totalprice <= 400000, true))
SELECT 'customer' AS table_name, failed,
       CAST(to_json(struct_pack(c_custkey := c_custkey, c_name := c_name)) AS VARCHAR) AS row_json,
       {TS1} AS load_datetime
FROM a WHERE dq_action = 'quarantine'
UNION ALL
SELECT 'orders', 'range:o_totalprice', CAST(to_json(struct_pack(o_orderkey := o_orderkey)) AS VARCHAR), {TS1}
FROM oq""")
def q_quarantine_all(spark, sf):
    cq = _customer_split(spark, sf).quarantine.select("c_custkey", "c_name", quality.FAILED)
    o = _t(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    osplit = quality.apply_rules(o, [Rule(column="o_totalprice", kind="range", args=(None, 400000))])
    oq = osplit.quarantine.select("o_orderkey", quality.FAILED)
    allq = quality.collect_quarantine({"customer": cq, "orders": oq}, tpl.LOAD_TS)
    return _failed_text(allq).drop(quality.FAILED)


def _etl_specs(spark):
    return {s.name: s for s in specs_from_metadata(tpl.TARGET_ROWS, tpl.MAPPING_ROWS, tpl.LOAD_ROWS)}


ETL_CUSTOMER_SQL = """
SELECT CAST(c_custkey AS BIGINT) AS customer_id, CAST(c_name AS VARCHAR) AS customer_name FROM customer
WHERE c_custkey IS NOT NULL AND c_name IS NOT NULL AND coalesce(length(c_name) <= 50, true)
  AND c_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL
                        GROUP BY c_custkey HAVING count(*) > 1)"""


@query("etl_customer", ETL_CUSTOMER_SQL)
def q_etl_customer(spark, sf):
    spec = _etl_specs(spark)["customer"]
    spec.null_check_all = True
    return checked_target(spec, tpl.sources(spark, sf)).clean.drop(quality.FAILED)


ETL_ORDERS_SQL = f"""
WITH t AS (SELECT CAST(o_orderkey AS BIGINT) AS order_id FROM orders JOIN customer ON o_custkey = c_custkey
           WHERE o_orderdate > TIMESTAMP '{tpl.ORDER_CUTOFF}')
SELECT order_id FROM t WHERE order_id IS NOT NULL
  AND order_id NOT IN (SELECT order_id FROM t WHERE order_id IS NOT NULL GROUP BY order_id HAVING count(*) > 1)"""


@query("etl_orders", ETL_ORDERS_SQL)
def q_etl_orders(spark, sf):
    spec = _etl_specs(spark)["orders"]
    spec.null_check_all = True
    return checked_target(spec, tpl.sources(spark, sf)).clean.drop(quality.FAILED)


@query("etl_job", f"SELECT order_id, CAST(order_id * 10 AS BIGINT) AS tenfold FROM ({ETL_ORDERS_SQL})")
def q_etl_job(spark, sf):
    """E10 with its sinks: the orders job run on the early half of the source,
    on the whole source and again; the target read back as it was written."""
    specs = [s for s in specs_from_metadata(tpl.TARGET_ROWS, tpl.MAPPING_ROWS, tpl.LOAD_ROWS) if s.name == "orders"]
    specs[0].columns["tenfold"], specs[0].types["tenfold"] = "o_orderkey * 10", "BIGINT"
    src = tpl.sources(spark, sf)
    target, quarantine, state = (scratch_path(spark, f"etl_job_{x}") for x in ("target", "quarantine", "state"))
    early = {**src, "orders": src["orders"].filter(F.col("o_orderdate") < _lit_ts(tpl.JOB_CUTOFF))}
    for sources in (early, src, src):
        run_job(spark, specs, sources, {"orders": target}, quarantine, tpl.LOAD_TS, state_path=state)
    return spark.read.parquet(target).drop(incremental.LOAD_BATCH)


# A user's sheets as the guide heads them: no target table in the mapping, one
# row per rule, the same join twice, a filter on the joined table, a literal.
GUIDE_TARGET = [("order_facts", "order_id", "BIGINT", "", "not null; unique"),
                ("order_facts", "segment", "VARCHAR(20)", "c_mktsegment", ""),
                ("order_facts", "priority", "VARCHAR(20)", "o_orderpriority", "in('1-URGENT', '2-HIGH', 'NONE')"),
                ("order_facts", "one", "INTEGER", "1", "")]
GUIDE_JOIN = "customer ON orders.o_custkey = customer.c_custkey"
GUIDE_MAPPING = [("1", "order_id = o_orderkey", "", GUIDE_JOIN, "orders"), ("2", "", "customer.c_acctbal > 1000", GUIDE_JOIN, "orders")]


@query("etl_guide_sheets", """
WITH t AS (SELECT o_orderkey AS order_id, c_mktsegment AS segment,
    coalesce(CASE WHEN o_orderpriority LIKE '1%' THEN NULL ELSE o_orderpriority END, 'NONE') AS priority, 1 AS one
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 1000)
SELECT order_id, segment, priority, one FROM t WHERE priority IN ('1-URGENT', '2-HIGH', 'NONE')""")
def q_etl_guide_sheets(spark, sf):
    """E10 from sheets with the guide's own headers, through ``run_job``: inferred
    target, expression for a blank transformation, default value of a source
    column, "Drop" as error handling."""
    def sheet_of(rows, headers, kind):
        return normalize(spark.createDataFrame(rows, ", ".join(f"`{h}` string" for h in headers)), kind)
    specs = specs_from_metadata(
        sheet_of(GUIDE_TARGET, ["Target Table Name", "Target Column Name", "Target Data Type", "Transformation Logic", "Validations"],
                 "target_columns"),
        sheet_of(GUIDE_MAPPING, ["Mapping Rule ID", "Business Rule / Expression", "Filter Conditions", "Join Conditions",
                                 "Source Table"], "mappings"),
        sheet_of([("order_facts", "Daily", "Full", "Drop bad rows")],
                 ["Target Table Name", "Load Frequency", "Incremental or Full Load", "Error Handling Logic"], "loads"),
        source_columns=sheet_of([("orders", "o_orderpriority", "true", "NONE")],
                                ["Source Table Name", "Source Column Name", "Nullable", "Default Value"], "source_columns"))
    src = tpl.sources(spark, sf)
    urgent = F.when(~F.col("o_orderpriority").startswith("1"), F.col("o_orderpriority"))
    target, quarantine = scratch_path(spark, "guide_target"), scratch_path(spark, "guide_quarantine")
    run_job(spark, specs, {"orders": _t(spark, sf, "orders").withColumn("o_orderpriority", urgent), "customer": src["customer"]},
            {"order_facts": target}, quarantine, tpl.LOAD_TS)
    return spark.read.parquet(target)


# ====================================================================== H/F/I: vault

@query("surrogate_key", f"""
SELECT c_custkey, {sk('c_custkey', 'c_name')} AS sk,
       {sk('c_custkey', "nullif(c_mktsegment, 'BUILDING')")} AS sk_with_null FROM customer""")
def q_surrogate_key(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", "c_name",
                                         F.expr("nullif(c_mktsegment, 'BUILDING')").alias("seg"))
    return c.select("c_custkey", surrogate_key(["c_custkey", "c_name"], c.schema).alias("sk"),
                    surrogate_key(["c_custkey", "seg"], c.schema).alias("sk_with_null"))


SAT_ATTRS_SQL = ("c_name", "CAST(c_acctbal AS DECIMAL(18,2))", "nullif(c_mktsegment, 'BUILDING')")


@query("hash_diff", f"SELECT c_custkey, {hd(*SAT_ATTRS_SQL)} AS hash_diff FROM customer")
def q_hash_diff(spark, sf):
    s = _customer_sat_stage(spark, sf)
    return s.select(F.col("customer_id").alias("c_custkey"), vault.hash_diff(["customer_name", "acctbal", "segment"],
                                                                           s.schema).alias("hash_diff"))


def _customer_sat_stage(spark, sf):
    return vault.staging(_t(spark, sf, "customer"),
                         {"customer_id": "c_custkey", "customer_name": "c_name", "acctbal": "c_acctbal",
                          "segment": "nullif(c_mktsegment, 'BUILDING')"},
                         casts={"acctbal": "DECIMAL(18,2)"}).drop("cast_failures")


@query("staging_customer", f"""
SELECT c_custkey AS customer_id, nullif(trim(c_name), '') AS customer_name,
       CAST(c_acctbal AS DECIMAL(18,2)) AS acctbal, nullif(trim(nullif(c_mktsegment, 'BUILDING')), '') AS segment,
       {sk('c_custkey')} AS hub_customer_key,
       {hd("nullif(trim(c_name), '')", 'CAST(c_acctbal AS DECIMAL(18,2))',
           "nullif(trim(nullif(c_mktsegment, 'BUILDING')), '')")} AS hash_diff
FROM customer""")
def q_staging_customer(spark, sf):
    return vault.staging(_t(spark, sf, "customer"),
                         {"customer_id": "c_custkey", "customer_name": "c_name", "acctbal": "c_acctbal",
                          "segment": "nullif(c_mktsegment, 'BUILDING')"},
                         casts={"acctbal": "DECIMAL(18,2)"},
                         hash_keys={"hub_customer_key": ["customer_id"]},
                         hash_diffs={"hash_diff": ["customer_name", "acctbal", "segment"]}).drop("cast_failures")


def _hub_sql(table: str, key: str, name: str, ts: str = TS1, where: str = "") -> str:
    w = f"AND {where}" if where else ""
    return (f"SELECT {sk(key)} AS hub_{name}_key, {key}, {ts} AS load_datetime, 'tpch' AS record_source "
            f"FROM (SELECT DISTINCT {key} FROM {table} WHERE {key} IS NOT NULL {w})")


@query("hub_customer", _hub_sql("customer", "c_custkey", "customer"))
def q_hub_customer(spark, sf):
    return vault.hub(_t(spark, sf, "customer"), "c_custkey", "customer", tpl.LOAD_TS, tpl.RECORD_SOURCE)


@query("hub_order", _hub_sql("orders", "o_orderkey", "order"))
def q_hub_order(spark, sf):
    return vault.hub(_t(spark, sf, "orders"), "o_orderkey", "order", tpl.LOAD_TS, tpl.RECORD_SOURCE)


def _link_sql(table: str, hubs: dict[str, list[str]], name: str, ts: str = TS1, where: str = "") -> str:
    cols = [c for cs in hubs.values() for c in cs]
    nn = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    w = f"AND {where}" if where else ""
    hub_keys = ", ".join(f"{sk(*cs)} AS hub_{h}_key" for h, cs in hubs.items())
    return (f"SELECT {sk(*cols)} AS link_{name}_key, {hub_keys}, {ts} AS load_datetime, 'tpch' AS record_source "
            f"FROM (SELECT DISTINCT {', '.join(cols)} FROM {table} WHERE {nn} {w})")


LINK_OC = {"order": ["o_orderkey"], "customer": ["o_custkey"]}
LINK_LI = {"order": ["l_orderkey"], "part": ["l_partkey"], "supplier": ["l_suppkey"]}


@query("link_order_customer", _link_sql("orders", LINK_OC, "order_customer"))
def q_link_order_customer(spark, sf):
    return vault.link(_t(spark, sf, "orders"), LINK_OC, "order_customer", tpl.LOAD_TS, tpl.RECORD_SOURCE)


@query("link_lineitem", _link_sql("lineitem", LINK_LI, "lineitem"))
def q_link_lineitem(spark, sf):
    return vault.link(_t(spark, sf, "lineitem"), LINK_LI, "lineitem", tpl.LOAD_TS, tpl.RECORD_SOURCE)


@query("sat_customer_details", f"""
SELECT {sk('c_custkey')} AS hub_customer_key, {hd('c_name', 'acctbal', 'segment')} AS hash_diff,
       c_name, acctbal, segment, {TS1} AS load_datetime, 'tpch' AS record_source
FROM (SELECT DISTINCT c_custkey, c_name, CAST(c_acctbal AS DECIMAL(18,2)) AS acctbal,
             nullif(c_mktsegment, 'BUILDING') AS segment FROM customer WHERE c_custkey IS NOT NULL)""")
def q_sat_customer(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", "c_name",
                                         F.col("c_acctbal").cast("decimal(18,2)").alias("acctbal"),
                                         F.expr("nullif(c_mktsegment, 'BUILDING')").alias("segment"))
    return vault.satellite(c, "c_custkey", ["c_name", "acctbal", "segment"], "customer", tpl.LOAD_TS,
                           tpl.RECORD_SOURCE)


SAT_HISTORY_SQL = f"""
SELECT hub_user_key, hash_diff, event_type, ts AS load_datetime, 'tpch' AS record_source FROM (
  SELECT {sk('user_id')} AS hub_user_key, {hd('event_type')} AS hash_diff, event_type, ts,
         lag({hd('event_type')}) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_hd
  FROM events WHERE user_id IS NOT NULL)
WHERE prev_hd IS DISTINCT FROM hash_diff"""


@query("sat_user_history", SAT_HISTORY_SQL)
def q_sat_user_history(spark, sf):
    return vault.satellite_history(_t(spark, sf, "events"), "user_id", ["event_type"], "ts", "user",
                                   tpl.RECORD_SOURCE, tie_cols=["event_id"])


@query("hub_incremental", f"""
SELECT * FROM ({_hub_sql('orders', 'o_custkey', 'customer', TS2)}) b
WHERE hub_customer_key NOT IN (SELECT hub_customer_key FROM
  ({_hub_sql('orders', 'o_custkey', 'customer', TS1, f"o_orderdate < TIMESTAMP '{tpl.HUB_BATCH1_CUTOFF}'")}))""")
def q_hub_incremental(spark, sf):
    o = _t(spark, sf, "orders")
    existing = vault.hub(o.filter(F.col("o_orderdate") < _lit_ts(tpl.HUB_BATCH1_CUTOFF)), "o_custkey", "customer",
                         tpl.LOAD_TS, tpl.RECORD_SOURCE)
    batch = vault.hub(o, "o_custkey", "customer", tpl.LOAD_TS2, tpl.RECORD_SOURCE)
    return vault.new_hub_rows(batch, existing, "hub_customer_key")


@query("hub_load", f"""
WITH b1 AS ({_hub_sql('orders', 'o_custkey', 'customer', TS1, f"o_orderdate < TIMESTAMP '{tpl.HUB_BATCH1_CUTOFF}'")}),
     b2 AS ({_hub_sql('orders', 'o_custkey', 'customer', TS2)})
SELECT *, '007' AS batch_id FROM b1
UNION ALL
SELECT *, '1.0' FROM b2 WHERE hub_customer_key NOT IN (SELECT hub_customer_key FROM b1)""")
def q_hub_load(spark, sf):
    """I1 as a stored-table load: two batches written with
    write_vault_increment (batch 2 replayed once), then the table read back. The
    labels read as numbers and must stay text."""
    o = _t(spark, sf, "orders")
    target = scratch_path(spark, "hub_load")
    early = o.filter(F.col("o_orderdate") < _lit_ts(tpl.HUB_BATCH1_CUTOFF))
    writers.write_vault_increment(vault.hub(early, "o_custkey", "customer", tpl.LOAD_TS, tpl.RECORD_SOURCE),
                                  target, "hub_customer_key", "007")
    for _ in range(2):      # a replay of batch 2 must not add rows
        writers.write_vault_increment(vault.hub(o, "o_custkey", "customer", tpl.LOAD_TS2, tpl.RECORD_SOURCE),
                                      target, "hub_customer_key", "1.0")
    return writers.read_batches(spark, target)


@query("link_incremental", f"""
SELECT * FROM ({_link_sql('orders', LINK_OC, 'order_customer', TS2)}) b
WHERE link_order_customer_key NOT IN (SELECT link_order_customer_key FROM
  ({_link_sql('orders', LINK_OC, 'order_customer', TS1, f"o_orderdate < TIMESTAMP '{tpl.HUB_BATCH1_CUTOFF}'")}))""")
def q_link_incremental(spark, sf):
    o = _t(spark, sf, "orders")
    existing = vault.link(o.filter(F.col("o_orderdate") < _lit_ts(tpl.HUB_BATCH1_CUTOFF)), LINK_OC,
                          "order_customer", tpl.LOAD_TS, tpl.RECORD_SOURCE)
    batch = vault.link(o, LINK_OC, "order_customer", tpl.LOAD_TS2, tpl.RECORD_SOURCE)
    return vault.new_link_rows(batch, existing, "link_order_customer_key")


def _latest_sat_sql(where: str, ts: str) -> str:
    return f"""SELECT {sk('user_id')} AS hub_user_key, {hd('event_type')} AS hash_diff, event_type,
       {ts} AS load_datetime, 'tpch' AS record_source FROM events {where}
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""


@query("sat_incremental", f"""
WITH ex AS ({_latest_sat_sql(f"WHERE ts < TIMESTAMP '{tpl.SAT_BATCH1_CUTOFF}'", TS1)}),
     b AS ({_latest_sat_sql('', TS2)})
SELECT b.* FROM b LEFT JOIN ex ON b.hub_user_key = ex.hub_user_key
WHERE b.hash_diff IS DISTINCT FROM ex.hash_diff""")
def q_sat_incremental(spark, sf):
    e = _t(spark, sf, "events").select("user_id", "event_type", "ts", "event_id")

    def latest_sat(df, ts):
        cur = ordered.current_rows(df, "user_id", ["ts", "event_id"])
        return vault.satellite(cur, "user_id", ["event_type"], "user", ts, tpl.RECORD_SOURCE)

    existing = latest_sat(e.filter(F.col("ts") < _lit_ts(tpl.SAT_BATCH1_CUTOFF)), tpl.LOAD_TS)
    batch = latest_sat(e, tpl.LOAD_TS2)
    return vault.changed_sat_rows(batch, existing, "hub_user_key")


@query("sat_load", f"""
WITH s AS (SELECT {sk('user_id')} AS hub_user_key, {hd('event_type')} AS hash_diff, event_type,
             ts AS load_datetime, 'tpch' AS record_source FROM events WHERE user_id IS NOT NULL),
d AS (SELECT DISTINCT * FROM s)
SELECT hub_user_key, hash_diff, event_type, load_datetime, record_source FROM (
  SELECT *, lag(hash_diff) OVER (PARTITION BY hub_user_key ORDER BY load_datetime, hash_diff) AS prev FROM d)
WHERE prev IS DISTINCT FROM hash_diff""")
def q_sat_load(spark, sf):
    """I3 as a stored-table load: later events first, then the late ones, then a
    replay of both. The history of changes, read back from the table, holds every
    version: late rows are not lost and replays add none."""
    e = _t(spark, sf, "events").select("user_id", "event_type", F.col("ts"))
    rows = require_keys(e, ["user_id"]).select(
        surrogate_key(["user_id"], e.schema).alias("hub_user_key"), vault.hash_diff(["event_type"], e.schema).alias("hash_diff"),
        "event_type", F.col("ts").alias("load_datetime"), F.lit(tpl.RECORD_SOURCE).alias("record_source"))
    target = scratch_path(spark, "sat_load")
    cut = _lit_ts(tpl.SAT_BATCH1_CUTOFF)
    late, now = rows.filter(F.col("load_datetime") < cut), rows.filter(F.col("load_datetime") >= cut)
    for name, part in (("b1", now), ("b2", late), ("b2", late), ("b3", rows)):
        writers.write_vault_increment(part, target, "hub_user_key", name, "sat_changes")
    stored = writers.read_batches(spark, target).drop("batch_id")
    # A late version can make the stored one after it a repeat: the history skips repeats.
    return ordered.changes(stored, "hub_user_key", "hash_diff", ["load_datetime", "hash_diff"])


@query("upsert_by_key", """
SELECT c_custkey, c_name,
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) + CASE WHEN c_mktsegment = 'BUILDING' THEN 100 ELSE 0 END AS DECIMAL(18,2))
       AS c_acctbal FROM customer""")
def q_upsert(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", "c_name", F.col("c_acctbal").cast("decimal(18,2)")
                                         .alias("c_acctbal"), "c_mktsegment")
    existing = c.drop("c_mktsegment")
    batch = (c.filter(F.col("c_mktsegment") == "BUILDING")
             .select("c_custkey", "c_name", (F.col("c_acctbal") + 100).cast("decimal(18,2)").alias("c_acctbal")))
    return vault.upsert_by_key(batch, existing, "c_custkey")


@query("link_order_nation", f"""
SELECT {sk('o_orderkey', 'c_nationkey')} AS link_order_nation_key, {sk('o_orderkey')} AS hub_order_key,
       {sk('c_nationkey')} AS hub_nation_key, {TS1} AS load_datetime, 'tpch' AS record_source
FROM (SELECT DISTINCT o_orderkey, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey
      WHERE o_orderkey IS NOT NULL AND c_nationkey IS NOT NULL)""")
def q_link_order_nation(spark, sf):
    """C5 + F3: the link's keys come from two entities joined on their relationship."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = _t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    joined = joins.join_entities(o, [(c, [("o_custkey", "c_custkey")])])
    return vault.link(joined, {"order": ["o_orderkey"], "nation": ["c_nationkey"]}, "order_nation",
                      tpl.LOAD_TS, tpl.RECORD_SOURCE)


@query("hub_after_max", f"""
WITH b AS (SELECT {sk('o_orderkey')} AS hub_order_key, o_orderkey, o_orderdate AS load_datetime,
                  'tpch' AS record_source FROM orders WHERE o_orderkey IS NOT NULL),
     ex AS (SELECT * FROM b WHERE load_datetime < TIMESTAMP '{tpl.HUB_BATCH1_CUTOFF}')
SELECT * FROM b WHERE (SELECT max(load_datetime) FROM ex) IS NULL
   OR load_datetime > (SELECT max(load_datetime) FROM ex)""")
def q_hub_after_max(spark, sf):
    """The generated template's incremental filter - rows whose
    load_datetime is later than the target's maximum (all rows when the
    target is empty). Here load_datetime is the order date."""
    o = _t(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").alias("load_datetime"))
    batch = require_keys(o, ["o_orderkey"]).select(
        surrogate_key(["o_orderkey"], o.schema).alias("hub_order_key"), "o_orderkey", "load_datetime",
        F.lit(tpl.RECORD_SOURCE).alias("record_source"))
    existing = batch.filter(F.col("load_datetime") < _lit_ts(tpl.HUB_BATCH1_CUTOFF))
    return joins.after_max(batch, "load_datetime", existing)


@query("dq_vault_generic", f"""
WITH h AS ({_hub_sql('customer', 'c_custkey', 'customer')})
SELECT 'hub_key_format' AS test_name, CAST(count_if(hub_customer_key IS NULL OR length(hub_customer_key) <> 32
       OR NOT regexp_matches(hub_customer_key, '^[A-F0-9]+$')) AS BIGINT) AS failures FROM h
UNION ALL SELECT 'load_datetime_not_null', CAST(count_if(load_datetime IS NULL) AS BIGINT) FROM h
UNION ALL SELECT 'record_source_not_null', CAST(count_if(record_source IS NULL OR trim(record_source) = '') AS BIGINT)
FROM h""")
def q_vault_generic(spark, sf):
    """Q11 + Q16 + Q17 as the generic vault test suite: one aggregation pass."""
    h = vault.hub(_t(spark, sf, "customer"), "c_custkey", "customer", tpl.LOAD_TS, tpl.RECORD_SOURCE)
    fmt = h.agg(F.count_if(checks.hash_key_format("hub_customer_key")).alias("failures")).select(
        F.lit("hub_key_format").alias("test_name"), "failures")
    return fmt.unionByName(quality.audit_failures(h))


def _vault_models_sql() -> str:
    def part(model, kind, key_sql, cols, table, nn):
        return (f"SELECT '{model}' AS model, '{kind}' AS kind, count(*) AS rows, min({key_sql}) AS min_key, "
                f"max({key_sql}) AS max_key FROM (SELECT DISTINCT {cols} FROM {table} WHERE {nn})")
    return " UNION ALL ".join([
        part("hub_customer", "hub", sk("c_custkey"), "c_custkey", "customer", "c_custkey IS NOT NULL"),
        part("hub_orders", "hub", sk("o_orderkey"), "o_orderkey", "orders", "o_orderkey IS NOT NULL"),
        part("link_orders_customer", "link", sk("o_orderkey", "o_custkey"), "o_orderkey, o_custkey", "orders",
             "o_orderkey IS NOT NULL AND o_custkey IS NOT NULL"),
        part("sat_customer", "satellite", sk("c_custkey"),
             "c_custkey, nullif(trim(c_name), '') AS n, c_nationkey, c_acctbal, nullif(trim(c_mktsegment), '') AS m",
             "customer", "c_custkey IS NOT NULL"),
        part("sat_orders", "satellite", sk("o_orderkey"),
             "o_orderkey, nullif(trim(o_orderstatus), '') AS s, o_totalprice, o_orderdate", "orders",
             "o_orderkey IS NOT NULL"),
    ])


@query("vault_models", _vault_models_sql())
def q_vault_models(spark, sf):
    """The whole vault from metadata: hubs from
    primary keys, a link from the mapping's join condition, satellites from
    the remaining columns; one summary row per model."""
    from vaultline.plans.vault_job import build_vault, vault_models_from_metadata
    models = vault_models_from_metadata(tpl.SOURCE_COLUMN_ROWS, tpl.MAPPING_ROWS)
    built = build_vault(models, tpl.sources(spark, sf), tpl.LOAD_TS, tpl.RECORD_SOURCE)
    parts = []
    for m in models:
        df = built[m.name]
        key = df.columns[0]
        parts.append(df.agg(F.lit(m.name).alias("model"), F.lit(m.kind).alias("kind"),
                            F.count(F.lit(1)).alias("rows"), F.min(key).alias("min_key"),
                            F.max(key).alias("max_key")))
    return ordered.union_all_by_name(parts)


# ====================================================================== M: watermark loads

@query("watermark_load", f"SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '{tpl.ORDER_CUTOFF}'")
def q_watermark_load(spark, sf):
    return incremental.after_watermark(_t(spark, sf, "orders"), "o_orderdate", tpl.ORDER_CUTOFF)


@query("watermark_advance", f"""
SELECT 'orders' AS table_name, 'o_orderdate' AS watermark_column,
       CAST(coalesce(greatest(max(o_orderdate), TIMESTAMP '{tpl.ORDER_CUTOFF}'), TIMESTAMP '{tpl.ORDER_CUTOFF}')
            AS VARCHAR) AS watermark,
       'batch-1' AS batch_id, count(*) AS loaded_rows
FROM orders WHERE o_orderdate > TIMESTAMP '{tpl.ORDER_CUTOFF}'""")
def q_watermark_advance(spark, sf):
    o = _t(spark, sf, "orders")
    batch = incremental.after_watermark(o, "o_orderdate", tpl.ORDER_CUTOFF)
    return incremental.advance(batch, "orders", "o_orderdate", tpl.ORDER_CUTOFF, "batch-1")


@query("load_full", "SELECT * FROM orders")
def q_load_full(spark, sf):
    path = scratch_path(spark, "load_full")
    incremental.load(_t(spark, sf, "orders"), "full", path)
    return spark.read.parquet(path).drop(incremental.LOAD_BATCH)


@query("load_incremental", "SELECT * EXCLUDE (o_orderdate), CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE "
       "date_trunc('month', o_orderdate) END AS o_orderdate FROM orders")
def q_load_incremental(spark, sf):
    """M1-M3 as a table load: a full load of the early rows, an increment, a
    replay, and a last increment with late rows at the stored maximum (months
    make ties) and rows without a watermark. Every row arrives exactly once."""
    o = _t(spark, sf, "orders")
    month = F.col("o_orderdate").cast("date")
    month = F.trunc(month, "month").cast("timestamp_ntz")
    o = o.withColumn("o_orderdate", F.when(F.col("o_orderkey") % 50 != 0, month))
    when, half = F.col("o_orderdate"), F.col("o_orderkey") % 2 == 0
    cut = F.trunc(F.lit(tpl.HUB_BATCH1_CUTOFF[:10]).cast("date"), "month").cast("timestamp_ntz")
    target, state = scratch_path(spark, "load_incremental"), scratch_path(spark, "load_state")

    def load(rows, mode):
        incremental.load(rows, mode, target, state, "o_orderdate", "orders")
    load(o.filter(when < cut), "full")
    load(o.filter((when <= cut) & (half | (when < cut))), "incremental")
    load(o.filter((when <= cut) & (half | (when < cut))), "incremental")
    load(o.filter(when.isNull() & half | (when <= cut)), "incremental")
    load(o, "incremental")
    return spark.read.parquet(target).drop(incremental.LOAD_BATCH).select(o.columns)

# ====================================================================== K: keys and relationships

PROFILE_TABLES = ("customer", "orders", "lineitem", "part", "supplier")


def _profile_sql(table: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) AS rows, CAST(count_if({c} IS NULL) AS BIGINT) AS nulls, "
        f"CAST(count(DISTINCT {c}) AS BIGINT) AS distinct_values, "
        f"(count_if({c} IS NULL) = 0 AND count(DISTINCT {c}) = count(*)) AS is_unique FROM {table}" for c in cols)


def _key_columns(spark, sf) -> dict[str, list[str]]:
    tables = {t: _t(spark, sf, t) for t in PROFILE_TABLES}
    cands = catalog.key_candidates(catalog.catalog_of(spark, tables)).collect()   # metadata rows
    out: dict[str, list[str]] = {}
    for r in cands:
        out.setdefault(r["table_name"], []).append(r["column_name"])
    return out


# Names the words rule accepts in these tables (checked by tests/test_catalog.py).
KEY_COLUMNS = {"customer": ["c_custkey", "c_nationkey"], "orders": ["o_orderkey", "o_custkey"],
               "lineitem": ["l_orderkey", "l_partkey", "l_suppkey"], "part": ["p_partkey"],
               "supplier": ["s_suppkey", "s_nationkey"]}


@query("key_candidates", " UNION ALL ".join(_profile_sql(t, c) for t, c in KEY_COLUMNS.items()))
def q_key_candidates(spark, sf):
    parts = [catalog.profile_keys(_t(spark, sf, t), t, cols) for t, cols in _key_columns(spark, sf).items()]
    return ordered.union_all_by_name(parts)


def _unique_sql(table: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, "
        f"(count_if({c} IS NULL) = 0 AND count(DISTINCT {c}) = count(*)) AS is_unique FROM {table}" for c in cols)


DISCOVERY_COLUMNS = {"customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
                     "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                                "o_orderpriority"]}


@query("key_discovery", " UNION ALL ".join(_unique_sql(t, c) for t, c in DISCOVERY_COLUMNS.items()))
def q_key_discovery(spark, sf):
    """K2 two-phase: HLL estimates for every column, exact counts only for
    the columns that may be unique."""
    parts = [catalog.find_keys(_t(spark, sf, t), t).select("table_name", "column_name", "is_unique")
             for t in DISCOVERY_COLUMNS]
    return ordered.union_all_by_name(parts)


@query("key_profile", _profile_sql("customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]))
def q_key_profile(spark, sf):
    return catalog.profile_keys(_t(spark, sf, "customer"), "customer")


@query("satellite_groups", """
SELECT 'customer' AS table_name, 'c_acctbal,c_mktsegment,c_name,c_nationkey' AS attributes
  WHERE (SELECT count(DISTINCT c_custkey) = count(*) AND count_if(c_custkey IS NULL) = 0 FROM customer)
UNION ALL
SELECT 'orders', 'o_custkey,o_orderdate,o_orderpriority,o_orderstatus,o_totalprice'
  WHERE (SELECT count(DISTINCT o_orderkey) = count(*) AND count_if(o_orderkey IS NULL) = 0 FROM orders)""")
def q_satellite_groups(spark, sf):
    """K3 with K1+K2: a column is a key when its name looks like one AND the
    data shows it unique; the rest are satellite attributes."""
    parts = []
    for t in ("customer", "orders"):
        df = _t(spark, sf, t)
        cands = [c for c in df.columns if c in KEY_COLUMNS[t]]
        prof = catalog.profile_keys(df, t, cands).select("table_name", "column_name", F.col("is_unique").alias("is_key"))
        cols = catalog.catalog_of(spark, {t: df}).join(prof, ["table_name", "column_name"], "left")
        parts.append(cols)
    groups = catalog.satellite_groups(ordered.union_all_by_name(parts))
    keyed = ordered.union_all_by_name(parts).groupBy("table_name").agg(
        F.max(F.coalesce("is_key", F.lit(False))).alias("has_key"))
    return (groups.join(keyed, "table_name").filter("has_key")
            .select("table_name", F.array_join("attributes", ",").alias("attributes")))


REL_SQL = """
SELECT '1' AS rule_id, 0 AS pair_no, 'orders' AS left_table, 'o_custkey' AS left_column,
       'customer' AS right_table, 'c_custkey' AS right_column,
       count(*) AS child_rows,
       CAST(count_if(o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer
                                                                 WHERE c_custkey IS NOT NULL)) AS BIGINT) AS orphan_rows
FROM orders"""


@query("relationships", REL_SQL)
def q_relationships(spark, sf):
    """K4 + C4: relationships read from join conditions, each checked on the
    data (child rows and orphans)."""
    m = tpl.mappings(spark)
    rels = catalog.relationships(m)
    src = tpl.sources(spark, sf)
    parts = []
    for r in rels.collect():                       # one row per declared relationship (metadata)
        child, parent = src[r["left_table"]], src[r["right_table"]]
        fk, pk = r["left_column"], r["right_column"]
        keys = parent.select(F.col(pk).alias("_pk")).distinct().withColumn("_hit", F.lit(True))
        checked = child.select(fk).join(keys, F.col(fk) == F.col("_pk"), "left")
        parts.append(checked.agg(
            F.lit(r["rule_id"]).alias("rule_id"), F.lit(r["pair_no"]).alias("pair_no"),
            F.lit(r["left_table"]).alias("left_table"), F.lit(fk).alias("left_column"),
            F.lit(r["right_table"]).alias("right_table"), F.lit(pk).alias("right_column"),
            F.count(F.lit(1)).alias("child_rows"),
            F.count_if(F.col(fk).isNotNull() & F.col("_hit").isNull()).alias("orphan_rows")))
    return ordered.union_all_by_name(parts)


# ====================================================================== L: lineage

# A mapping sheet with a rule per part: most map a column, some are no plain
# mapping, some are blank, tables are named in the rule or by the row.
_RULE_SQL = ("CASE WHEN p_partkey % 7 = 0 THEN 'SUM(p_size) over parts' WHEN p_partkey % 11 = 0 THEN NULL "
             "WHEN p_partkey % 2 = 0 THEN 'item_' || p_partkey || ' = ' || lower(p_type) "
             "ELSE replace(p_brand, '#', '_') || '.item_' || p_partkey || ' = part.' || lower(p_type) END")
MAPPINGS_SQL = (f"SELECT CAST(p_partkey AS VARCHAR) AS rule_id, replace(p_brand, '#', '_') AS target_table, "
                f"'part' AS source_table, {_RULE_SQL} AS expression FROM part")


def _mapping_sheet(spark, sf):
    return _t(spark, sf, "part").selectExpr("CAST(p_partkey AS STRING) AS rule_id", "replace(p_brand, '#', '_') AS target_table",
                                            "'part' AS source_table", f"{_RULE_SQL} AS expression")


_FULL_RE = r"^\s*(?:(\w+)\.)?(\w+)\s*=\s*(?:(\w+)\.)?(\w+)\s*$"
EDGES_SQL = f"""
SELECT 'edge_' || rule_id AS edge_id,
       CASE WHEN ok THEN coalesce(nullif(regexp_extract(e, '{_FULL_RE}', 3), ''), source_table) END AS source_table,
       CASE WHEN ok THEN regexp_extract(e, '{_FULL_RE}', 4) END AS source_column,
       CASE WHEN ok THEN coalesce(nullif(regexp_extract(e, '{_FULL_RE}', 1), ''), target_table) END AS target_table,
       CASE WHEN ok THEN regexp_extract(e, '{_FULL_RE}', 2) END AS target_column,
       CASE WHEN e = '' THEN 'direct mapping' ELSE e END AS transformation, ok AS matched
FROM (SELECT *, coalesce(trim(expression), '') AS e, regexp_matches(coalesce(trim(expression), ''), '{_FULL_RE}') AS ok
      FROM ({MAPPINGS_SQL}))"""


@query("lineage_edges", f"""
SELECT edge_id, source_table || '.' || source_column AS source, target_table || '.' || target_column AS target,
       transformation, matched FROM ({EDGES_SQL})""")
def q_lineage_edges(spark, sf):
    """L1, rules that are no plain mapping included."""
    return lineage.edges(_mapping_sheet(spark, sf)).select("edge_id", "source", "target", "transformation", "matched")


@query("lineage_nodes", f"""
WITH e AS (SELECT * FROM ({EDGES_SQL}) WHERE matched)
SELECT source_table || '.' || source_column AS id, source_table AS table_name, source_column AS column_name FROM e
UNION SELECT target_table || '.' || target_column, target_table, target_column FROM e""")
def q_lineage_nodes(spark, sf):
    """L2."""
    return lineage.nodes(lineage.edges(_mapping_sheet(spark, sf)))


LINEAGE_JSON_SQL = f"""
WITH e AS (SELECT * FROM ({EDGES_SQL}) WHERE matched),
n AS (SELECT DISTINCT target_table AS doc, source_table || '.' || source_column AS id, source_table AS tbl,
             source_column AS col FROM e
      UNION SELECT target_table, target_table || '.' || target_column, target_table, target_column FROM e),
nl AS (SELECT doc, list_sort(list(struct_pack(id := id, type := 'Column', name := col,
             parent := struct_pack(id := tbl, type := 'Table', name := tbl)))) AS nodes FROM n GROUP BY doc),
el AS (SELECT target_table AS doc, list_sort(list(struct_pack(id := edge_id,
             source := source_table || '.' || source_column, target := target_table || '.' || target_column,
             label := transformation, transformation := transformation))) AS edges FROM e GROUP BY target_table)
SELECT nl.doc AS target_table,
       CAST(to_json(struct_pack(codeGraph := struct_pack(nodes := nl.nodes, edges := el.edges),
                           sourceProperties := []::VARCHAR[], targetProperties := []::VARCHAR[],
                           script := struct_pack(codeFormat := 'python',
                                                 placeholder := '# Transformation logic not provided')))
            AS VARCHAR) AS lineage_json
FROM nl JOIN el ON nl.doc = el.doc"""


@query("lineage_json", LINEAGE_JSON_SQL)
def q_lineage_json(spark, sf):
    """L3: a document per target table."""
    e = lineage.edges(_mapping_sheet(spark, sf))
    return lineage.document(lineage.nodes(e), e)


# ====================================================================== P: protection

MASK_SQL = ("regexp_replace(regexp_replace(regexp_replace(c_name, '[a-z]', 'x', 'g'), '[A-Z]', 'X', 'g'), "
            "'[0-9]', 'n', 'g')")


@query("mask_columns", f"SELECT c_custkey, {MASK_SQL} AS c_name, sha256(c_mktsegment) AS c_mktsegment FROM customer")
def q_mask_columns(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    flags = protect.flagged(tpl.protection(spark), "customer")
    out = protect.mask_columns(c, flags["mask"], "mask")
    return protect.mask_columns(out, ["c_mktsegment"], "hash")


@query("encrypt_roundtrip", """
SELECT c_custkey, CAST(c_acctbal AS VARCHAR) AS acctbal_decrypted,
       CAST(4 * ceil((length(CAST(c_acctbal AS VARCHAR)) + 28) / 3.0) AS INTEGER) AS cipher_length,
       true AS cipher_differs
FROM customer""")
def q_encrypt_roundtrip(spark, sf):
    """P2 checked by value: AES-GCM ciphertext (random IV, so not comparable
    itself) decrypts back to the text, has the length GCM fixes (12-byte IV
    + text + 16-byte tag, base64) and differs from the text."""
    from vaultline.functions.protect import decrypt_value
    c = _t(spark, sf, "customer").select("c_custkey", "c_acctbal")
    # The configured key; a round trip needs none in particular, so without one a random key does.
    key = F.lit(spark.conf.get("spark.vaultline.protect.key", None) or secrets.token_hex(8))
    enc = protect.encrypt_columns(c.withColumn("plain", F.col("c_acctbal").cast("string")), ["c_acctbal"], key)
    return enc.select("c_custkey", decrypt_value("c_acctbal", key).alias("acctbal_decrypted"),
                      F.length("c_acctbal").alias("cipher_length"),
                      (F.col("c_acctbal") != F.col("plain")).alias("cipher_differs"))


# ====================================================================== S: streaming

@query("stream_hub_load", _hub_sql("orders", "o_custkey", "customer"))
def q_stream_hub_load(spark, sf):
    from vaultline.streaming.loads import micro_batches, stream_vault_load
    o = _t(spark, sf, "orders")
    stream = micro_batches(o, scratch_path(spark, "stream_orders"), 3)
    target = scratch_path(spark, "stream_hub")

    def build(batch):
        return vault.hub(batch, "o_custkey", "customer", tpl.LOAD_TS, tpl.RECORD_SOURCE)
    stream_vault_load(stream, build, target, "hub_customer_key", scratch_path(spark, "stream_hub_ckpt"))
    return spark.read.parquet(target).drop("batch_id")


@query("stream_dq_split", f"{MARKED_SQL} SELECT c_custkey, c_name, segment FROM a WHERE dq_action IN ('pass', 'log')")
def q_stream_dq_split(spark, sf):
    """The customer rules on a file stream; each micro-batch writes its
    clean rows and its quarantine rows in one pass (stream_dq_load)."""
    from vaultline.streaming.loads import stream_dq_load
    c = _t(spark, sf, "customer")
    stream = (spark.readStream.schema(c.schema).option("pathGlobFilter", "customer.parquet").parquet(sf)
              .select("c_custkey", "c_name", "c_acctbal", F.expr("nullif(c_mktsegment, 'BUILDING')").alias("segment"),
                      "c_mktsegment"))
    rules = rules_from_rows(tpl.CUSTOMER_RULE_ROWS)
    clean, quarantine = scratch_path(spark, "stream_clean"), scratch_path(spark, "stream_quarantine")
    stream_dq_load(stream, rules, "customer", clean, quarantine, scratch_path(spark, "stream_clean_ckpt"),
                   tpl.LOAD_TS)
    return spark.read.parquet(clean).select("c_custkey", "c_name", "segment")


@query("stream_distinct", "SELECT DISTINCT user_id FROM events")
def q_stream_distinct(spark, sf):
    """S3: complete distinct keys over three micro-batches."""
    from vaultline.streaming.loads import micro_batches, stream_distinct_keys
    e = _t(spark, sf, "events")
    stream = micro_batches(e, scratch_path(spark, "stream_events"), 3)
    target = scratch_path(spark, "stream_distinct")
    stream_distinct_keys(stream, ["user_id"], target, scratch_path(spark, "stream_distinct_ckpt"))
    return spark.read.parquet(target).select("user_id")
