"""Registered queries of the stored loads (Bloom-filtered keys, bucketed
tables, snapshots), of lineage from expressions, and of key and relationship
discovery. Same terms as ``registry``: whole tables, and DuckDB SQL for each."""

from __future__ import annotations

from pyspark.sql import functions as F

from vaultline.functions.protect import hmac_pads
from vaultline.operators import catalog, lineage, vault
from vaultline.plans import template as tpl
from vaultline.plans.registry import _hub_sql, _lit_ts, _t, TS1, query
from vaultline.plans.rules import Rule
from vaultline.session import scratch_path
from vaultline.sources import keyed, writers
from vaultline.sources.snapshots import Snapshots
from vaultline.sources.tokens import TokenVault

CUTS = ("1994-01-01 00:00:00", "1996-06-01 00:00:00")
LABELS = ("007", "1.0", "b1")  # labels that read as numbers, too


# ====================================================================== I1: filters before keys

@query("hub_bloom_load", f"""
WITH h AS ({_hub_sql('orders', 'o_custkey', 'customer', TS1)}),
first AS (SELECT o_custkey, min(o_orderdate) AS seen FROM orders GROUP BY o_custkey)
SELECT h.*, CASE WHEN seen < TIMESTAMP '{CUTS[0]}' THEN '{LABELS[0]}' WHEN seen < TIMESTAMP '{CUTS[1]}' THEN '{LABELS[1]}'
       ELSE '{LABELS[2]}' END AS batch_id FROM h JOIN first USING (o_custkey)""")
def q_hub_bloom_load(spark, sf):
    """I1 through stored filters: three batches by order date, each loaded again after the next."""
    o = _t(spark, sf, "orders")
    store = Snapshots(spark, scratch_path(spark, "hub_bloom"))
    parts = [o.filter(F.col("o_orderdate") < _lit_ts(CUTS[0])),
             o.filter((F.col("o_orderdate") >= _lit_ts(CUTS[0])) & (F.col("o_orderdate") < _lit_ts(CUTS[1]))),
             o.filter(F.col("o_orderdate") >= _lit_ts(CUTS[1]))]
    for i in (0, 1, 0, 2, 1):
        batch = vault.hub(parts[i], "o_custkey", "customer", tpl.LOAD_TS, tpl.RECORD_SOURCE)
        keyed.load_new_keys(store, "hub_customer", batch, "hub_customer_key", LABELS[i])
    return keyed.read_batches(store, "hub_customer")


# ====================================================================== I4: buckets that a batch touches

_PRICE = "CAST(o_totalprice AS DECIMAL(18,2))"


@query("upsert_load", f"""
SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'late' WHEN o_orderkey % 4 = 0 THEN 'new' ELSE o_orderstatus END AS status,
       CAST({_PRICE} + CASE WHEN o_orderkey % 10 = 0 THEN 2 WHEN o_orderkey % 4 = 0 THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS price
FROM orders""")
def q_upsert_load(spark, sf):
    """I4 as a stored table: three batches, a replay of the second, and a run
    that ends before its commit."""
    o = _t(spark, sf, "orders")
    store = Snapshots(spark, scratch_path(spark, "upsert"))
    table = keyed.Bucketed(store, "orders", "o_orderkey", n=16)

    def part(where: str, status: str, plus: int):
        return o.filter(where).selectExpr("o_orderkey", f"{status} AS status", f"CAST({_PRICE} + {plus} AS DECIMAL(18,2)) AS price")
    table.upsert(part("o_orderkey % 4 <> 0 OR o_orderkey % 8 = 0", "o_orderstatus", 0), "b1")
    table.upsert(part("o_orderkey % 4 = 0", "'new'", 1), "b2")
    table._write(part("o_orderkey % 3 = 0", "'lost'", 9))  # died before its commit
    table.upsert(part("o_orderkey % 10 = 0", "'late'", 2), "b3")
    table.upsert(part("o_orderkey % 4 = 0", "'new'", 1), "b2")
    return table.read()


# ====================================================================== A6, E9: commits

@query("sink_snapshot", """
SELECT 'customer' AS tbl, c_custkey AS id, CAST(c_acctbal * 2 AS DOUBLE) AS v FROM customer
UNION ALL SELECT 'supplier', s_suppkey, CAST(s_acctbal AS DOUBLE) FROM supplier""")
def q_sink_snapshot(spark, sf):
    """A6 over two tables: published together, one replaced by rows that read the
    table itself, and a run that ends before its commit; readers see the last commit."""
    store = Snapshots(spark, scratch_path(spark, "snapshots"))
    c = _t(spark, sf, "customer").selectExpr("c_custkey AS id", "CAST(c_acctbal AS DOUBLE) AS v")
    s = _t(spark, sf, "supplier").selectExpr("s_suppkey AS id", "CAST(s_acctbal AS DOUBLE) AS v")
    store.publish({"customer": c, "supplier": s})
    store.publish({"customer": store.read("customer").withColumn("v", F.col("v") * 2)})
    store.stage("supplier", s.limit(0))  # died before its commit
    return store.read("customer").select(F.lit("customer").alias("tbl"), "id", "v").unionByName(
        store.read("supplier").select(F.lit("supplier").alias("tbl"), "id", "v"))


# ====================================================================== A9: even files

@query("sink_rebalanced", "SELECT *, CASE WHEN l_linenumber <= 2 THEN 'hot' ELSE 'line ' || l_linenumber END AS part FROM lineitem")
def q_sink_rebalanced(spark, sf):
    """A9 with one partition that holds half of all rows."""
    rows = _t(spark, sf, "lineitem").withColumn("part", F.expr(
        "CASE WHEN l_linenumber <= 2 THEN 'hot' ELSE 'line ' || l_linenumber END"))
    path = scratch_path(spark, "sink_rebalanced")
    writers.write_partitioned(rows, path, ["part"], rebalance=True)
    return writers.read_partitioned(spark, path, rows.schema)


# ====================================================================== L: expressions

_SHEET = """
SELECT CAST(p_partkey AS VARCHAR) AS rule_id, replace(p_brand, '#', '_') AS target_table,
  CASE WHEN p_partkey % 6 = 3 THEN NULL WHEN p_partkey % 6 = 5 THEN 'p_name' ELSE 'item_' || p_partkey END AS target_column,
  'part' AS source_table,
  CASE WHEN p_partkey % 6 = 1 THEN 'part.p_partkey = supplier.s_suppkey' END AS join_condition,
  CASE p_partkey % 6 WHEN 0 THEN 'CAST(p_retailprice AS DECIMAL(12,2)) * p_size'
    WHEN 1 THEN 'concat_ws(''-'', supplier.s_name, part.p_name)'
    WHEN 2 THEN 'CASE WHEN p_size > ' || p_size || ' THEN p_brand ELSE upper(p_type) END'
    WHEN 3 THEN 'replace_me.item_' || p_partkey || ' = nation.n_name'
    WHEN 4 THEN CASE WHEN p_size % 2 = 0 THEN 'p_missing + 1' ELSE 'current_date()' END END AS expression
FROM part"""
_SOURCES = """CASE p_partkey % 6 WHEN 0 THEN ['part.p_retailprice', 'part.p_size'] WHEN 1 THEN ['part.p_name', 'supplier.s_name']
  WHEN 2 THEN ['part.p_brand', 'part.p_size', 'part.p_type'] WHEN 3 THEN ['nation.n_name'] WHEN 5 THEN ['part.p_name']
  ELSE [NULL] END"""


def _expression_sheet(spark, sf):
    _t(spark, sf, "part").createOrReplaceTempView("_sheet_part")
    return spark.sql(_SHEET.replace("FROM part", "FROM _sheet_part").replace("AS VARCHAR", "AS STRING"))


@query("lineage_expr_edges", f"""
SELECT 'edge_' || p_partkey AS edge_id, unnest({_SOURCES}) AS source,
  CASE p_partkey % 6 WHEN 3 THEN 'replace_me.item_' || p_partkey WHEN 5 THEN replace(p_brand, '#', '_') || '.p_name'
    ELSE replace(p_brand, '#', '_') || '.item_' || p_partkey END AS target,
  p_partkey % 6 IN (3, 5) AS direct, NOT (p_partkey % 6 = 4 AND p_size % 2 = 0) AS matched FROM part""")
def q_lineage_expr_edges(spark, sf):
    """L1 from analysed expressions: casts, CASE, joins, blank rules, literals, and
    rules that do not resolve, in a sheet with a rule per part."""
    schemas = {t: _t(spark, sf, t) for t in ("part", "supplier", "nation")}
    return lineage.expression_edges(_expression_sheet(spark, sf), schemas).select("edge_id", "source", "target", "direct", "matched")


_HOPS = """SELECT replace(p_brand, '#', '_') || '.c' || (p_size % 9) AS source,
  replace(p_brand, '#', '_') || '.c' || ((p_size * 2 + p_partkey % 3) % 9) AS target FROM part
UNION SELECT 'part.p_size', replace(p_brand, '#', '_') || '.c' || (p_size % 9) FROM part"""


@query("lineage_closure", f"""
WITH RECURSIVE e AS ({_HOPS}), r AS (SELECT source, target FROM e UNION SELECT r.source, e.target FROM r JOIN e ON r.target = e.source)
SELECT source, target FROM r""")
def q_lineage_closure(spark, sf):
    """L2 over any number of steps, cycles included."""
    _t(spark, sf, "part").createOrReplaceTempView("_hops_part")
    return lineage.closure(spark.sql(_HOPS.replace("FROM part", "FROM _hops_part")))


# ====================================================================== K2, K4: discovery

KEY_SETS = {"lineitem": ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"],
            "orders": ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus"]}


def _key_sets_sql() -> str:
    from itertools import combinations
    sets = [(t, s) for t, cols in KEY_SETS.items() for w in (1, 2, 3) for s in combinations(sorted(cols), w)]
    tests = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{','.join(s)}' AS key_columns, {len(s)} AS width, count(*) AS rows, "
        f"count(DISTINCT ({', '.join(s)},)) = count(*) AND count(*) > 0 AND {' AND '.join(f'count({c}) = count(*)' for c in s)} AS ok FROM {t}"
        if len(s) > 1 else
        f"SELECT '{t}', '{s[0]}', 1, count(*), count(DISTINCT {s[0]}) = count(*) AND count(*) > 0 FROM {t}" for t, s in sets)
    return f"""
WITH tested(table_name, key_columns, width, rows, ok) AS ({tests}), k AS (SELECT * FROM tested WHERE ok)
SELECT table_name, key_columns, CAST(width AS INT) AS width, rows FROM k WHERE NOT EXISTS (
  SELECT 1 FROM k small WHERE small.table_name = k.table_name AND small.width < k.width
  AND list_has_all(string_split(k.key_columns, ','), string_split(small.key_columns, ',')))"""


@query("key_combinations", _key_sets_sql())
def q_key_combinations(spark, sf):
    """K2: minimal keys of up to three columns."""
    from vaultline.operators.ordered import union_all_by_name
    return union_all_by_name([catalog.key_combinations(_t(spark, sf, t), t, cols) for t, cols in KEY_SETS.items()])


INCLUSION = {"customer": ["c_custkey", "c_nationkey", "c_mktsegment"], "orders": ["o_orderkey", "o_custkey"],
             "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"], "part": ["p_partkey", "p_size", "p_brand"],
             "supplier": ["s_suppkey", "s_nationkey"], "nation": ["n_nationkey", "n_regionkey"]}


def _inclusion_sql() -> str:
    cols = [(t, c) for t, cs in INCLUSION.items() for c in cs]
    text = {"c_mktsegment", "p_brand"}
    pairs = [(a, b) for a in cols for b in cols if a != b and (a[1] in text) == (b[1] in text)]
    return " UNION ALL ".join(
        f"SELECT '{t}.{c}' AS dependent, '{u}.{d}' AS referenced, (SELECT count(DISTINCT {c}) FROM {t}) AS distinct_values, "
        f"(SELECT count(DISTINCT {d}) = count({d}) FROM {u}) AS is_unique WHERE (SELECT count(DISTINCT {c}) FROM {t}) >= 2 "
        f"AND NOT EXISTS (SELECT {c} FROM {t} WHERE {c} IS NOT NULL EXCEPT SELECT {d} FROM {u})" for (t, c), (u, d) in pairs)


@query("inclusion_dependencies", _inclusion_sql())
def q_inclusion_dependencies(spark, sf):
    """K4 without join conditions."""
    return catalog.inclusion_dependencies({t: _t(spark, sf, t).select(*cs) for t, cs in INCLUSION.items()})


# ====================================================================== Q2, Q15: counts across batches

@query("unique_index_load", """
SELECT l_orderkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_suppkey HAVING count(*) > 1""")
def q_unique_index_load(spark, sf):
    """Q2 over four batches and a replay: counts per key are kept in buckets and
    each batch adds its own."""
    li = _t(spark, sf, "lineitem")
    index = keyed.Bucketed(Snapshots(spark, scratch_path(spark, "unique")), "line_keys", ["l_orderkey", "l_suppkey"], n=16)
    for i in (0, 1, 1, 2, 3):
        index.add_counts(li.filter(F.col("l_linenumber") % 4 == i), f"b{i}")
    return index.read().filter("n > 1")


@query("distinct_bucketed", "SELECT DISTINCT user_id, event_type FROM events")
def q_distinct_bucketed(spark, sf):
    """S3's stored keys in buckets: a batch per weekday, one of them twice."""
    e = _t(spark, sf, "events")
    keys = keyed.Bucketed(Snapshots(spark, scratch_path(spark, "distinct")), "users", ["user_id", "event_type"], n=8)
    for i in (1, 2, 3, 3, 4, 5, 6, 7):
        keys.add_keys(e.filter(F.dayofweek("ts") == i), f"day {i}", compact_at=4)
    return keys.read()


# ====================================================================== M3: changes without a watermark

_NOW = """SELECT CASE WHEN c_custkey % 40 = 1 THEN c_custkey + 10000000 ELSE c_custkey END AS id, c_name AS name,
  CAST(c_acctbal AS DOUBLE) + CASE WHEN c_custkey % 25 = 2 THEN 1 ELSE 0 END AS balance
FROM customer WHERE c_custkey % 30 <> 3"""
_WAS = "SELECT c_custkey AS id, c_name AS name, CAST(c_acctbal AS DOUBLE) AS balance FROM customer"


@query("snapshot_diff", f"""
SELECT CASE WHEN w.id IS NULL THEN 'insert' WHEN n.id IS NULL THEN 'delete' ELSE 'update' END AS change,
  coalesce(n.id, w.id) AS id, coalesce(n.name, w.name) AS name, coalesce(n.balance, w.balance) AS balance
FROM ({_WAS}) w FULL OUTER JOIN ({_NOW}) n ON w.id = n.id
WHERE w.id IS NULL OR n.id IS NULL OR w.name IS DISTINCT FROM n.name OR w.balance IS DISTINCT FROM n.balance""")
def q_snapshot_diff(spark, sf):
    """M3 for a source without a watermark: inserts, updates and deletes against the stored rows."""
    _t(spark, sf, "customer").createOrReplaceTempView("_diff_customer")
    was, now = (spark.sql(q.replace("FROM customer", "FROM _diff_customer")) for q in (_WAS, _NOW))
    table = keyed.Bucketed(Snapshots(spark, scratch_path(spark, "diff")), "customer", "id", n=64)
    table.diff(was, "first")
    return table.diff(now, "second")


# ====================================================================== P1: tokens

SECRETS = {1: b"first secret of the example", 2: b"second secret of the example"}


def _token_sql(value: str, version: int) -> str:
    pads = hmac_pads(TokenVault(None, "customer", SECRETS).key("token", version))
    inner, outer = ("'" + "".join(f"\\x{b:02X}" for b in p) + "'::BLOB" for p in pads)
    return f"'v{version}_' || sha256({outer} || unhex(sha256({inner} || encode({value}))))"


@query("tokenize_roundtrip", f"""
WITH n AS (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey),
k AS (SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS id FROM customer)
SELECT {_token_sql('id', 1)} AS old_token, {_token_sql('id', 2)} AS token, id AS old_value, id AS value,
  coalesce(n_orders, 0) AS n_orders, false AS plain_digest FROM k LEFT JOIN n ON o_custkey = c_custkey""")
def q_tokenize_roundtrip(spark, sf):
    """P1 by tokens: two tables tokenized under the first secret still join, one is carried over to the
    second, and tokens of both versions read back."""
    store = Snapshots(spark, scratch_path(spark, "tokens"))
    first = TokenVault(store, "customer", {1: SECRETS[1]}, n=16)
    c = first.tokenize(_t(spark, sf, "customer").select(F.col("c_custkey").alias("id")), ["id"])
    o = first.tokenize(_t(spark, sf, "orders").select(F.col("o_custkey").alias("id")), ["id"])
    n = o.groupBy("id").agg(F.count(F.lit(1)).alias("n_orders"))
    both = (c.join(n, "id", "left").select(F.col("id").alias("old_token"), F.col("id").alias("token"),
                                           F.coalesce("n_orders", F.lit(0)).alias("n_orders")))
    second = TokenVault(store, "customer", SECRETS, n=16)
    both = second.rotate(both, ["token"])
    both = second.detokenize(both.withColumns({"old_value": F.col("old_token"), "value": F.col("token")}), ["old_value", "value"])
    digest = F.sha2(F.col("value"), 256)
    return both.withColumn("plain_digest", F.col("old_token").contains(digest) | F.col("token").contains(digest))


# ====================================================================== S2: keyed rules on a stream

KEYED_RULES = (Rule("l_quantity", "range", ("1", "45"), handling="log"),
               Rule(None, "unique_combination", ("l_orderkey", "l_suppkey")),
               Rule("l_suppkey", "chronology", ("l_shipdate", "l_orderkey", "l_linenumber")),
               Rule("l_shipdate", "unique", handling="log"))


@query("stream_keyed_dq", """
WITH m AS (SELECT *, l_quantity NOT BETWEEN 1 AND 45 AS r0, count(*) OVER (PARTITION BY l_orderkey, l_suppkey) > 1 AS r1,
  row_number() OVER (PARTITION BY l_suppkey, l_shipdate ORDER BY l_orderkey, l_linenumber) > 1 AND l_shipdate IS NOT NULL AS r2,
  count(*) OVER (PARTITION BY l_shipdate) > 1 AND l_shipdate IS NOT NULL AS r3 FROM lineitem)
SELECT l_orderkey, l_linenumber, concat_ws(',', CASE WHEN r0 THEN 'range:l_quantity' END, CASE WHEN r1 THEN 'unique_combination' END,
  CASE WHEN r2 THEN 'chronology:l_suppkey' END, CASE WHEN r3 THEN 'unique:l_shipdate' END) AS failed,
  CASE WHEN r1 OR r2 THEN 'quarantine' WHEN r0 OR r3 THEN 'log' ELSE 'pass' END AS dq_action FROM m""")
def q_stream_keyed_dq(spark, sf):
    """S2 with keyed rules over three micro-batches in no order of keys or times: equal to the batch rules."""
    from vaultline.streaming.keyed_rules import read_checked, stream_keyed_dq
    from vaultline.streaming.loads import micro_batches
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_quantity")
    target, lines = scratch_path(spark, "stream_keyed"), scratch_path(spark, "stream_lines")
    stream = micro_batches(li, lines, 3)
    stream_keyed_dq(stream, KEYED_RULES, target, scratch_path(spark, "stream_keyed_ckpt"), buckets=8)
    Snapshots(spark, target).drop([lines])  # all of it has been checked and stored
    return read_checked(spark, target, li.schema, KEYED_RULES).marked.select(
        "l_orderkey", "l_linenumber", F.array_join("failed_rules", ",").alias("failed"), "dq_action")


@query("stream_distinct_bucketed", "SELECT DISTINCT user_id, event_type FROM events")
def q_stream_distinct_bucketed(spark, sf):
    """S3 with its keys in buckets, over five micro-batches."""
    from vaultline.streaming.loads import micro_batches, stream_distinct_bucketed
    e = _t(spark, sf, "events").select("user_id", "event_type")
    store = Snapshots(spark, scratch_path(spark, "stream_buckets"))
    stream = micro_batches(e, scratch_path(spark, "stream_users"), 5)
    stream_distinct_bucketed(stream, e.columns, store, "users", scratch_path(spark, "stream_buckets_ckpt"), buckets=8, compact_at=3)
    return store.read("users")
