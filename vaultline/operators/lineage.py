"""Column lineage as node and edge tables (L1-L3).

Default mode reads ``target = source`` rules where either side may be
``table.column``; a bare column takes the table from the mapping row
(``target_table`` / ``source_table``). Rules that do not match are returned
(``matched = false``) instead of being skipped silently.

``literal`` mode reproduces the original naming rule: the rule must look like
``<x>_id = <y>``; the target column is ``<x>`` and every table name is the
text before the first ``_``.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultline.operators.ordered import union_all_by_name
from vaultline.session import scratch_path

# Our default rule shape: [table.]target = [table.]source.
_FULL = r"^\s*(?:(\w+)\.)?(\w+)\s*=\s*(?:(\w+)\.)?(\w+)\s*$"

# What literal mode and the lineage document must reproduce.
_LITERAL = r"^(\w+)_id\s*=\s*(\w+)"           # "<target>_id = <source>" rules only
DIRECT_MAPPING_LABEL = "direct mapping"           # edge label of an empty rule
NODE_TYPE, PARENT_TYPE = "Column", "Table"
SCRIPT_FORMAT = "python"
SCRIPT_PLACEHOLDER = "# Transformation logic not provided"


def edges(mappings: DataFrame, expr_col: str = "expression", mode: str = "full",
          include_unmatched: bool = True) -> DataFrame:
    """L1: ``edge_id, source, target, source_table, source_column,
    target_table, target_column, transformation, matched``. Rules that are no
    plain mapping come with ``matched = false`` and without ends, unless
    ``include_unmatched`` is off."""
    e = F.coalesce(F.trim(F.col(expr_col)), F.lit(""))
    cols = mappings.columns
    tt_default = F.col("target_table") if "target_table" in cols else F.lit(None).cast("string")
    st_default = F.col("source_table") if "source_table" in cols else F.lit(None).cast("string")
    if mode == "literal":
        tcol = F.regexp_extract(e, _LITERAL, 1)
        scol = F.regexp_extract(e, _LITERAL, 2)
        matched = e.rlike(_LITERAL)
        ttab = F.split(tcol, "_").getItem(0)
        stab = F.split(scol, "_").getItem(0)
    else:
        matched = e.rlike(_FULL)
        ttab = F.coalesce(F.nullif(F.regexp_extract(e, _FULL, 1), F.lit("")), tt_default)
        tcol = F.regexp_extract(e, _FULL, 2)
        stab = F.coalesce(F.nullif(F.regexp_extract(e, _FULL, 3), F.lit("")), st_default)
        scol = F.regexp_extract(e, _FULL, 4)
        matched = matched & ttab.isNotNull() & stab.isNotNull()
    stab, scol, ttab, tcol = (F.when(matched, c) for c in (stab, scol, ttab, tcol))
    rid = F.col("rule_id") if "rule_id" in cols else F.monotonically_increasing_id().cast("string")
    out = mappings.select(
        F.concat(F.lit("edge_"), rid.cast("string")).alias("edge_id"),
        F.concat(stab, F.lit("."), scol).alias("source"), F.concat(ttab, F.lit("."), tcol).alias("target"),
        stab.alias("source_table"), scol.alias("source_column"),
        ttab.alias("target_table"), tcol.alias("target_column"),
        F.when(e == "", F.lit(DIRECT_MAPPING_LABEL)).otherwise(e).alias("transformation"),
        matched.alias("matched"))
    return out if include_unmatched else out.filter("matched")


def _matched(edges_df: DataFrame) -> DataFrame:
    return edges_df.filter("matched") if "matched" in edges_df.columns else edges_df


def nodes(edges_df: DataFrame) -> DataFrame:
    """L2: one node per distinct ``table.column`` over both edge ends."""
    edges_df = _matched(edges_df)
    ends = edges_df.select(F.explode(F.array(
        F.struct(F.col("source").alias("id"), F.col("source_table").alias("table_name"),
                 F.col("source_column").alias("column_name")),
        F.struct(F.col("target").alias("id"), F.col("target_table").alias("table_name"),
                 F.col("target_column").alias("column_name")))).alias("n"))
    return ends.select("n.*").distinct()


def document(nodes_df: DataFrame, edges_df: DataFrame, per_target_table: bool = True) -> DataFrame:
    """L3: lineage document(s) as JSON text. One per target table (so each
    document stays small however many mappings there are), or one in all.
    Shape: ``{"codeGraph": {"nodes": [...], "edges": [...]}, "sourceProperties":
    [], "targetProperties": [], "script": {...}}``."""
    node_struct = F.struct(
        F.col("id"), F.lit(NODE_TYPE).alias("type"), F.col("column_name").alias("name"),
        F.struct(F.col("table_name").alias("id"), F.lit(PARENT_TYPE).alias("type"),
                 F.col("table_name").alias("name")).alias("parent"))
    edge_struct = F.struct(F.col("edge_id").alias("id"), "source", "target",
                           F.col("transformation").alias("label"), "transformation")
    doc_key = F.col("target_table") if per_target_table else F.lit("*")
    e = _matched(edges_df).withColumn("_doc", doc_key)
    if per_target_table:
        # Nodes of a document = both ends of its edges.
        ends = e.select("_doc", F.explode(F.array(
            F.struct(F.col("source").alias("id"), F.col("source_table").alias("table_name"),
                     F.col("source_column").alias("column_name")),
            F.struct(F.col("target").alias("id"), F.col("target_table").alias("table_name"),
                     F.col("target_column").alias("column_name")))).alias("n"))
        ends = ends.select("_doc", "n.*").distinct()
    else:
        ends = nodes_df.select(F.lit("*").alias("_doc"), "id", "table_name", "column_name")
    # Groups are metadata-sized (the mappings of one target table).
    node_lists = ends.groupBy("_doc").agg(F.sort_array(F.collect_list(node_struct)).alias("nodes"))
    edge_lists = e.groupBy("_doc").agg(F.sort_array(F.collect_list(edge_struct)).alias("edges"))
    empty = F.array().cast("array<string>")
    doc = node_lists.join(edge_lists, "_doc").select(
        F.col("_doc").alias("target_table"),
        F.to_json(F.struct(
            F.struct("nodes", "edges").alias("codeGraph"),
            empty.alias("sourceProperties"), empty.alias("targetProperties"),
            F.struct(F.lit(SCRIPT_FORMAT).alias("codeFormat"),
                     F.lit(SCRIPT_PLACEHOLDER).alias("placeholder")).alias("script"),
        )).alias("lineage_json"))
    return doc if per_target_table else doc.drop("target_table")


# ------------------------------------------------------------ expressions

# "[table.]target = expression"; "==" and comparisons are no assignment.
_ASSIGN = r"(?s)^\s*(?:(\w+)\.)?(\w+)\s*=(?![=>])\s*(.+?)\s*$"
_QUALIFIER = re.compile(r"\b([A-Za-z_]\w*)\s*\.\s*[A-Za-z_`]")
REFERENCES = ("scope string, rule string, refs array<struct<source_table string, source_column string>>, "
              "direct boolean, problem string")


def references(spark: SparkSession, rule: str, scope: list[str], schemas: Mapping[str, T.StructType]) -> tuple:
    """(refs, direct, problem) of one rule: the columns that the analysed
    expression refers to, as Spark resolved them over the tables in ``scope``;
    ``direct``: it is a bare column; ``problem``: why it could not be analysed."""
    unknown = [t for t in scope if t not in schemas]
    if unknown or not scope:
        return [], False, f"unknown table: {', '.join(unknown) or '(none)'}"
    # The scope is only analysed, never run: its join is of empty tables.
    tables = [spark.createDataFrame([], schemas[t]).alias(t) for t in scope]
    over = reduce(lambda a, b: a.join(b, F.lit(True)), tables)
    try:
        plan = over.select(F.expr(rule))._jdf.queryExecution().analyzed()
    except PySparkException as exc:
        return [], False, exc.getCondition() or type(exc).__name__
    seq, refs = plan.references().toSeq(), []
    for i in range(seq.size()):
        a = seq.apply(i)
        refs.append((a.qualifier().last() if a.qualifier().nonEmpty() else None, a.name()))
    bare = re.fullmatch(r"\s*(?:`?\w+`?\s*\.\s*)?`?\w+`?\s*", rule) is not None and len(refs) == 1
    return sorted(set(refs), key=str), bare, None


def expression_edges(mappings: DataFrame, schemas: Mapping[str, T.StructType | DataFrame], expr_col: str = "expression",
                     cond_col: str = "join_condition") -> DataFrame:
    """L1 for rules that are any SQL expression: one row per rule and source
    column that the rule's analysed expression refers to.

    ``target = expression`` names the target in the rule; otherwise the mapping
    row does (``target_table``, ``target_column``). In scope are the row's
    ``source_table``, the tables its join condition names and those that qualify a
    column in the rule. Blank rules map the column of the target's name. A rule that
    Spark cannot analyse (syntax, unknown or ambiguous column) comes as one row with
    ``matched = false`` and the reason in ``problem``; a rule without column
    references (a literal) as one row without a source.

    Each distinct (scope, rule) text is analysed once on the driver. That is
    metadata, as the schemas are; the sheet itself stays a DataFrame."""
    spark = mappings.sparkSession
    schemas = {t: s.schema if isinstance(s, DataFrame) else s for t, s in schemas.items()}
    cols = mappings.columns
    col_or_null = lambda c: F.col(c) if c in cols else F.lit(None).cast("string")
    text = F.coalesce(F.trim(F.col(expr_col)), F.lit(""))
    named = text.rlike(_ASSIGN)
    given = lambda i: F.when(named, F.nullif(F.regexp_extract(text, _ASSIGN, i), F.lit("")))
    rid = F.col("rule_id").cast("string") if "rule_id" in cols else F.monotonically_increasing_id().cast("string")
    target = F.coalesce(given(2), col_or_null("target_column"))
    tables = F.concat_ws(" ", col_or_null("source_table"), F.array_join(F.regexp_extract_all(
        F.coalesce(col_or_null(cond_col), F.lit("")), F.lit(r"(\w+)\s*\.\s*\w"), 1), " "))
    rules = mappings.select(
        rid.alias("rule_id"), F.coalesce(given(1), col_or_null("target_table")).alias("target_table"), target.alias("target_column"),
        F.array_join(F.array_sort(F.array_distinct(F.filter(F.split(tables, r"\s+"), lambda t: t != ""))), " ").alias("scope"),
        F.coalesce(given(3), F.nullif(text, F.lit("")), target, F.lit("")).alias("rule"),
        F.when(text == "", DIRECT_MAPPING_LABEL).otherwise(text).alias("transformation"))
    found = []
    for r in rules.select("scope", "rule").distinct().collect():  # distinct rule texts: metadata
        scope = r["scope"].split()
        scope += sorted(set(_QUALIFIER.findall(re.sub(r"'(?:[^'\\]|\\.)*'", "''", r["rule"]))) & set(schemas) - set(scope))
        found.append((r["scope"], r["rule"], *references(spark, r["rule"], scope, schemas)))
    facts = spark.createDataFrame(found, REFERENCES)
    one = F.explode_outer("refs").alias("ref")
    return (rules.join(facts, ["scope", "rule"]).select("rule_id", "target_table", "target_column", "transformation", "direct", "problem", one)
            .select(F.concat(F.lit("edge_"), "rule_id").alias("edge_id"),
                    F.concat_ws(".", "ref.source_table", "ref.source_column").alias("source"),
                    F.concat_ws(".", "target_table", "target_column").alias("target"),
                    "ref.source_table", "ref.source_column", "target_table", "target_column", "transformation", "direct",
                    (F.col("problem").isNull() & F.col("target_column").isNotNull() & F.col("target_table").isNotNull()).alias("matched"),
                    "problem")
            .withColumn("source", F.nullif(F.col("source"), F.lit(""))))


def closure(edges_df: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Everything that feeds a column, over any number of steps: (source,
    target) pairs of the transitive closure. Rounds join the newly found paths with
    all paths, so path lengths double and a chain of n steps takes log2(n) rounds;
    each round's pairs are distinct and written out. A round that finds no new
    pair ends it, so cycles end too (their columns feed themselves)."""
    spark = edges_df.sparkSession
    pairs = _matched(edges_df).filter("source IS NOT NULL AND target IS NOT NULL").select("source", "target").distinct()

    def written(df: DataFrame) -> DataFrame:
        path = scratch_path(spark, "closure")
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    delta = written(pairs)
    parts = [delta]
    for _ in range(max_rounds):
        every = union_all_by_name(parts)
        ahead = delta.select("source", F.col("target").alias("via")).join(every.select(F.col("source").alias("via"), "target"), "via")
        behind = every.select("source", F.col("target").alias("via")).join(delta.select(F.col("source").alias("via"), "target"), "via")
        new = ahead.unionByName(behind).select("source", "target").distinct().join(every, ["source", "target"], "left_anti")
        delta = written(new)
        if not delta.take(1):
            return every
        parts.append(delta)
    raise RuntimeError(f"paths longer than 2 ** {max_rounds}")
