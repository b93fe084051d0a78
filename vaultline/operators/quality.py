"""Data-quality rules on DataFrames.

Row rules fold into ONE projection (an ``array<string>`` of failed rule
names per row) and ONE aggregation for counts, however many rules there are.
Keyed rules (unique, unique combination, relationships, chronology) need a
shuffle on their key: duplicate keys are found with a partial aggregation and
joined back (AQE splits a skewed key), chronology uses the skew-safe ordered lag.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultline.functions import checks
from vaultline.operators.ordered import ordered_lag
from vaultline.plans.rules import HANDLING_ORDER, Rule, named, problems

FAILED = "failed_rules"


class DataQualityError(RuntimeError):
    """Raised by ``fail_job`` rules before anything is written."""


# ---------------------------------------------------------------- row rules

def rule_predicate(rule: Rule, dtype: T.DataType | None = None) -> Column:
    """Column that is TRUE when the row fails ``rule`` (row rules only).
    ``dtype`` (the column's type, when known) keeps comparisons ANSI-safe:
    on a string column accepted values compare as written text, and numeric
    range bounds read the text with ``try_cast`` (text that is no number is
    outside any range; NULL passes) instead of failing the job."""
    c, a = rule.column, rule.args
    k = rule.kind
    is_text = isinstance(dtype, T.StringType)
    if k == "not_null":
        return checks.not_null(c)
    if k == "range":
        numeric = all(isinstance(x, (int, float)) or x is None for x in a)
        if is_text and numeric:
            value = F.col(c).try_cast("double")
            return (F.col(c).isNotNull() & value.isNull()) | checks.in_range(value, a[0], a[1])
        return checks.in_range(c, a[0], a[1])
    if k == "accepted_values":
        return checks.accepted(c, rule.extra.get("texts", a) if is_text else a)
    if k == "regex":
        return checks.matches(c, a[0])
    if k == "max_length":
        return checks.max_length(c, a[0])
    if k == "min_length":
        return checks.min_length(c, a[0])
    if k == "length_between":
        return checks.length_between(c, a[0], a[1])
    if k == "expression":
        return checks.is_true(a[0])
    if k == "hash_key_format":
        return checks.hash_key_format(c)
    if k == "not_blank":
        return checks.blank(c)
    if k == "cast_failed":                 # args: the array column cast_columns fills
        return F.size(F.col(a[0])) > 0
    raise ValueError(f"{rule.name} is not a row rule")


def cast_rule(flag: str = "_cast_failures", handling: str = "quarantine") -> Rule:
    """A row whose non-NULL value failed its type cast is rejected."""
    return Rule(column=None, kind="cast_failed", args=(flag,), text="castable to declared type",
                handling=handling)


def _dtype(df: DataFrame, col: str | None) -> T.DataType | None:
    return df.schema[col].dataType if col and col in df.columns else None


def null_rules(columns: Iterable[str], handling: str = "quarantine") -> list[Rule]:
    """The sample job's check: every column must be non-NULL (E2 any-null)."""
    return [Rule(column=c, kind="not_null", text="not null", handling=handling) for c in columns]


# ------------------------------------------------------------- keyed rules

def duplicate_keys(df: DataFrame, cols: Sequence[str], skip_nulls: bool = True) -> DataFrame:
    """Q2/Q15: key tuples that occur more than once, with their count ``n``.
    ``skip_nulls``: unique ignores NULL keys (a combination test keeps them)."""
    src = df
    if skip_nulls:
        src = checks_all_not_null(df, cols)
    return (src.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


def checks_all_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


def duplicates(df: DataFrame, col: str | Sequence[str]) -> DataFrame:
    """Q2: every row whose non-NULL key occurs more than once."""
    cols = [col] if isinstance(col, str) else list(col)
    dups = duplicate_keys(df, cols).select(*[F.col(c).alias(f"_d{i}") for i, c in enumerate(cols)])
    cond = F.lit(True)
    for i, c in enumerate(cols):
        cond = cond & (df[c] == dups[f"_d{i}"])
    return df.join(dups, cond, "left_semi")


def duplicate_combinations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q15: column combinations that are not unique (NULL is a value here)."""
    return duplicate_keys(df, list(cols), skip_nulls=False)


def chronology_failures(df: DataFrame, key, load_col: str, tie: Sequence[str] = (),
                        skew_safe: bool = True) -> DataFrame:
    """Rows whose load time is <= the previous load time of the same
    key (ascending order, so these are ties). Adds ``prev_<load_col>``."""
    keys = [key] if isinstance(key, str) else list(key)
    lagged = ordered_lag(df, keys, [load_col, *tie], [load_col], prefix="prev_", skew_safe=skew_safe)
    return lagged.filter(F.col(load_col) <= F.col(f"prev_{load_col}"))


def _keyed_flag(df: DataFrame, rule: Rule, parents: Mapping[str, DataFrame], tag: str,
                stored: DataFrame | None = None) -> tuple[DataFrame, Column]:
    """Attach what a keyed rule needs (columns that start with ``tag``) and
    return (df, failing-Column). ``stored``: rows of earlier batches, with which
    a unique key must not clash either."""
    if rule.kind in ("unique", "unique_combination"):
        cols = [rule.column] if rule.kind == "unique" else list(rule.args)
        skip = rule.kind == "unique"
        dups = duplicate_keys(df, cols, skip_nulls=skip)
        if stored is not None and all(c in stored.columns for c in cols):
            held = stored.select(*cols).withColumn("_n", F.lit(1)).groupBy(*cols).agg(F.lit(2).cast("bigint").alias("n"))
            dups = dups.unionByName(checks_all_not_null(held, cols) if skip else held).dropDuplicates(cols)
        dups = dups.select(*[F.col(c).alias(f"{tag}{i}") for i, c in enumerate(cols)], F.lit(True).alias(tag))
        cond = F.lit(True)
        for i, c in enumerate(cols):
            # unique ignores NULL keys, so plain equality; a combination
            # treats NULL as a value, so NULL-safe equality.
            eq = (df[c] == dups[f"{tag}{i}"]) if rule.kind == "unique" else df[c].eqNullSafe(dups[f"{tag}{i}"])
            cond = cond & eq
        out = df.join(dups, cond, "left").drop(*[f"{tag}{i}" for i in range(len(cols))])
        return out, F.coalesce(F.col(tag), F.lit(False))
    if rule.kind == "relationships":
        ptable, pcol = rule.args
        if ptable not in parents:
            raise ValueError(f"{rule.name}: parent table {ptable!r} not given")
        keys = parents[ptable].select(F.col(pcol).alias(f"{tag}0")).distinct().withColumn(tag, F.lit(True))
        out = df.join(keys, df[rule.column] == keys[f"{tag}0"], "left").drop(f"{tag}0")
        return out, F.col(rule.column).isNotNull() & F.col(tag).isNull()
    if rule.kind == "chronology":
        load_col = rule.args[0]
        tie = list(rule.args[1:])
        lagged = ordered_lag(df, [rule.column], [load_col, *tie], [load_col], prefix=f"{tag}_")
        return lagged, F.coalesce(F.col(load_col) <= F.col(f"{tag}_{load_col}"), F.lit(False))
    raise ValueError(f"{rule.name} is not a keyed rule")


def mark_failures(df: DataFrame, rules: Sequence[Rule], parents: Mapping[str, DataFrame] | None = None,
                  flag: str = FAILED, stored: DataFrame | None = None) -> DataFrame:
    """Add ``flag`` = array of names of the rules each row fails (empty
    array when it passes all). Unsupported/malformed rules are ignored here
    and reported by ``rule_report`` and by jobs. ``stored``: rows that earlier
    batches wrote, for unique keys."""
    parents = parents or {}
    rules = named(rules)
    out = df
    parts: list[Column] = []
    helper_cols: list[str] = []
    for i, r in enumerate(rules):
        if r.is_row_rule:
            parts.append(F.when(rule_predicate(r, _dtype(out, r.column)), F.lit(r.name)))
        elif r.is_keyed:
            before = set(out.columns)
            out, fails = _keyed_flag(out, r, parents, f"_k{i}_", stored)
            helper_cols += [c for c in out.columns if c not in before]
            parts.append(F.when(fails, F.lit(r.name)))
    arr = F.array_compact(F.array(*parts)) if parts else F.array().cast(T.ArrayType(T.StringType()))
    return out.withColumn(flag, arr).drop(*helper_cols)


# ------------------------------------------------------- reject handling

class Split(NamedTuple):
    clean: DataFrame          # passed, or failed only log rules
    quarantine: DataFrame     # failed a quarantine rule (and no fail_job rule)
    discarded: DataFrame      # failed a discard rule only (stored nowhere)
    failing: DataFrame        # failed a fail_job rule
    marked: DataFrame         # input + failed_rules + dq_action


def _has_any(names: Sequence[str], flag: str) -> Column:
    if not names:
        return F.lit(False)
    return F.arrays_overlap(F.col(flag), F.array(*[F.lit(n) for n in names]))


def action_column(rules: Sequence[Rule], flag: str = FAILED) -> Column:
    """Per row: the strongest handling among failed rules:
    fail_job > quarantine > discard > log; ``pass`` when nothing failed."""
    by = {h: sorted({r.name for r in named(rules) if r.effective_handling == h}) for h in HANDLING_ORDER}
    expr = F.when(F.size(F.col(flag)) == 0, F.lit("pass"))
    for h in HANDLING_ORDER:
        expr = expr.when(_has_any(by[h], flag), F.lit(h))
    return expr.otherwise(F.lit("log"))


def split(marked: DataFrame, rules: Sequence[Rule], flag: str = FAILED,
          action: str = "dq_action") -> Split:
    """One marked DataFrame, four filtered views. Writers that
    use two of them should persist ``marked`` first (see sources.writers)."""
    return split_marked(marked.withColumn(action, action_column(rules, flag)), action)


def split_marked(m: DataFrame, action: str = "dq_action") -> Split:
    """The four views of rows that already carry their action."""
    a = F.col(action)
    return Split(clean=m.filter(a.isin("pass", "log")).drop(action),
                 quarantine=m.filter(a == "quarantine").drop(action),
                 discarded=m.filter(a == "discard").drop(action),
                 failing=m.filter(a == "fail_job").drop(action),
                 marked=m)


def apply_rules(df: DataFrame, rules: Sequence[Rule], parents=None) -> Split:
    return split(mark_failures(df, rules, parents), rules)


def enforce_fail_rules(s: Split, table: str = "") -> None:
    """E6 (action): raise before any write if a fail_job rule failed."""
    bad = s.failing.limit(1).count()
    if bad:
        raise DataQualityError(f"table {table!r}: a fail_job rule failed; nothing written")


def enforce_runnable(rules: Sequence[Rule], table: str = "") -> list[dict]:
    """Q18 in a job: the rules that cannot run, for the report. One that was to
    fail the job fails it: nothing says that the data pass."""
    bad = [r for r in rules if r.status != "ok" and r.effective_handling == "fail_job"]
    if bad:
        raise DataQualityError(f"table {table!r}: fail_job rules that cannot run: {problems(bad)}")
    return problems(rules)


def to_quarantine_rows(rejected: DataFrame, table_name: str, load_ts, flag: str = FAILED) -> DataFrame:
    """Uniform quarantine rows for tables with different schemas:
    ``table_name, failed_rules, row_json, load_datetime``."""
    data_cols = [c for c in rejected.columns if c not in (flag, "dq_action")]
    ts = load_ts if isinstance(load_ts, Column) else F.lit(load_ts).cast("timestamp_ntz")
    return rejected.select(F.lit(table_name).alias("table_name"), F.col(flag).alias(flag),
                           F.to_json(F.struct(*data_cols)).alias("row_json"), ts.alias("load_datetime"))


def collect_quarantine(quarantines: Mapping[str, DataFrame], load_ts) -> DataFrame:
    """One quarantine DataFrame for many tables."""
    from vaultline.operators.ordered import union_all_by_name
    return union_all_by_name([to_quarantine_rows(q, t, load_ts) for t, q in sorted(quarantines.items())])


# -------------------------------------------------------------- summaries

def summarize(df: DataFrame, rules: Sequence[Rule], parents=None) -> DataFrame:
    """``test_name, failures`` for every runnable rule. All row rules
    are counted in ONE aggregation pass (``count_if`` each), then unpivoted;
    keyed rules add one aggregation each."""
    rules = named(rules)
    row = [r for r in rules if r.is_row_rule]
    keyed = [r for r in rules if r.is_keyed]
    parts: list[DataFrame] = []
    if row:
        names = [f"_r{i}" for i in range(len(row))]
        wide = df.agg(*[F.count_if(rule_predicate(r, _dtype(df, r.column))).alias(n) for r, n in zip(row, names)])
        cells = F.array(*[F.struct(F.lit(r.name).alias("test_name"), F.col(n).alias("failures")) for r, n in zip(row, names)])
        parts.append(wide.select(F.explode(cells).alias("c")).select("c.*"))
    for r in keyed:
        if r.kind in ("unique", "unique_combination"):
            cols = [r.column] if r.kind == "unique" else list(r.args)
            cnt = duplicate_keys(df, cols, skip_nulls=r.kind == "unique").agg(
                F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("failures"))
        else:
            marked = mark_failures(df, [r], parents, flag="_f")
            cnt = marked.agg(F.count_if(F.size("_f") > 0).alias("failures"))
        parts.append(cnt.select(F.lit(r.name).alias("test_name"), "failures"))
    if not parts:
        spark = df.sparkSession
        return spark.createDataFrame([], "test_name string, failures bigint")
    from vaultline.operators.ordered import union_all_by_name
    return union_all_by_name(parts)


def suite_verdict(summary: DataFrame) -> DataFrame:
    """E1 suite verdict from a ``summarize`` or ``rule_report`` result: one row
    ``success, failed_tests, failing_rows``. Success means that no test failed
    and that none could not run (its failures are NULL in a report)."""
    return summary.agg(
        ((F.coalesce(F.max("failures"), F.lit(0)) == 0) & (F.count_if(F.col("failures").isNull()) == 0)).alias("success"),
        F.count_if(F.col("failures") > 0).alias("failed_tests"),
        F.coalesce(F.sum("failures"), F.lit(0)).cast("bigint").alias("failing_rows"))


def rule_report(df: DataFrame | None, rules: Sequence[Rule], parents=None) -> DataFrame:
    """Q18: one row per rule, runnable or not: ``table_name, column_name,
    rule_text, rule_kind, status, message, failures`` (NULL failures for
    unsupported or malformed rules)."""
    from vaultline.operators.ordered import union_all_by_name  # noqa: F401
    spark = (df.sparkSession if df is not None else None)
    rules = named(rules)
    meta = spark.createDataFrame(
        [(r.table, r.column, r.text, r.kind, r.status, r.message, r.name if r.status == "ok" else None)
         for r in rules],
        "table_name string, column_name string, rule_text string, rule_kind string, "
        "status string, message string, test_name string")
    counts = summarize(df, rules, parents)
    # Rule list is metadata (one row per rule): a bounded broadcast.
    return (F.broadcast(meta).join(counts, "test_name", "left")
            .select("table_name", "column_name", "rule_text", "rule_kind", "status", "message",
                    F.col("failures").cast("bigint").alias("failures")))


# ------------------------------------------------------ vault checks (Q11-Q17)

def hash_key_failures(df: DataFrame, col: str) -> DataFrame:
    """Q11."""
    return df.filter(checks.hash_key_format(col))


def hub_integrity_failures(df: DataFrame, key: str) -> DataFrame:
    """Q12: business key NULL or blank."""
    return df.filter(checks.blank(key))


def link_failures(df: DataFrame, hub_keys: Sequence[str]) -> DataFrame:
    """Q13: any hub key NULL."""
    return df.filter(checks.any_null(hub_keys))


def record_source_failures(df: DataFrame, col: str, known: DataFrame, known_col: str = "record_source") -> DataFrame:
    """Q14: record source NULL, blank, or ``NOT IN (SELECT known_col ...)``
    with SQL's NULL rules (a NULL in the known list makes NOT IN never true).
    One pass over ``df`` and a join with the distinct known values."""
    values = known.select(F.col(known_col).alias("_rs")).distinct()
    list_has_null = values.filter(F.col("_rs").isNull()).exists()
    present = values.filter(F.col("_rs").isNotNull()).withColumn("_rs_hit", F.lit(True))
    j = df.join(present, df[col] == present["_rs"], "left")
    not_in = F.col("_rs_hit").isNull() & ~list_has_null
    return j.filter(checks.blank(col) | not_in).drop("_rs", "_rs_hit")


def audit_failures(df: DataFrame, ts_col: str = "load_datetime", source_col: str = "record_source") -> DataFrame:
    """Q16/Q17 as a one-pass summary: ``test_name, failures``."""
    # The two test names.
    return df.agg(F.count_if(F.col(ts_col).isNull()).alias("a"),
                  F.count_if(checks.blank(source_col)).alias("b")).selectExpr(
        "stack(2, 'load_datetime_not_null', a, 'record_source_not_null', b) as (test_name, failures)")
