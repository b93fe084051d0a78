"""Metadata -> target specs -> one lazy DataFrame per target.

The metadata sheets are small and are read on the driver once; everything
they describe becomes DataFrame operations that Catalyst optimises as one
plan per target: scan -> filter (pushed into the scan) -> joins -> lookups ->
projection/casts -> aggregation -> DQ split -> sinks.
"""

from __future__ import annotations

import re
from collections import ChainMap
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.operators.aggregate import aggregate_rule
from vaultline.operators.joins import join_lookup
from vaultline.operators.quality import Split, cast_rule, enforce_runnable, mark_failures, null_rules, split, split_marked
from vaultline.operators.transform import cast_columns, fill_default, filter_rows
from vaultline.plans.rules import Rule, handling_in, parse_cell
from vaultline.plans.types import declared_length, is_string_type, to_spark_type
from vaultline.sources.snapshots import Snapshots


@dataclass
class LookupSpec:
    table: str
    on: list[tuple[str, str]]
    take: list[str]


@dataclass
class TargetSpec:
    name: str
    source: str
    columns: dict[str, str]                       # target column -> SQL over sources
    filter: str | None = None
    joins: list[tuple[str, str, str]] = field(default_factory=list)   # (source, condition, how)
    lookups: list[LookupSpec] = field(default_factory=list)
    aggregation: str | None = None
    types: dict[str, str] = field(default_factory=dict)
    defaults: dict[str, object] = field(default_factory=dict)
    rules: list[Rule] = field(default_factory=list)
    null_check_all: bool = False                  # the sample job's any-NULL quarantine
    expected_count: int | None = None
    load_mode: str = "full"
    watermark_column: str | None = None
    partition_cols: list[str] = field(default_factory=list)
    cast_handling: str = "quarantine"             # rows whose value failed its cast
    file_pattern: str | None = None               # files of the source, under the job's source_root


def _rows(sheet) -> list[dict]:
    """Metadata rows from a (small) DataFrame or from a list of dicts/Rows,
    with every canonical column present."""
    if sheet is None:
        return []
    raw = sheet.collect() if isinstance(sheet, DataFrame) else list(sheet)
    out = []
    for r in raw:
        d = r.asDict() if hasattr(r, "asDict") else dict(r)
        out.append(_Defaults(d))
    return out


class _Defaults(dict):
    """A metadata row where absent optional columns read as None."""

    def __missing__(self, key):
        return None


def specs_from_metadata(target_columns, mappings=None, loads=None, rules=None, source_columns=None) -> list[TargetSpec]:
    """Canonical sheets (see ``vaultline.metadata``; DataFrames or lists of
    row dicts) -> one spec per target table.

    - target_columns: ``transformation`` is the SQL for the column (a bare
      source column is the direct mapping); ``data_type`` becomes a cast;
      ``rule`` cells hold validations; ``partition_key`` marks partitions.
    - mappings (per ``target_table``): filter, ``join_condition`` as
      ``<source> ON <condition>`` or a plain condition naming tables,
      ``lookup_table`` as ``<table>(<col>=<lookup col>; ...) -> <take>, ...``,
      ``aggregation`` as ``SUM(x) AS y ... GROUP BY ...``.
      A row without a target table goes to the only target, else to the one
      its expression or source table names; no such target raises. ``target =
      expr`` fills a blank transformation. Repeated joins count once.
    - loads: load mode, watermark column, file pattern and error handling (of
      failed casts and of rules without a handling of their own) per target.
    - rules: validations with reject handling / severity / expected count.
    - source_columns: defaults of source columns fill the targets mapped straight
      from them; a column that is not nullable gives them a not-null rule.
    """
    tcols = _rows(target_columns)
    targets = list(dict.fromkeys(r["table_name"] for r in tcols))
    maps = [_Defaults({**m, "target_table": _target_of(m, targets, tcols)}) for m in _rows(mappings)]
    lds = {r["table_name"]: r for r in _rows(loads)}
    rls = _rows(rules)
    specs: dict[str, TargetSpec] = {}
    for r in sorted(tcols, key=lambda r: (r["load_order"] or 0, r["table_name"])):
        t = r["table_name"]
        m_rows = [m for m in maps if m["target_table"] == t]
        src = next((m["source_table"] for m in m_rows if m["source_table"]), None) or t
        spec = specs.setdefault(t, TargetSpec(name=t, source=src, columns={}))
        given = [m for m in (_ASSIGN.match(x["expression"] or "") for x in m_rows)
                 if m and m.group(2) == r["column_name"] and m.group(1) in (None, t)]
        spec.columns[r["column_name"]] = (r["transformation"] or (given[0].group(3) if given else r["column_name"])).strip()
        if r["data_type"]:
            to_spark_type(r["data_type"])          # fail early on unknown types
            spec.types[r["column_name"]] = r["data_type"]
        if r["partition_key"]:
            spec.partition_cols.append(r["column_name"])
        usual = handling_in(lds[t]["error_handling"]) if t in lds else None
        spec.cast_handling = usual or spec.cast_handling
        spec.rules += _typed_rules(parse_cell(r["rule"], r["column_name"], t, usual), r["data_type"])
    filters: dict[str, list[str]] = {t: [] for t in specs}
    for t, spec in specs.items():
        for m in (m for m in maps if m["target_table"] == t):
            if m["filter_condition"] and m["filter_condition"] not in filters[t]:
                filters[t].append(m["filter_condition"])
                spec.filter = (f"({spec.filter}) AND ({m['filter_condition']})" if spec.filter
                               else m["filter_condition"])
            if m["join_condition"] and (j := _join_of(m["join_condition"], spec.source)) not in spec.joins:
                spec.joins.append(j)
        for m in (m for m in maps if m["target_table"] == t):
            if m["lookup_table"]:
                if any(lk.table == m["lookup_table"].strip() for lk in spec.lookups):
                    continue
                lk, spec.joins = _lookup_of(m["lookup_table"], spec.joins)
                if lk not in spec.lookups:
                    spec.lookups.append(lk)
            if m["aggregation"]:
                spec.aggregation = m["aggregation"]
        ld = lds.get(t)
        if ld:
            spec.load_mode = (ld["load_mode"] or "full").lower()
            spec.watermark_column = ld["watermark_column"]
            spec.file_pattern = ld["file_pattern"]
        for r in rls:
            if r.get("table_name") in (None, t) and (r["column_name"] in spec.columns or r.get("table_name") == t):
                dtype = next((c["data_type"] for c in tcols
                              if c["table_name"] == t and c["column_name"] == r["column_name"]), None)
                usual = handling_in(ld["error_handling"]) if ld else None
                spec.rules += _typed_rules(parse_cell(r["rule"], r["column_name"], t, r.get("reject_handling") or usual,
                                                      r.get("severity")), dtype)
                if r.get("record_count_expected") is not None:
                    spec.expected_count = int(r["record_count_expected"])
    for spec in specs.values():
        spec.rules += _declared_length_rules(spec, tcols)
        _source_facts(spec, _rows(source_columns))
    return list(specs.values())


# [table.]target = expression, not a comparison of conditions.
_ASSIGN = re.compile(r"^\s*(?:(\w+)\.)?(\w+)\s*=(?!=)\s*(.+?)\s*$", re.DOTALL)


def _target_of(m: dict, targets: list[str], tcols: list[dict]) -> str | None:
    """The target table of a mapping row (the guide's sheet does not name it)."""
    if m["target_table"]:
        return m["target_table"]
    if len(targets) == 1:
        return targets[0]
    a = _ASSIGN.match(m["expression"] or "")
    if a and a.group(1) in targets:
        return a.group(1)
    owners = {r["table_name"] for r in tcols if a and r["column_name"] == a.group(2)}
    if len(owners) == 1:
        return owners.pop()
    if m["source_table"] in targets:
        return m["source_table"]
    raise ValueError(f"mapping row {m['rule_id'] or dict(m)!r}: its target table is not given and cannot be told")


def _source_facts(spec: TargetSpec, scols: list[dict]) -> None:
    """Default values and NOT NULL of the source columns a target maps directly."""
    tables = {spec.source, *(j[0] for j in spec.joins)}
    facts = {c["column_name"]: c for c in scols if c["table_name"] in tables}
    for target, expr in spec.columns.items():
        fact = facts.get(expr.split(".")[-1]) if re.fullmatch(r"(\w+\.)?[A-Za-z_]\w*", expr) else None
        if fact is None:
            continue
        if fact["default_value"] not in (None, "") and target not in spec.defaults:
            spec.defaults[target] = fact["default_value"]
        if fact["nullable"] is False and not any(r.kind == "not_null" and r.column == target for r in spec.rules):
            spec.rules.append(Rule(column=target, kind="not_null", text=f"not nullable {expr}", table=spec.name,
                                   handling=spec.cast_handling))


_LENGTH_KINDS = ("max_length", "min_length", "length_between")


def _typed_rules(rules: list[Rule], data_type: str | None) -> list[Rule]:
    """Length rules apply to string columns only: on a column declared with
    another type they are reported as malformed instead of run."""
    if not data_type or is_string_type(data_type):
        return rules
    return [replace(r, status="malformed", message=f"length rule on a {data_type} column")
            if r.kind in _LENGTH_KINDS and r.status == "ok" else r for r in rules]


def _declared_length_rules(spec: TargetSpec, tcols: list[dict]) -> list[Rule]:
    """A column declared VARCHAR(n) gets max_length(n) unless it already has one."""
    out = []
    for c in tcols:
        if c["table_name"] != spec.name:
            continue
        n = declared_length(c["data_type"] or "")
        has = any(r.kind == "max_length" and r.column == c["column_name"] for r in spec.rules)
        if n is not None and not has:
            out.append(Rule(column=c["column_name"], kind="max_length", args=(n,),
                            text=f"declared {c['data_type']}", table=spec.name))
    return out


_JOIN = re.compile(r"^\s*(?:(inner|left|right|full)(?:\s+outer)?\s+)?(?:join\s+)?(\w+)\s+on\s+(.+)$",
                   re.IGNORECASE | re.DOTALL)
_QUALIFIED = re.compile(r"(\w+)\.(\w+)")


def _join_of(text: str, source: str) -> tuple[str, str, str]:
    """``[LEFT [OUTER]] [JOIN] orders ON <condition>`` or a bare condition on
    qualified names (``orders.o_custkey = customer.c_custkey``)."""
    m = _JOIN.match(text)
    if m:
        return m.group(2), m.group(3).strip(), (m.group(1) or "inner").lower()
    tables = [t for t, _ in _QUALIFIED.findall(text) if t != source]
    if not tables:
        raise ValueError(f"join condition {text!r} names no other table")
    # Qualified names refer to DataFrame aliases set in build_target.
    return tables[0], text.strip(), "inner"


def _lookup_of(text: str, joins: list[tuple[str, str, str]]) -> tuple[LookupSpec, list[tuple[str, str, str]]]:
    """``nation(c_nationkey=n_nationkey) -> n_name``, or a bare table name
    whose keys come from the join condition that names it (that join is then
    done as the lookup: left, one row per key). Returns the lookup and the
    remaining joins."""
    m = re.match(r"^\s*(\w+)\s*\(([^)]*)\)\s*->\s*(.+)$", text)
    if m:
        on = [tuple(p.strip() for p in pair.split("=")) for pair in m.group(2).split(";") if pair.strip()]
        take = [c.strip() for c in m.group(3).split(",") if c.strip()]
        return LookupSpec(m.group(1), on, take), joins
    name = text.strip()
    if not re.fullmatch(r"\w+", name):
        raise ValueError(f"lookup {text!r}: expected a table name or 'table(col=lookup_col; ...) -> take, ...'")
    for j in joins:
        if j[0] != name:
            continue
        on = []
        for cond in re.split(r"\s+and\s+", j[1], flags=re.IGNORECASE):
            sides = [x.strip() for x in cond.split("=")]
            q = [_QUALIFIED.fullmatch(x) for x in sides]
            if len(sides) != 2 or not all(q):
                raise ValueError(f"lookup {name!r}: join condition {j[1]!r} is not an equi-join on table.column")
            own = [g.group(2) for g in q if g.group(1) == name]
            other = [g.group(2) for g in q if g.group(1) != name]
            on.append((other[0], own[0]))
        return LookupSpec(name, on, []), [x for x in joins if x is not j]
    raise ValueError(f"lookup {name!r}: no join condition names it")


CAST_FLAG = "_cast_failures"


def build_target(spec: TargetSpec, sources: Mapping[str, DataFrame], keep_cast_flag: bool = False) -> DataFrame:
    """Lazy transform for one target (no DQ). With ``keep_cast_flag`` the
    names of columns whose cast failed stay in ``_cast_failures`` for DQ."""
    df = sources[spec.source].alias(spec.source)
    # A filter on the source alone goes first, where an unqualified name cannot clash with a joined table's. Any
    # other waits for the joins; Catalyst pushes it to its table.
    early = all(how in ("inner", "left") for _, _, how in spec.joins) and _resolves(df, spec.filter)
    if early or not spec.joins:
        df = filter_rows(df, spec.filter, spec.name)
    for other, cond, how in spec.joins:
        df = df.join(sources[other].alias(other), F.expr(cond), how)
    if spec.joins and not early:
        df = filter_rows(df, spec.filter, spec.name)
    for lk in spec.lookups:
        take = lk.take or [c for c in sources[lk.table].columns if c not in {r for _, r in lk.on}]
        df = join_lookup(df, sources[lk.table], lk.on, take)
    df = df.select(*[(F.col(e) if e in df.columns else F.expr(e)).alias(c) for c, e in spec.columns.items()])
    if spec.defaults:
        df = fill_default(df, spec.defaults)
    if spec.types:
        df = cast_columns(df, spec.types, flag=CAST_FLAG)
        if not keep_cast_flag or spec.aggregation:
            df = df.drop(CAST_FLAG)
    if spec.aggregation:
        df = aggregate_rule(df, spec.aggregation)
    return df


def _resolves(df: DataFrame, condition: str | None) -> bool:
    try:
        df.filter(F.expr(condition or "true")).schema
        return True
    except AnalysisException:
        return False


def transform_only(specs: list[TargetSpec], sources: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """E10 without sinks: ``{target: DataFrame}``."""
    return {s.name: build_target(s, sources) for s in specs}


def checked_target(spec: TargetSpec, sources: Mapping[str, DataFrame], stored: DataFrame | None = None) -> Split:
    """Transform + DQ split for one target. Values that failed their declared
    type cast are rejects (``cast_failed``), not silent NULLs. ``stored``: what
    earlier batches wrote, with which unique keys must not clash."""
    df = build_target(spec, sources, keep_cast_flag=True)
    rules = list(spec.rules)
    has_flag = CAST_FLAG in df.columns
    if has_flag:
        rules.append(cast_rule(CAST_FLAG, spec.cast_handling))
    if spec.null_check_all:
        rules += null_rules([c for c in df.columns if c != CAST_FLAG])
    marked = mark_failures(df, rules, parents=sources, stored=stored)
    if has_flag:                 # consumed by the cast rule; every view derives from this frame
        marked = marked.drop(CAST_FLAG)
    return split(marked, rules)


def dq_suite(df: DataFrame, rules_sheet, table: str,
             parents: Mapping[str, DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """The validation suite of one table, from its rules or target sheet
    (DataFrame or row dicts with ``table_name, column_name, rule, ...``),
    run directly: ``(report, verdict)``. The report has one row per rule
    (unsupported and malformed included, with NULL failures); the verdict
    is derived from the report, so both come from one lineage."""
    from vaultline.operators.quality import rule_report, suite_verdict
    from vaultline.plans.rules import rules_from_rows
    rows = [r for r in _rows(rules_sheet) if r["table_name"] in (None, table)]
    report = rule_report(df, rules_from_rows(rows), parents)
    return report, suite_verdict(report)


def run_job(spark: SparkSession, specs: list[TargetSpec], sources: Mapping[str, DataFrame],
            targets: Mapping[str, str], quarantine_target: str | None, load_ts,
            state_path: str | None = None, batch_id: str | None = None,
            protection: DataFrame | None = None, key=None, source_root: str | None = None,
            store: Snapshots | None = None) -> list[dict]:
    """E10 (action): every target in load order; each is checked and written
    by ``write_checked`` (fail rules first, count check, quarantine).

    Targets whose load mode is incremental (and that name a watermark column
    of their driving source) take the source rows that ``plan_batch`` finds:
    past the watermark up to a bound, late rows at it, and rows without one.
    They go to the batch's own partition, unique keys are checked against the
    earlier batches too, and the state advances only after the write (M1-M3).

    A source that ``sources`` lacks is read by the target's file pattern under
    ``source_root``. Rules that cannot run are in every report; one of them
    that was to fail the job fails it before any write.

    With a ``protection`` sheet, flagged columns are masked or encrypted
    (``key``: a Column from configuration) in everything written, the scratch
    copy and the quarantine's row JSON included (P1-P3).

    With a ``store``, targets of full loads are tables of that name in it. They
    are staged one by one and change together, in one commit after the last: a
    job that fails, or is killed, half way leaves every table as it was."""
    from vaultline.operators.incremental import LOAD_BATCH, check_first, commit, path_exists, plan_batch, write_hashes
    from vaultline.sources.readers import scan_glob
    from vaultline.sources.writers import write_checked
    trouble = {spec.name: enforce_runnable(spec.rules, spec.name) for spec in specs}
    globbed = {s.source: scan_glob(spark, source_root, s.file_pattern) for s in specs
               if s.source not in sources and s.file_pattern and source_root}
    sources = ChainMap(globbed, sources)
    reports, staged, seen = [], {}, store.at() if store is not None else None
    for spec in specs:
        srcs, batch, stored = sources, None, None
        target = targets.get(spec.name, spec.name) if store is not None else targets[spec.name]
        if (spec.load_mode or "").startswith("incr") and spec.watermark_column and state_path:
            batch = plan_batch(sources[spec.source], spec.watermark_column, state_path, spec.name)
            if batch is None:
                reports.append({"table": spec.name, "clean_rows": 0, "valid": True, "quarantined": 0, "logged": 0,
                                "rule_problems": trouble[spec.name], "skipped": "no rows past the watermark"})
                continue
            if batch.first:
                check_first(spark, target)
            elif path_exists(spark, target):
                stored = spark.read.parquet(target).filter(F.col(LOAD_BATCH) != batch.label)
            # Overlay the bounded batch; other sources are looked up as given.
            srcs = ChainMap({spec.source: batch.rows}, sources)
        s = checked_target(spec, srcs, stored)
        if protection is not None:
            from vaultline.operators.protect import protect
            s = split_marked(protect(s.marked, protection, spec.name, key))
        if batch is not None:
            write_hashes(batch, state_path, spec.name)
        rep = write_checked(s, target, quarantine_target, spec.name, spec.expected_count, load_ts,
                            partition_cols=list(spec.partition_cols), batch=batch.label if batch else None,
                            load_batch=batch.label if batch else None, replace_all=batch is None or batch.first,
                            **({"store": store} if store is not None and batch is None else {}))
        if rep.get("entry") is not None:
            staged[target] = rep.pop("entry")
        rep["rule_problems"] = trouble[spec.name]
        if batch is not None:
            rep["null_watermarks"] = batch.nulls
            if rep["valid"]:
                commit(spark, state_path, spec.name, spec.watermark_column, batch.upper, batch.seq, rep["clean_rows"], batch_id)
                rep["watermark"] = batch.upper
        reports.append(rep)
    if staged:
        store.commit(seen, staged)
    return reports
