"""Keys and relationships from metadata and data (K1-K4).

The column catalog is a DataFrame (``table_name, column_name, data_type``),
built from metadata sheets or from the schemas of the tables themselves.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.operators.ordered import union_all_by_name
from vaultline.session import shuffles_dropped

# Name words that mark an identifier column.
KEY_WORDS = ("id", "key", "code", "pk", "uuid", "guid")
# Literal mode reproduces a plain substring test on these words, excluding "date".
LITERAL_WORDS = ("id", "key", "code")
NAME_PARTS = 64  # one part of the names' range is looked at for all column sets before the rest for the sets left


def catalog_of(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Column catalog from the schemas of the given DataFrames."""
    rows = [(t, f.name, f.dataType.simpleString(), i)
            for t, df in tables.items() for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string, ordinal int")


def name_words(col) -> "F.Column":
    """Column name -> array of lower-case words (snake_case and camelCase)."""
    snake = F.regexp_replace(F.col(col) if isinstance(col, str) else col, "([a-z0-9])([A-Z])", "$1_$2")
    return F.filter(F.split(F.lower(snake), "[^a-z0-9]+"), lambda w: w != "")


def key_name_match(col="column_name", mode: str = "words") -> "F.Column":
    """K1 predicate on a column-name Column.

    ``words`` (default): a word of the name is one of KEY_WORDS or ends in
    'key' (custkey, orderkey). ``literal``: the name contains id/key/code as a
    substring and not 'date' - it also flags 'paid' or 'valid'."""
    c = F.lower(F.col(col) if isinstance(col, str) else col)
    if mode == "literal":
        hit = F.lit(False)
        for w in LITERAL_WORDS:
            hit = hit | c.contains(w)
        return hit & ~c.contains("date")
    words = name_words(col)
    return F.exists(words, lambda w: w.isin(*KEY_WORDS) | w.endswith("key"))


def is_key_name(name: str) -> bool:
    """K1's ``words`` rule for one name, on the driver (metadata)."""
    words = [w for w in re.split(r"[^a-z0-9]+", re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name).lower()) if w]
    return any(w in KEY_WORDS or w.endswith("key") for w in words)


def key_candidates(columns: DataFrame, mode: str = "words") -> DataFrame:
    """K1: catalog rows whose names look like identifiers."""
    return columns.filter(key_name_match("column_name", mode))


def profile_keys(df: DataFrame, table_name: str, columns: list[str] | None = None,
                 exact: bool = True, rsd: float = 0.05) -> DataFrame:
    """K2: per column ``rows, nulls, distinct_values, is_unique``. Exact: one
    count per value and column (partial counts before the shuffle, only that
    column is read), so a hot value is one row and nothing is expanded over the
    columns. ``exact=False`` estimates ``distinct_values`` (HLL, fixed memory per
    column) in one pass over all columns; ``is_unique`` is then NULL, not tested."""
    cols = columns or df.columns
    if exact:
        parts = [df.groupBy(F.col(f"`{c}`").alias("v")).agg(F.count(F.lit(1)).alias("n")).agg(
            F.lit(table_name).alias("table_name"), F.lit(c).alias("column_name"),
            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"),
            F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("nulls"),
            F.count("v").cast("bigint").alias("distinct_values")) for c in cols]
        long = union_all_by_name(parts)
        unique = (F.col("nulls") == 0) & (F.col("distinct_values") == F.col("rows"))
        return long.withColumn("is_unique", unique)
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(cols):
        aggs += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"_n{i}"), F.approx_count_distinct(f"`{c}`", rsd).alias(f"_d{i}")]
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("nulls"),
                               F.col(f"_d{i}").alias("distinct_values")) for i, c in enumerate(cols)])
    return (df.agg(*aggs).select("rows", F.explode(cells).alias("c"))
            .select(F.lit(table_name).alias("table_name"), "c.column_name", "rows", "c.nulls", "c.distinct_values",
                    F.lit(None).cast("boolean").alias("is_unique")))


def find_keys(df: DataFrame, table_name: str, columns: list[str] | None = None) -> DataFrame:
    """K2 for discovery: every column is tested exactly, so a true key is never
    denied by an estimate. One partially aggregated count per column."""
    return profile_keys(df, table_name, columns)


def _name_of(columns: Sequence[str]) -> "F.Column":
    """A 64-bit name of a row's values: other names, other values."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in columns])


def _shared(df: DataFrame, sets: Sequence[tuple[str, ...]], share: str) -> dict[tuple[str, ...], int]:
    """{set: a name that two rows have} of the names ``h`` that ``share`` holds for,
    in one scan; names are counted in part before they move."""
    names = F.array(*[F.struct(F.lit(i).alias("i"), _name_of(s).alias("h")) for i, s in enumerate(sets)])
    rows = df.select(F.inline(names)) if len(sets) > 1 else df.select(F.lit(0).alias("i"), _name_of(sets[0]).alias("h"))
    twice = rows.filter(share).groupBy("i", "h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return {sets[r["i"]]: r["h"] for r in twice.groupBy("i").agg(F.min("h").alias("h")).collect()}  # a row per set


def _repeating(df: DataFrame, shared: Mapping[tuple[str, ...], int]) -> set[tuple[str, ...]]:
    """The sets of ``shared`` with equal values in two rows: all values of the shared
    name are compared, in one scan. Where it stands for several, values are counted."""
    if not shared:
        return set()
    hit = {s: _name_of(s) == F.lit(h) for s, h in shared.items()}
    ends = []
    for i, (s, here) in enumerate(hit.items()):
        values = F.when(here, F.struct(*[F.col(f"`{c}`") for c in s]))
        ends.append(F.min(values).eqNullSafe(F.max(values)).alias(f"e{i}"))
    equal = df.filter(reduce(lambda x, y: x | y, hit.values())).agg(*ends).first()
    return {s for s, one in zip(shared, equal) if one or df.groupBy(*[f"`{c}`" for c in s]).count().filter("count > 1").take(1)}


def _keys_among(df: DataFrame, sets: Sequence[tuple[str, ...]]) -> list[tuple[str, ...]]:
    """The sets that tell all rows apart, exact. Equal values have equal names, so a
    name that two rows share in a part of the names' range shows at once that a set is no
    key: one scan of that part for all sets. Only the sets that it leaves open are
    looked at over the rest of the range, each by itself, so no shuffle holds more than a name a row."""
    if not sets:
        return []
    part = f"pmod(h, {NAME_PARTS}) = 0"
    gone, keys = _repeating(df, _shared(df, sets, part)), []
    for s in sets:
        if s not in gone and not _repeating(df, _shared(df, [s], f"NOT {part}")):
            keys.append(s)
    return keys


def key_combinations(df: DataFrame, table_name: str, columns: Sequence[str] | None = None, width: int = 3) -> DataFrame:
    """K2 for composite keys: the minimal sets of at most ``width`` columns, none
    of them NULL in any row, whose values tell all rows apart. Level by level: a
    set is tested only if no part of it is a key (it would not be minimal). Most sets fall in
    one scan of the level, the others take a scan each. Every test is exact. An empty table has no keys."""
    spark = df.sparkSession
    columns = sorted(columns or df.columns)
    counts = df.agg(F.count(F.lit(1)), *[F.count(f"`{c}`") for c in columns]).first()
    n, usable = counts[0], [c for c, there in zip(columns, counts[1:]) if there == counts[0]]
    keys: list[tuple[str, ...]] = []
    with shuffles_dropped(spark):
        for size in range(1, min(width, len(usable)) + 1 if n else 1):
            keys += _keys_among(df, [s for s in combinations(usable, size) if not any(set(k) <= set(s) for k in keys)])
    return spark.createDataFrame([(table_name, ",".join(k), len(k), n) for k in keys],
                                 "table_name string, key_columns string, width int, rows long")


def _comparable(df: DataFrame, table: str) -> list[tuple[str, "F.Column"]]:
    """(column, its values as text) of the columns whose values can be compared
    across tables: whole numbers, text, dates. The kind is part of the text."""
    out = []
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        kind = "n" if t in ("tinyint", "smallint", "int", "bigint") else "s" if t in ("string",) or t.startswith("varchar") else (
            "d" if t == "date" else None)
        if kind:
            out.append((f"{table}.{f.name}", F.concat(F.lit(f"{kind}:"), F.col(f"`{f.name}`").cast("string"))))
    return out


def inclusion_dependencies(tables: Mapping[str, DataFrame], columns: Sequence[str] | None = None,
                           least_values: int = 2) -> DataFrame:
    """K4 for relationships that no join condition spells out: pairs of columns
    (``table.column``) where every value of the dependent column occurs in the
    referenced one: ``dependent, referenced, distinct_values, is_unique`` (the
    referenced column has no value twice: a likely foreign key). Columns with
    fewer than ``least_values`` values say nothing and are left out as dependents.

    Each table is read once. Its columns become distinct (value, column) rows with
    counts; per value the set of columns it occurs in is built, equal sets are counted
    together, and a dependency holds where the counts of the sets with both
    columns reach the dependent's number of values. No pair of columns is joined."""
    listed, parts = [], []
    for table, df in tables.items():
        cells = [(n, v) for n, v in _comparable(df, table) if columns is None or n in columns]
        if not cells:
            continue
        at = len(listed)
        listed += [n for n, _ in cells]
        parts.append(df.select(F.inline(F.array(*[F.struct(F.lit(at + i).alias("c"), v.alias("v")) for i, (_, v) in enumerate(cells)])))
                     .filter("v IS NOT NULL").groupBy("c", "v").agg(F.count(F.lit(1)).alias("n")))
    values = union_all_by_name(parts)
    # Of one value: at most as many entries as there are columns.
    sets = values.groupBy("v").agg(F.array_sort(F.collect_list(F.struct("c", (F.col("n") > 1).alias("twice")))).alias("s"))
    counted = sets.groupBy("s").agg(F.count(F.lit(1)).alias("n"))
    met = counted.select("n", "s", F.explode("s").alias("d")).select("n", F.col("d.c").alias("d"), F.explode("s").alias("r"))
    pairs = met.groupBy("d", F.col("r.c").alias("r")).agg(F.sum("n").alias("both"))
    own = met.filter("d = r.c").groupBy("d").agg(F.sum("n").alias("own"), F.max("r.twice").alias("twice"))
    names = F.array(*[F.lit(n) for n in listed])
    return (pairs.filter("d <> r").join(own.select("d", "own"), "d").filter(f"both = own AND own >= {int(least_values)}")
            .join(own.select(F.col("d").alias("r"), "twice"), "r")
            .select(F.get(names, F.col("d")).alias("dependent"), F.get(names, F.col("r")).alias("referenced"),
                    F.col("own").alias("distinct_values"), (~F.col("twice")).alias("is_unique")))


def satellite_groups(columns: DataFrame, key_flag: str = "is_key") -> DataFrame:
    """K3: per table, the sorted list of non-key columns (satellite attributes)."""
    return (columns.filter(~F.coalesce(F.col(key_flag), F.lit(False)))
            .groupBy("table_name")
            .agg(F.sort_array(F.collect_list("column_name")).alias("attributes")))


# "a.x = b.y" pairs in a join condition; several may be joined by AND.
_PAIR = r"(\w+)\.(\w+)\s*=\s*(\w+)\.(\w+)"


def relationships(mappings: DataFrame, cond_col: str = "join_condition") -> DataFrame:
    """K4: one row per ``left_table.left_column = right_table.right_column``
    found in the mapping's join conditions (the join text itself is left to
    Spark SQL when the join runs)."""
    pairs = F.regexp_extract_all(F.col(cond_col), F.lit(_PAIR), 0)
    exploded = mappings.select(F.col("rule_id"), F.posexplode(pairs).alias("pair_no", "pair"))
    part = lambda i: F.regexp_extract("pair", _PAIR, i)
    return exploded.select("rule_id", "pair_no",
                           part(1).alias("left_table"), part(2).alias("left_column"),
                           part(3).alias("right_table"), part(4).alias("right_column"))
