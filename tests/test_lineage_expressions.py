"""Lineage from analysed expressions and its closure; keys and relationships found in the data."""

import random
from itertools import combinations

from pyspark.sql import functions as F

from tests.conftest import rows
from vaultline.operators import catalog, lineage

SCHEMAS = {"a": "id int, x double, y string, s struct<p:int,q:int>", "b": "id int, z string", "c d": "id int"}


def edges_of(spark, sheet):
    cols = "rule_id string, target_table string, target_column string, source_table string, join_condition string, expression string"
    schemas = {t: spark.createDataFrame([], s) for t, s in SCHEMAS.items()}
    out = {}
    for r in lineage.expression_edges(spark.createDataFrame(sheet, cols), schemas).collect():
        out.setdefault(r["edge_id"][5:], []).append((r["source"], r["target"], r["direct"], r["matched"]))
    return {k: sorted(v, key=str) for k, v in out.items()}


def test_references_of_expressions(spark):
    on = "a.id = b.id"
    got = edges_of(spark, [
        ("1", "t", "o", "a", None, "CAST(x AS DECIMAL(9,2)) * 2"),
        ("2", "t", "o", "a", on, "CASE WHEN b.z = 'a.y = 1' THEN a.x ELSE length(a.y) END"),
        ("3", "t", "x", "a", None, None),
        ("4", "t", None, "a", None, "u.o = upper(y)"),
        ("5", "t", "o", "a", None, "sum(x) / count(*)"),
        ("6", "t", "o", "a", None, "'just text'"),
        ("7", "t", "o", "a", None, "nothing + 1"),
        ("8", "t", "o", "a", on, "id"),                       # ambiguous
        ("9", "t", "o", "a", None, "x +"),                    # no SQL
        ("10", "t", "o", "zzz", None, "x"),                   # unknown table
        ("11", "t", "o", "a", None, "b.z"),                   # the rule itself names the other table
        ("12", "t", "o", "a", None, "s.p + s.q"),
        ("13", "t", "o", "a", None, "transform(array(x), v -> v + id)[0]"),
        ("14", "t", None, "a", None, "x"),                    # no target
        ("15", None, None, "a", None, " k.o = a.x "),
        ("16", "t", "o", "a", None, "x == 1"),
    ])
    ok = lambda *src, target="t.o", direct=False: sorted([(s, target, direct, True) for s in src], key=str)
    bad = [(None, "t.o", False, False)]
    assert got["1"] == ok("a.x") and got["2"] == ok("a.x", "a.y", "b.z") and got["3"] == ok("a.x", target="t.x", direct=True)
    assert got["4"] == ok("a.y", target="u.o") and got["5"] == ok("a.x") and got["6"] == ok(None)
    assert got["7"] == got["8"] == got["9"] == got["10"] == bad
    assert got["11"] == ok("b.z", direct=True) and got["12"] == ok("a.s") and got["13"] == ok("a.id", "a.x")
    assert got["14"] == [("a.x", "t", True, False)] and got["15"] == ok("a.x", target="k.o", direct=True) and got["16"] == ok("a.x")


def test_closure_of_graphs(spark):
    rng = random.Random(1)
    chain = [(f"n{i}", f"n{i + 1}") for i in range(21)]
    cycle = [("p", "q"), ("q", "r"), ("r", "p"), ("self", "self")]
    net = [(f"m{rng.randrange(12)}", f"m{rng.randrange(12)}") for _ in range(18)]
    for pairs in (chain, cycle, net, chain + cycle + net + chain, []):
        df = spark.createDataFrame(pairs + [(None, "x"), ("x", None)], "source string, target string")
        reach = set(pairs)
        while True:
            more = reach | {(a, d) for a, b in reach for c, d in pairs if b == c}
            if more == reach:
                break
            reach = more
        assert rows(lineage.closure(df)) == sorted(reach, key=repr)


def brute_keys(data, cols, width):
    keys = []
    for w in range(1, width + 1):
        for s in combinations(range(len(cols)), w):
            vals = [tuple(r[i] for i in s) for r in data]
            if data and len(set(vals)) == len(vals) and all(v is not None for t in vals for v in t) and not any(set(k) <= set(s) for k in keys):
                keys.append(s)
    return sorted(",".join(cols[i] for i in k) for k in keys)


def test_key_combinations(spark):
    rng, cols = random.Random(2), ["a", "b", "c", "d", "e"]
    for n in (0, 1, 12, 60):
        data = [(rng.randrange(4), rng.randrange(5), rng.randrange(6), None if i == 3 else i, rng.randrange(40)) for i in range(n)]
        df = spark.createDataFrame(data, ", ".join(f"{c} int" for c in cols))
        got = catalog.key_combinations(df, "t", width=3)
        assert sorted(r["key_columns"] for r in got.collect()) == brute_keys(data, cols, 3)
    hot = spark.range(2000).select(F.lit(1).alias("x"), F.col("id").alias("y"), F.lit(None).cast("int").alias("z"))
    assert rows(catalog.key_combinations(hot, "t")) == [("t", "y", 1, 2000)]


def shuffle_bytes(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).length() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_"))


def test_key_combinations_leave_no_shuffles_behind(spark):
    n = 20_000
    df = spark.range(n).select(*[F.pmod(F.xxhash64(F.lit(i), F.col("id") % (n - 50)), F.lit(m)).alias(c)
                                 for i, (c, m) in enumerate(zip("abcd", (n, 1000, 500, 7)))], "id")
    before = shuffle_bytes(spark)
    found = catalog.key_combinations(df, "t")
    assert shuffle_bytes(spark) - before < 8 * n  # all sets' names together are over 20 names a row
    assert rows(found) == [("t", "id", 1, n)]
    assert rows(catalog.key_combinations(df.drop("id"), "t")) == []


def test_key_combinations_compare_values_where_names_collide(spark, monkeypatch):
    right = catalog._name_of
    monkeypatch.setattr(catalog, "_name_of", lambda columns: F.pmod(right(columns), F.lit(3)))
    rng, cols = random.Random(5), ["a", "b", "c"]
    data = [(i // 5, i % 5, rng.randrange(9)) for i in range(30)]
    got = catalog.key_combinations(spark.createDataFrame(data, "a int, b int, c int"), "t")
    assert sorted(r["key_columns"] for r in got.collect()) == brute_keys(data, cols, 3) != []


def test_inclusion_dependencies(spark):
    t = {"p": spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", None)], "id int, name string, f double"),
         "c": spark.createDataFrame([(1, "1", "a"), (2, "2", "b"), (2, "2", "a"), (None, None, None)], "pid long, txt string, n string"),
         "e": spark.createDataFrame([], "id int")}
    got = rows(catalog.inclusion_dependencies(t))
    assert got == [("c.n", "p.name", 2, True), ("c.pid", "p.id", 2, True)]  # numbers as text are no numbers
    assert rows(catalog.inclusion_dependencies({"c": t["c"]}, least_values=1)) == []
    assert rows(catalog.inclusion_dependencies({"e": t["e"]})) == []
