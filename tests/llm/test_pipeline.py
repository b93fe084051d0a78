"""The pipeline stage by stage against brute force on the small tables."""

import re

import duckdb
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF001
from tests.llm.test_contracts import ODD, SCHEMA, base_counts, base_spans, brute_components, brute_fp, check_packing
from vaultline.llm.common import materialize


def test_stages(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns = docs.columns
    rows = {r["doc_id"]: r for r in docs.collect()}
    items = [" ".join(r[0].split()) for r in duckdb.sql(f"SELECT text FROM '{SF001}/benchmark.parquet'").fetchall()]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "dedup", "decontaminate", "pii", "pack"]
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, docs, SF001), f"test-{name}")
        got = {r["doc_id"]: r for r in out.collect()} if name != "pack" else None
        if name == "quality":  # too few labels here for a certified cutoff: the base rules decide
            assert set(got) == {d for d, r in rows.items() if not base_counts(r["text"])[-1]}
        elif name == "dedup":
            pairs = [(d, brute_fp(r["text"])) for d, r in rows.items()]
            assert set(got) == set(brute_components(pairs))
        elif name == "decontaminate":
            flat = {d: " ".join(r["text"].split()) for d, r in rows.items()}
            leaked = {d for d, t in flat.items() if any(i in t for i in items)}
            assert leaked.isdisjoint(got) and len(rows) - len(got) <= len(leaked) + 1
        elif name == "pii":
            assert set(got) == set(rows)
            for d, r in got.items():
                assert not base_spans(r["text"]) and r["n_chars"] == len(r["text"])
                assert bool(base_spans(rows[d]["text"])) == bool(re.search("<(EMAIL|IP|CARD|PHONE)>", r["text"]))
        else:
            check_packing(out.collect(), [(d, r["text"]) for d, r in rows.items()])
            break
        assert out.columns == columns
        docs, rows = out, got


def test_odd_rows(spark):
    docs = spark.createDataFrame(ODD, SCHEMA).withColumn("quality", F.lit("clash"))
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF001).count() >= (name != "quality")  # all of them fail a base rule
        assert stage(spark, docs.limit(0), SF001).count() == 0
