"""Operators 11 to 13 against brute force written from the contract, and odd inputs."""

import hashlib
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tests.llm.test_contracts import ODD, SCHEMA
from vaultline.llm import centroids, fim, suffix_index, toxicity
from vaultline.llm.queries import ORACLES, QUERIES
from vaultline.session import scratch_path


@pytest.fixture(scope="module")
def texts():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF001}/documents.parquet'").fetchall()


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).withColumn("key", F.lit(1)).withColumn("body", F.lit(2)).withColumn("n", F.lit(3))


# ---------------------------------------------------------------- 11 suffix arrays

def brute_removed(rows, need):
    """(n_bytes, n_removed, n_spans, kept_sha256) of each text, all windows compared."""
    raws = [(t or "").encode() for t in rows]
    seen = {}
    for r in raws:
        for p in range(len(r) - need + 1):
            w = r[p:p + need]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for r in raws:
        gone = np.zeros(len(r), bool)
        for p in range(len(r) - need + 1):
            if seen[r[p:p + need]] > 1:
                gone[p:p + need] = True
        starts = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(r) else 0
        kept = bytes(np.frombuffer(r, np.uint8)[~gone])
        out.append((len(r), int(gone.sum()), starts, hashlib.sha256(kept).hexdigest()))
    return out


def removed(spark, rows, need=suffix_index.NEED, core=suffix_index.CORE, **kw):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string")
    got = suffix_index.remove_repeats(docs, scratch_path(spark, "family"), need=need, core=core, **kw).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(len(rows)))
    for r in got:
        assert hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] and len(r["kept"]) == r["n_bytes"] - r["n_removed"]
    return [tuple(r)[1:5] for r in sorted(got, key=lambda r: r["doc_id"])]


def test_repeats_of_the_tables(spark, texts):
    got = sorted(map(tuple, QUERIES["op11_logarithmic_suffix_dedup"](spark, SF001).collect()))
    want = [(d, *w) for (d, _), w in zip(texts, brute_removed([t for _, t in texts], 400))]
    assert got == sorted(want) and sum(w[2] for w in want) > 50


def mutated(rng, text, n):
    t = list(text)
    for _ in range(n):
        t[rng.randrange(len(t))] = rng.choice("abcé ")
    return "".join(t)


@pytest.mark.parametrize("seed", range(3))
def test_repeats_with_small_windows(spark, seed):
    """Shared passages cut anywhere, near copies, periodic texts, and repeats within a text."""
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    passages = [word(rng.randrange(40, 300)) for _ in range(6)]
    rows = [None, "", "x" * 39, "x" * 40, "x" * 41, "ab" * 300, "ab" * 100 + "c" + "ab" * 100, passages[0], passages[0]]
    for _ in range(60):
        p = rng.choice(passages)
        a, b = sorted(rng.randrange(len(p) + 1) for _ in range(2))
        rows.append(word(rng.randrange(80)) + p[a:b] + word(rng.randrange(80)) + rng.choice(["", p[:b]]))
    base = word(900)
    rows += [mutated(rng, base, rng.randrange(6)) for _ in range(20)]
    assert removed(spark, rows, need=40, core=16) == brute_removed(rows, 40)
    assert removed(spark, rows, need=70, core=16, batches=1) == brute_removed(rows, 70)


def test_sampling_depends_on_windows_alone():
    rng = np.random.default_rng(1)
    for raw in (rng.integers(97, 101, 3000).astype(np.uint8), np.full(900, 97, np.uint8), np.tile(np.frombuffer(b"abc", np.uint8), 300)):
        chosen = {}
        at, first, last = suffix_index.sampled(raw, 60, 20)
        assert first[0] == 0 and last[-1] == len(raw) - 60 and (first[1:] == last[:-1] + 1).all()
        for a, lo, hi in zip(at, first, last):
            for p in range(lo, hi + 1):
                assert 0 <= a - p <= 40
                assert chosen.setdefault(raw[p:p + 60].tobytes(), a - p) == a - p


def test_sampling_across_chunks(monkeypatch):
    raw = np.random.default_rng(2).integers(97, 123, 5000).astype(np.uint8)
    raw[1000:1800] = 97
    whole = suffix_index.sampled(raw, 60, 20)
    monkeypatch.setattr(suffix_index, "CHUNK", 130)
    suffix_index._POWERS.clear()
    parts = suffix_index.sampled(raw, 60, 20)
    suffix_index._POWERS.clear()
    assert all((a == b).all() for a, b in zip(whole, parts))


def test_family_levels_replay_and_recovery(spark):
    """Levels merge as their sizes meet; a replay adds nothing; an uncommitted batch is no part of the family."""
    rng = random.Random(5)
    shared = "".join(rng.choice("abcdef ") for _ in range(200))
    rows = [f"{shared[:150 + i]} own text number {i} " + "".join(rng.choice("ghijkl") for _ in range(90)) for i in range(14)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    path = scratch_path(spark, "family")
    sizes = []
    for i in range(7):
        suffix_index.SuffixFamily(spark, path, 40, 16).add(docs.filter(F.col("doc_id") % 7 == i), f"b{i}")
        family = suffix_index.SuffixFamily(spark, path, 40, 16)
        sizes.append([e.batches for e in family.levels()])
    assert sizes == [[1], [2], [2, 1], [4], [4, 1], [4, 2], [4, 2, 1]]
    before = sorted(map(tuple, family.matches().collect()))
    family.add(docs.filter("doc_id % 7 = 3"), "b3")
    # A crash before the manifest: files of the next number are there, and written over later.
    docs.limit(1).write.parquet(f"{path}/level/000008")
    docs.limit(1).write.parquet(f"{path}/batch/000008")
    assert sorted(map(tuple, family.matches().collect())) == before and [e.batches for e in family.levels()] == [4, 2, 1]
    found = suffix_index.spans(family, docs)
    got = sorted(map(tuple, suffix_index.cut(docs, found, keep=False).collect()))
    assert got == [(i, *w) for i, w in enumerate(brute_removed(rows, 40))]
    family.add(spark.createDataFrame([(99, shared)], "doc_id long, text string"), "late")
    more = docs.unionByName(spark.createDataFrame([(99, shared)], "doc_id long, text string"))
    got = sorted(map(tuple, suffix_index.cut(more, suffix_index.spans(family, more), keep=False).collect()))
    assert got == [(i, *w) for i, w in zip([*range(14), 99], brute_removed(rows + [shared], 40))]
    with pytest.raises(ValueError):
        suffix_index.SuffixFamily(spark, path).levels()


def test_suffix_odd_rows(spark, odd):
    got = suffix_index.remove_repeats(odd, scratch_path(spark, "family")).collect()
    assert sorted(tuple(r)[1:5] for r in got) == sorted(brute_removed([r[1] for r in ODD], 400))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted((r[0] is None, r[0] or 0) for r in ODD)
    none = suffix_index.remove_repeats(odd.limit(0), scratch_path(spark, "family"))
    assert none.count() == 0 and none.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]


# ---------------------------------------------------------------- 12 centroids

def brute_clusters(rows, k, rounds, dim):
    kept = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    start = sorted(((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None))[:k]
    cs = [list(v) for _, v in start]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cs))
    for _ in range(rounds):
        of = [near(v)[1] for _, v in kept]
        for j in range(len(cs)):
            mine = [v for (_, v), o in zip(kept, of) if o == j]
            if mine:
                cs[j] = [sum(c) // len(mine) for c in zip(*mine)]
    return [(i, near(v)[1], near(v)[0]) for i, v in kept], cs


def test_clusters_of_the_tables(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF001}/embeddings.parquet'").fetchall()
    want, cs = brute_clusters(rows, 40, 5, 64)
    got = QUERIES["op12_laesa_clusters"](spark, SF001).collect()
    assert sorted((r["vec_id"], r["cluster"], r["distance"]) for r in got) == sorted(want)
    total = sum(w[2] for w in want)
    for r in got:
        assert r["inertia"] == total and r["cluster_inertia"] == sum(w[2] for w in want if w[1] == r["cluster"])
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, cs[r["cluster"]])).encode()).hexdigest()


def test_clusters_with_ties_and_odd_rows(spark):
    """Equal distances take the smaller number; empty clusters stay; odd vectors go."""
    rng = random.Random(3)
    rows = [(i, [rng.randrange(-2, 3) / 256.0 for _ in range(4)]) for i in range(400)]
    rows += [(1000, [0.0, 0.0, float("nan"), 0.0]), (1001, [0.0, float("inf"), 0.0, 0.0]), (1002, [0.0, None, 0.0, 0.0]),
             (1003, [0.0] * 3), (1004, None), (1005, []), (None, [0.001] * 4), (None, [0.001] * 4), (7, rows[7][1]), (8, [9.0] * 4)]
    schema = "vec_id long, embedding array<float>, v string, pd string"
    vectors = spark.createDataFrame([(*r, "x", "y") for r in rows], schema)
    for k in (1, 5, 40, 1000):
        want, cs = brute_clusters(rows, k, 3, 4)
        found = centroids.cluster(vectors, dim=4, k=k, rounds=3)
        assert sorted(map(tuple, found.assigned.collect()), key=repr) == sorted(want, key=repr)
        assert found.centroids.tolist() == cs
    assert centroids.with_inertia(centroids.cluster(vectors.limit(0), dim=4)).count() == 0
    assert centroids.cluster(vectors.filter("vec_id IS NULL"), dim=4).assigned.count() == 0
    huge = spark.createDataFrame([(1, [1e30] * 4), (2, [1.0] * 4)], "vec_id long, embedding array<float>")
    assert [r["vec_id"] for r in centroids.cluster(huge, dim=4).assigned.collect()] == [2]


def test_pivots_spare_exact_distances():
    rng = np.random.default_rng(4)
    cs = rng.integers(-400, 400, (40, 64))
    v = cs[rng.integers(0, 40, 2000)] + rng.integers(-9, 10, (2000, 64))
    pivots = centroids.choose_pivots(cs)
    number, best, spent = centroids.nearest(v, centroids._to_pivots(v, pivots), cs, centroids._to_pivots(cs, pivots))
    d = ((v[:, None] - cs[None]) ** 2).sum(axis=2)
    assert (number == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all() and spent < 0.5 * d.size


# ---------------------------------------------------------------- 13 fill in the middle

def brute_fim(doc_id, text):
    t = text or ""
    n = len(t)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not t or "<P>" in t or "<S>" in t or "<M>" in t or h[2] % 100 >= 90:
        form, out = "plain", t
    elif h[3] % 100 < 20:
        form, out = "spm", "<S>" + t[b:] + "<P>" + t[:a] + "<M>" + t[a:b]
    else:
        form, out = "psm", "<P>" + t[:a] + "<S>" + t[b:] + "<M>" + t[a:b]
    plain = form == "plain"
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, n, form, None if plain else a, None if plain else b - a, sha(out), sha(t)), out


def test_fim_of_the_tables(spark, texts):
    got = sorted(map(tuple, QUERIES["op13_frame_fill_in_middle"](spark, SF001).collect()))
    assert got == sorted(brute_fim(d, t)[0] for d, t in texts)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("frame", [1, 2, 3, 7, 64])
def test_fim_small_frames(spark, frame):
    """Cuts and markers on and across frame borders; texts of marker pieces."""
    rng = random.Random(frame)
    rows = [(i, "".join(rng.choice("<PSM>aé€𝄞\n") for _ in range(rng.randrange(40)))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made = fim.transform(fim.store(docs, frame=frame))
    want = [brute_fim(*r) for r in rows]
    assert sorted(map(tuple, made.drop("units", "ends", "data").collect())) == sorted(w[0] for w in want)
    assert sorted(map(tuple, fim.read_output(made).collect())) == sorted((r[0], w[1]) for r, w in zip(rows, want))
    assert sorted(map(tuple, fim.read_output(made, restored=True).collect())) == sorted(rows)


def test_fim_decompresses_only_cut_frames(monkeypatch):
    text = "".join(chr(97 + i % 26) for i in range(1000))
    f = fim.Frames.of(text, 10)
    opened = []
    whole = fim.Frames.frame
    monkeypatch.setattr(fim.Frames, "frame", lambda self, i: opened.append(i) or whole(self, i))
    out = fim.rearrange(f, fim.Cut("psm", 123, 457))
    assert set(opened) == {12, 45}
    assert "".join(out.stream()) == f"<P>{text[:123]}<S>{text[457:]}<M>{text[123:457]}"
    assert "".join(fim.restore(out, "psm")) == text and out.ends[-1] == len(out.data) and out.n == 1009


def test_fim_odd_rows(spark, odd):
    got = fim.fill_in_middle(odd)
    assert sorted(map(tuple, got.drop("units", "ends", "data").collect()), key=repr) == sorted(
        (brute_fim(r[0], r[1])[0] for r in ODD), key=repr)
    assert sorted(map(tuple, fim.read_output(got, restored=True).collect()), key=repr) == sorted(
        ((r[0], r[1] or "") for r in ODD), key=repr)
    assert fim.fill_in_middle(odd.limit(0)).count() == 0


def test_sql_is_registered_where_it_can_be():
    assert {"op12_laesa_clusters", "op13_frame_fill_in_middle"} <= set(ORACLES)


# ---------------------------------------------------------------- 7 packing: memory of the search

def test_packing_search_stays_small():
    """20,000 lengths of 300 to 2,400: the search held 0.7 GB of reachability tables at once."""
    import tracemalloc
    from collections import Counter

    from vaultline.llm import packing
    rng = random.Random(1)
    counts = dict(Counter(rng.randrange(300, 2400) for _ in range(20_000)))
    tracemalloc.start()
    plan, _ = packing.search(counts, nodes=1500)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    held = Counter()
    for many, pattern in plan:
        assert sum(n * u for n, u in pattern) <= packing.CAPACITY
        held.update({n: many * u for n, u in pattern})
    assert held == counts and peak < 100e6


def test_packing_search_does_not_depend_on_open_enumerations(monkeypatch):
    """Enumerations that are made anew go on where they were."""
    from collections import Counter

    from vaultline.llm import packing
    for seed in range(6):
        rng = random.Random(seed)
        counts = dict(Counter(rng.randrange(10, 70) for _ in range(40)))
        found = []
        for live in (1, 8, 10 ** 6):
            monkeypatch.setattr(packing, "LIVE", live)
            found.append(packing.search(counts, 100, 400))
        assert found[0] == found[1] == found[2]


def test_toxic_candidates_by_odds(spark):
    """A token that many clean documents hold too may still tell; no token that passes a bar is left out."""
    n1, n0 = 5_000, 45_000
    shares = (0.0, 0.001, 0.01, 0.1, 0.3, 0.5, 0.7, 0.9, 0.99, 1.0)
    rows = [(f"t{i}x{j}", int(a * n1), int(b * n0)) for i, a in enumerate(shares) for j, b in enumerate(shares)]
    counts = spark.createDataFrame([*rows, ("", n1, n0)], "token string, c1 long, c0 long")
    got = {r["token"] for r in toxicity.candidates(counts, n1, n0).collect()}
    assert "t7x5" in got and "" not in got  # 90 % against 50 %
    found = {t: (c1, c0, c1 + c0) for t, c1, c0 in rows if c1 + c0 >= toxicity.MIN_COUNT}
    passed = {t for bar in toxicity.BARS for t in toxicity.log_odds(found, (n1, n0, n1 + n0), (10 ** 7, 10 ** 8), bar)[0]}
    assert passed and passed <= got


def test_toxic_evidence_by_document(spark):
    """Evidence made from the written segment scores equals that of each document alone."""
    rows = [(0, 10, []), (1, 5, [3.0]), (2, 400, [1.5, 9.0, 4.0]), (0, 0, [])]
    segments = spark.createDataFrame([(0, t, n, f) for t, n, f in rows], "option int, toxic int, n long, found array<double>")
    told = sorted((r["toxic"], r["x"]) for r in toxicity.weigh(segments, 0.8, -1.0).collect())
    want = sorted((t, toxicity.squash(toxicity.evidence(n, [(0, 0, s) for s in f], 0.8, -1.0))) for t, n, f in rows)
    assert [t for t, _ in told] == [t for t, _ in want] and all(abs(a - b) < 1e-12 for (_, a), (_, b) in zip(told, want))


def test_new_words_take_no_threads_of_the_library():
    from vaultline.llm import packing, tokenizing
    words = tokenizing.WordIds(packing.TOKENIZER)
    library, text = words.tokenizer, "Some words, some more words; zxqv-17 (again) ümläut"

    class OneByOne:  # calls for several texts start threads
        def encode(self, *args, **kw):
            return library.encode(*args, **kw)

    words.tokenizer = OneByOne()
    assert words.ids(text) == words.ids(text) == words.whole(text)


def test_plain_words_go_to_the_merges():
    from vaultline.llm import packing, tokenizing
    words = tokenizing.WordIds(packing.TOKENIZER)
    library = words.tokenizer
    text = "It'll've 'TIS (ÜMLÄUT) ümläut, ümläut; naïve-çà 'S''s x1y22z don'T!!1 $$$ ÿÞß zxqv-17."

    class Never:
        def encode(self, *args, **kw):
            raise AssertionError("a plain word went through the whole library")

    words.tokenizer = Never()
    got = words.ids(text)
    words.tokenizer = library
    assert got == words.ids(text) == words.whole(text)


def test_lower_casing_makes_no_special_string():
    from vaultline.llm import packing, tokenizing
    words = tokenizing.WordIds(packing.TOKENIZER)
    for text in ("a <|ENDOFTEXT|> b", "x<|EndOfText|>y", "\u65e5<|StartOfText|>", "a <|endoftext|> b"):
        assert words.ids(text) == words.whole(text), text


def test_word_ids_when_the_caches_turn_over(monkeypatch):
    from vaultline.llm import packing, tokenizing
    monkeypatch.setattr(tokenizing, "CACHE_ENTRIES", 6)
    words = tokenizing.WordIds(packing.TOKENIZER)
    for text in ("one two three four five six seven eight, nine.", "one two one \u65e5\u672c nine. four", "ten one (two) ten"):
        assert words.ids(text) == words.whole(text)
    assert max(map(len, (words.cache, words.older, words.parts, words.older_parts))) <= 4
