"""Toxic passages by maximum-scoring segments.

Tokens, and stems (the first 4 and 5 letters of longer tokens, for inflected
words not seen in training), get log-odds between toxic and clean labelled
documents, smoothed by a Dirichlet prior with the whole corpus's shares as its
mean. A document counts a token once, so that repeats are not taken for
evidence. Tokens score their log-odds where these pass a bar in size and in
standard errors; a token too rare to tell scores its stem's; all others share
one pooled, negative score, so noise does not add up. Only tokens whose plain
odds ratio is at least ``CANDIDATE`` can pass a bar. Of the bars in ``BARS``
the one with the least logistic loss is used. A linear-time scan
(Ruzzo and Tompa) finds all maximal segments of a document. Their scores are calibrated by an extreme-value law:
in a clean document of n tokens P(best >= s) = 1 - exp(-K n exp(-lambda s)), with
lambda and K fitted by maximum likelihood to clean labelled documents (those
without a segment count as censored). A segment is a
significant passage when its expected number K n exp(-lambda s) is at most
``MAX_EXPECTED``. The document's evidence, the summed calibrated scores of its
segments above that law's mode or else the best one's, becomes a probability by
a logistic fit.

Bounds: labels come from at most about ``TRAIN_ROWS`` labelled documents (a
hash sample of stated size), two thirds for the log-odds, the rest for the two fits; so
the vocabulary and the fits that reach the driver are bounded. The prior's token
shares are counted over all documents, and every document is scored whole.

Defined results: a null text is empty; an empty text has no segment and gets
the score of no evidence; without toxic or without clean labels every score is
0; labels that disagree count as toxic; null labels are not used; repeated rows
are scored each.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import materialize, text_or_empty

TRAIN_ROWS = 50_000
PRIOR, MIN_COUNT = 1000.0, 5
# (least log-odds, least standard errors) of a token with a score of its own; the fits choose one.
BARS = ((1.0, 3.0), (1.5, 3.5), (2.0, 4.0))
CANDIDATE = 2.0
STEMS = (5, 4)
MAX_EXPECTED, THRESHOLD = 0.05, 0.3
TOKEN = re.compile(r"[^\W\d_]+")


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall((text or "").lower())


def segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), in order. Each found
    segment points to the nearest earlier one with a smaller left sum, which
    keeps the scan linear."""
    start, end, left, right, link = [], [], [], [], []
    total = 0.0
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        a, lo = i, before
        while True:
            j = len(start) - 1
            while j >= 0 and left[j] >= lo:
                j = link[j]
            if j < 0 or right[j] >= total:
                break
            a, lo = start[j], left[j]
            del start[j:], end[j:], left[j:], right[j:], link[j:]
        start.append(a), end.append(i + 1), left.append(lo), right.append(total), link.append(j)
    return [(a, b, r - lo) for a, b, lo, r in zip(start, end, left, right)]


def stems(token: str) -> list[str]:
    return [token[:k] + "*" for k in STEMS if len(token) > k]


class Scores(dict):
    """Score of every token: its own, its stem's or the pooled one. ``plain``
    are tokens seen often enough not to fall back on their stem."""

    def __init__(self, odds: dict[str, float], plain: set[str], rest: float):
        super().__init__()
        self.odds, self.plain, self.rest = odds, plain, rest

    def __missing__(self, token: str) -> float:
        if len(self) > 1_000_000:
            self.clear()
        known = [token] if token in self.plain else [token, *stems(token)]
        self[token] = found = next((self.odds[t] for t in known if t in self.odds), self.rest)
        return found


def scan(text: str | None, scores: Scores) -> tuple[int, list[tuple[int, int, float]]]:
    words = tokens(text)
    return len(words), segments([scores[w] for w in words])


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.pmod(F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")), F.lit(4)) == 2


def training_labels(labels: DataFrame, rows: int, doc_id: str, label: str) -> DataFrame:
    """(doc_id, toxic, fits): at most about ``rows`` labelled documents, picked
    by a hash; ``fits`` marks the third for the fits."""
    truth = (labels.filter(F.col(doc_id).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(doc_id)))
             .groupBy(F.col(doc_id).alias("doc_id")).agg(F.max(label).cast("int").alias("toxic")))
    truth = materialize(truth, "toxic-labels")
    n = truth.count()
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    part = math.floor(1_000_000 * min(1.0, rows / max(1, n)))
    return truth.filter(spread < part).withColumn("fits", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(3)) == 1)


def _token_counts(texts: DataFrame, known: set[str] | None = None) -> DataFrame:
    """(token, side, n): documents of ``texts`` (text, side) that hold a token
    or stem; counted per batch before the shuffle, and only ``known`` ones where
    given. The token "" counts the documents."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            counts: dict[int, Counter] = {}
            for text, side in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = set(tokens(text))
                words.update([w[:k] + "*" for k in STEMS for w in words if len(w) > k])
                c = counts.setdefault(side, Counter())
                c.update(words if known is None else words & known)
                c[""] += 1
            for side, c in counts.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), pa.string()), pa.array([side] * len(c), pa.int32()),
                     pa.array(list(c.values()), pa.int64())], names=["token", "side", "n"])

    return (texts.mapInArrow(run, "token string, side int, n long")
            .groupBy("token", "side").agg(F.sum("n").alias("n")))


def candidates(counts: DataFrame, n1: int, n0: int) -> DataFrame:
    """Tokens and stems of ``counts`` (token, c1, c0: toxic and clean documents
    that hold it) that may pass a bar: their plain odds are far enough apart,
    however common the token is among clean documents."""
    odds = lambda c, n: (F.col(c) + 0.5) / (F.lit(n) - F.col(c) + 0.5)
    ratio = odds("c1", n1) / odds("c0", n0)
    return counts.filter((F.col("token") != "") & (F.col("c1") + F.col("c0") >= MIN_COUNT) & (ratio >= CANDIDATE))


def log_odds(found: dict[str, tuple[int, int, int]], totals: tuple[int, int, int], words: tuple[int, int],
             bar: tuple[float, float], prior: float = PRIOR) -> tuple[dict[str, float], float]:
    """(scores, pooled score). ``found``: toxic, clean and all documents with a
    candidate; ``totals``: toxic, clean and all documents; ``words``: token counts
    of the toxic and of the clean documents."""
    (effect, z), (n1, n0, n) = bar, totals
    weight = min(prior, n1)
    odds: dict[str, float] = {}
    for t, (c1, c0, c) in found.items():
        a = weight * min(0.5, max(c, 1) / max(n, 1))
        delta = (math.log((c1 + a) / max(n1 + weight - c1 - a, 0.5)) - math.log((c0 + a) / max(n0 + weight - c0 - a, 0.5)))
        if delta >= effect and delta >= z * math.sqrt(1 / (c1 + a) + 1 / (c0 + a)):
            odds[t] = delta
    mine = [found[t] for t in odds if not t.endswith("*")]
    rest = (math.log((words[0] - sum(c[0] for c in mine) + 1) / (words[0] + 1))
            - math.log((words[1] - sum(c[1] for c in mine) + 1) / (words[1] + 1)))
    return odds, min(rest, -1e-3)  # the scan needs a falling background


def fit_extremes(best: np.ndarray, n: np.ndarray, least: float) -> tuple[float, float]:
    """(lambda, ln K) of the extreme-value law, by maximum likelihood on the
    best scores of clean documents with n tokens; 0 means below ``least``. With
    too few scores to fit lambda it is 1, its value for log-odds."""
    n = np.maximum(n.astype(float), 1.0)
    hit = best > 0
    s = np.where(hit, best, least).astype(float)

    def ln_k(lam: float) -> float:
        low = s.min()
        return math.log(max(int(hit.sum()), 1)) - math.log((n * np.exp(-lam * (s - low))).sum()) + lam * low

    if not len(s):
        return 1.0, 0.0
    if hit.sum() < 10 or s[hit].std() == 0:
        return 1.0, ln_k(1.0)

    def slope(lam: float) -> float:
        w = n * np.exp(-lam * (s - s.min()))
        return 1 / lam - s[hit].mean() + (s * w).sum() / w.sum()

    low, high = 1e-3, 1e3
    for _ in range(100):
        mid = math.sqrt(low * high)
        low, high = (mid, high) if slope(mid) > 0 else (low, mid)
    lam = math.sqrt(low * high)
    return lam, ln_k(lam)


def evidence(n: int, found: list[tuple[int, int, float]], lam: float, ln_k: float) -> float:
    """Summed calibrated scores of the segments above the law's mode; else the
    best one's (at most 0); with no segment, the mode's distance from 0."""
    mode = ln_k + math.log(max(n, 1))
    scores = [lam * s - mode for _, _, s in found]
    above = sum(x for x in scores if x > 0)
    return above if above > 0 else min(0.0, max(scores, default=-mode if mode > 0 else 0.0))


def fit_logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, intercept) of P(y = 1 | x), by Newton's method with a weak ridge."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (y - p) - 1e-3 * w
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(2), grad)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def squash(x: float) -> float:
    """Evidence for the logistic fit: its large values differ by order only."""
    return math.copysign(math.log1p(abs(x)), x)


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
          train_rows: int = TRAIN_ROWS) -> dict:
    """The fitted model: scores, lam, ln_k, slope, intercept, loss."""
    spark = docs.sparkSession
    sample = F.broadcast(training_labels(labels, train_rows, doc_id, label))  # about train_rows rows at most
    texts = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    train = materialize(texts.join(sample, "doc_id").select("text", "toxic", "fits"), "toxic-train")
    counts = _token_counts(train.filter("NOT fits").select("text", F.col("toxic").alias("side")))
    toxic = F.col("side") >= 1
    counts = materialize(counts.groupBy("token").agg(
        F.sum(F.when(toxic, F.col("n")).otherwise(0)).alias("c1"), F.sum(F.when(toxic, 0).otherwise(F.col("n"))).alias("c0")),
        "toxic-counts")
    docs1, docs0 = next(((r[1], r[2]) for r in counts.filter("token = ''").collect()), (0, 0))
    word = (F.col("token") != "") & ~F.col("token").endswith("*") & (F.col("c1") + F.col("c0") >= MIN_COUNT)
    words = tuple(x or 0 for x in counts.filter(word).agg(F.sum("c1"), F.sum("c0")).first())
    # Of the vocabulary of at most train_rows documents, the part that may score.
    found = {r["token"]: (r["c1"], r["c0"]) for r in candidates(counts, docs1, docs0).collect()} if docs1 and docs0 else {}
    corpus = {t: n for t, _, n in _token_counts(texts.select("text", F.lit(0).alias("side")), set(found)).collect()}
    found = {t: (c1, c0, corpus.get(t, 0)) for t, (c1, c0) in found.items()}
    fitted = [log_odds(found, (docs1, docs0, corpus.get("", 0)), words, bar) for bar in BARS] if found else []
    stem = [F.concat(F.substr("token", F.lit(1), F.lit(k)), F.lit("*")) for k in STEMS]
    scoring = sorted({t for odds, _ in fitted for t in odds if t.endswith("*")})
    near = spark.createDataFrame([(t,) for t in scoring], "stem string")
    # Words seen often enough to speak for themselves though their stem scores.
    plain = {r[0] for r in counts.filter(word).select("token", F.explode(F.array(*stem)).alias("stem"))
             .join(near, "stem", "left_semi").select("token").distinct().collect()}
    options = [Scores(odds, plain - odds.keys(), rest) for odds, rest in fitted] or [Scores({}, set(), -1e-3)]

    def measure(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            for k, scores in enumerate(options):
                rows = [scan(t, scores) for t in b.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k] * len(rows), pa.int32()), b.column(1), pa.array([n for n, _ in rows], pa.int64()),
                     pa.array([[s for *_, s in found] for _, found in rows], pa.list_(pa.float64()))],
                    names=["option", "toxic", "n", "found"])

    # Segment scores stay in a table: the driver takes a few numbers a document, however long its text is.
    segments = materialize(train.filter("fits").select("text", "toxic")  # a third of the sample
                           .mapInArrow(measure, "option int, toxic int, n long, found array<double>"), "toxicity-segments")
    tops = segments.select("option", "toxic", "n", F.coalesce(F.array_max("found"), F.lit(0.0)).alias("top")).collect()
    best = {"scores": options[-1], "lam": 1.0, "ln_k": 0.0, "slope": 0.0, "intercept": -30.0, "loss": math.inf}
    for k, scores in enumerate(options):
        mine = [r for r in tops if r[0] == k]
        y = np.array([r[1] >= 1 for r in mine], dtype=float)
        if not scores.odds or not len(mine) or y.min() == y.max():
            continue
        n, top = np.array([r[2] for r in mine], dtype=float), np.array([r[3] for r in mine])
        lam, ln_k = fit_extremes(top[y == 0], n[y == 0], min(scores.odds.values()))
        told = weigh(segments.filter(F.col("option") == k), lam, ln_k).collect()
        y, x = np.array([r[0] >= 1 for r in told], dtype=float), np.array([r[1] for r in told])
        slope, intercept = fit_logistic(x, y)
        p = 1 / (1 + np.exp(-np.clip(slope * x + intercept, -30, 30)))
        loss = float(-np.log(np.where(y > 0, p, 1 - p) + 1e-12).mean())
        if loss < best["loss"]:
            best = {"scores": scores, "lam": lam, "ln_k": ln_k, "slope": slope, "intercept": intercept, "loss": loss}
    return best


def weigh(segments: DataFrame, lam: float, ln_k: float) -> DataFrame:
    """(toxic, x): each document's evidence from its segment scores."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            xs = [squash(evidence(n, [(0, 0, s) for s in found], lam, ln_k))
                  for n, found in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(xs, pa.float64())], names=["toxic", "x"])

    return segments.select("toxic", "n", "found").mapInArrow(run, "toxic int, x double")


def score(docs: DataFrame, model: dict, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, score, passages): passages are the significant
    segments (first token, end, score, expected number in clean text)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    lam, ln_k, slope, intercept = (model[k] for k in ("lam", "ln_k", "slope", "intercept"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        passage = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("score", pa.float64()),
                                      ("expected", pa.float64())]))
        for b in batches:
            ns, ps, out = [], [], []
            for t in b.column(1).to_pylist():
                n, found = scan(t, model["scores"])
                x = slope * squash(evidence(n, found, lam, ln_k)) + intercept
                ns.append(n)
                ps.append(1 / (1 + math.exp(-max(-30.0, min(30.0, x)))) if intercept > -30 else 0.0)
                sure = [(a, e, s, math.exp(min(50.0, ln_k + math.log(max(n, 1)) - lam * s))) for a, e, s in found]
                out.append([{"first": a, "end": e, "score": s, "expected": v} for a, e, s, v in sure if v <= MAX_EXPECTED])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ns, pa.int64()), pa.array(ps, pa.float64()),
                                              pa.array(out, passage)], names=["doc_id", "n_tokens", "score", "passages"])

    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, score double, "
                                "passages array<struct<first:int,end:int,score:double,expected:double>>")
