"""Quality rules with risk-controlled cutoffs.

Four text signals (per mille, so all comparisons are on integers) are compared
with cutoffs that labelled holdout documents certify. For a stratum, a signal
and a cutoff c the null hypothesis is "more than ``alpha / n_signals`` of the
good documents exceed c". Its p-value is the exact binomial tail
P(Bin(n, alpha / n_signals) <= k), k of n good holdout documents exceeding c.
Cutoffs of one signal are tested from the loosest to the tightest and testing
stops at the first failure (fixed-sequence testing); the level ``delta`` is
divided by the number of (stratum, signal) families (Bonferroni). So with
probability 1 - delta every certified cutoff is safe, and by the union bound
over signals at most ``alpha`` of a stratum's good documents are rejected.
Among certified cutoffs the one that separates bad from good best is used
(ties: the loosest); a family with no certified cutoff rejects nothing.

Defined results: a null text counts as empty; a null stratum is a stratum of
its own; holdout copies (equal text in a stratum) count once, so that a large
group of copies is not taken for independent evidence; a document whose labels
disagree is not good; unlabelled or null-labelled documents do not calibrate;
no labels: no cutoffs. Repeated rows are judged alike, extra columns are kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultline.llm.common import BLANK_RUN, BLANKS, count_chars, fresh, materialize, text_or_empty, words_of

SYMBOLS = "#*$%&|<>"
# Signal -> (count, size): the signal is floor(1000 * count / size).
SIGNALS = {
    "symbols": ("n_symbols", "word_chars"),
    "shouts": ("n_shouts", "word_chars"),
    "repeats": ("n_repeat_words", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"),
}
# Per mille, loosest first: the fixed sequence in which cutoffs are tested.
CUTOFFS = (400, 300, 200, 150, 100, 80, 60, 40, 30, 20, 10)
ALPHA, DELTA = 0.05, 0.05
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
CONTRACT_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus one struct column ``quality`` with the counts of every
    whole text, ``base_failed`` and a content hash. All work stays inside the
    row: nothing is exploded or shuffled."""
    t, w, hits, at = fresh(docs, "t", "w", "hits", "at")
    body = F.col(t)
    words = F.col(w)
    # A 3-word window is the hash of its words' hashes; equal windows become neighbours when sorted.
    windows = F.slice(F.transform(words, lambda x, i: F.struct(
        F.xxhash64(x, F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i"))),
        F.lit(1), F.greatest(F.size(words) - 2, F.lit(0)))
    same = lambda x, i: (x["h"] == F.get(F.col(hits), i - 1)["h"]) | (x["h"] == F.get(F.col(hits), i + 1)["h"])
    starts = F.sort_array(F.transform(F.filter(F.col(hits), same), lambda x: x["i"]))
    # Each repeated window covers its words up to the start of the next one.
    covered = F.aggregate(
        F.transform(F.col(at), lambda x, i: F.least(F.lit(3), F.coalesce(F.get(F.col(at), i + 1) - x, F.lit(3)))),
        F.lit(0).cast("long"), lambda acc, x: acc + x)
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = (docs.withColumn(t, text_or_empty(text))
           .withColumn(w, words_of(body))
           .withColumn(hits, F.sort_array(windows))
           .withColumn(at, starts)
           .withColumn("quality", F.struct(
               F.size(words).cast("long").alias("n_words"),
               (F.char_length(body) - count_chars(body, BLANKS)).cast("long").alias("word_chars"),
               count_chars(body, SYMBOLS).alias("n_symbols"),
               count_chars(body, "!").alias("n_shouts"),
               lines.alias("lines"),
               covered.alias("n_repeat_words"),
               F.xxhash64(body).alias("content"))))
    q = F.col("quality")
    n_lines = F.size(q["lines"]).cast("long")
    return out.drop(t, w, hits, at).withColumn("quality", F.struct(
        q["n_words"], q["word_chars"], q["n_symbols"], q["n_shouts"], n_lines.alias("n_lines"),
        (n_lines - F.size(F.array_distinct(q["lines"]))).alias("n_dup_lines"), q["n_repeat_words"], q["content"],
        ((q["n_words"] < MIN_WORDS)
         | (100 * q["n_repeat_words"] > MAX_REPEAT_PERCENT * q["n_words"])).alias("base_failed")))


def signal(name: str, q: Column) -> Column:
    """Per-mille value of a signal; 0 where there is nothing to divide by."""
    count, size = SIGNALS[name]
    return F.when(q[size] > 0, F.floor(F.lit(1000) * q[count] / q[size])).otherwise(F.lit(0)).cast("long")


def _ln_gamma(x: Column) -> Column:
    """ln of the gamma function for x >= 1: Stirling's series at x + 10,
    brought back by the recurrence."""
    y = x + 10
    back = reduce(lambda a, b: a + b, [F.ln(x + i) for i in range(10)])
    return ((y - 0.5) * F.ln(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y ** 3)
            + 1 / (1260 * y ** 5) - 1 / (1680 * y ** 7) - back)


def binomial_tail(k: Column, n: Column, level: float) -> Column:
    """P(Bin(n, level) <= k) for k below the mean, else 1. Terms fall from k
    down; those further than 12 standard deviations under k add nothing to a
    double, so the sum has O(sqrt(n)) terms."""
    import math
    low = F.greatest(F.lit(0), F.floor(k - 12 * F.sqrt(n * level) - 100)).cast("long")
    terms = F.transform(F.sequence(low, k), lambda i: F.exp(
        _ln_gamma(n + 1.0) - _ln_gamma(i + 1.0) - _ln_gamma(n - i + 1.0)
        + i * math.log(level) + (n - i) * math.log1p(-level)))
    return F.when((n > 0) & (k < n * level), F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)).otherwise(F.lit(1.0))


def calibrate(feats: DataFrame, labels: DataFrame, stratum: str = "lang", doc_id: str = "doc_id",
              label: str = "quality", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Certified cutoffs: one row (stratum, signal, cutoff, n_good, n_bad,
    p_value) for each family that has one. ``feats`` needs doc_id, stratum and
    the struct of :func:`features`; every labelled document counts."""
    truth = (labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
             .groupBy(F.col(doc_id).alias("_id")).agg(F.min(label).alias("_good")))
    q = F.col("_q")
    held = (feats.select(F.col(doc_id).alias("_id"), F.col(stratum).cast("string").alias("stratum"),
                         F.col("quality").alias("_q"))
            .filter(~q["base_failed"]).join(truth, "_id")
            .groupBy("stratum", q["content"].alias("content"))
            .agg(F.min("_good").alias("good"), *[F.max(signal(s, q)).alias(s) for s in SIGNALS]))
    good, bad = F.col("good") >= 1, F.col("good") < 1
    counts = held.groupBy("stratum").agg(
        F.count_if(good).alias("n_good"), F.count_if(bad).alias("n_bad"),
        *[F.count_if(side & (F.col(s) > c)).alias(f"{which}_{s}_{c}")
          for s in SIGNALS for c in CUTOFFS for which, side in (("good", good), ("bad", bad))])
    cells = F.array(*[F.struct(F.lit(s).alias("signal"), F.lit(i).alias("step"), F.lit(c).cast("long").alias("cutoff"),
                               F.col(f"good_{s}_{c}").alias("k_good"), F.col(f"bad_{s}_{c}").alias("k_bad"))
                      for s in SIGNALS for i, c in enumerate(CUTOFFS)])
    counts = materialize(counts, "quality-counts")  # a row per stratum
    families = max(1, counts.count() * len(SIGNALS))
    tested = (counts.select("stratum", "n_good", "n_bad", F.explode(cells).alias("c"))
              .select("stratum", "n_good", "n_bad", "c.*")
              .withColumn("p", binomial_tail(F.col("k_good"), F.col("n_good"), alpha / len(SIGNALS))))
    run = Window.partitionBy("stratum", "signal").orderBy("step")  # at most len(CUTOFFS) rows
    gain = F.col("k_bad") / F.greatest("n_bad", F.lit(1)) - F.col("k_good") / F.greatest("n_good", F.lit(1))
    return (tested.withColumn("p_value", F.max("p").over(run))
            .filter(F.col("p_value") <= delta / families)
            .withColumn("gain", gain).filter("gain > 0")
            .groupBy("stratum", "signal")
            .agg(F.max(F.struct("gain", (-F.col("step")).alias("loose"), "cutoff", "n_good", "n_bad", "p_value")).alias("b"))
            .select("stratum", "signal", "b.cutoff", "b.n_good", "b.n_bad", "b.p_value"))


def judge(feats: DataFrame, cutoffs: DataFrame, stratum: str = "lang") -> DataFrame:
    """``feats`` plus ``kept`` and ``rejected_by`` (names of the rules that
    reject, ``base`` first). The cutoffs are one row per stratum."""
    s, table = fresh(feats, "_stratum", "_cutoffs")
    per = (cutoffs.groupBy(F.col("stratum").alias(s))
           .agg(F.struct(*[F.max(F.when(F.col("signal") == x, F.col("cutoff"))).alias(x) for x in SIGNALS]).alias(table)))
    q = F.col("quality")
    joined = feats.join(per, feats[stratum].cast("string").eqNullSafe(per[s]), "left")
    reasons = F.array_compact(F.array(
        F.when(q["base_failed"], F.lit("base")),
        *[F.when(signal(x, q) > F.col(table)[x], F.lit(x)) for x in SIGNALS]))
    return (joined.withColumn("rejected_by", reasons).withColumn("kept", F.size("rejected_by") == 0)
            .drop(s, table))


def measure(docs: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """:func:`features`, written once so that texts are read and measured once."""
    feats = features(docs, text)
    return materialize(feats if keep_text else feats.drop(text), "quality-features")


def screen_measured(feats: DataFrame, labels: DataFrame, stratum: str = "lang", doc_id: str = "doc_id",
                    alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    cutoffs = materialize(calibrate(feats, labels, stratum, doc_id, alpha=alpha, delta=delta), "quality-cutoffs")
    return judge(feats, cutoffs, stratum)


def screen(docs: DataFrame, labels: DataFrame, stratum: str = "lang", text: str = "text",
           doc_id: str = "doc_id", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The whole operator: ``docs`` plus ``quality``, ``rejected_by`` and
    ``kept`` (columns of these names are replaced)."""
    clash = [c for c in docs.columns if c.lower() in ("quality", "rejected_by", "kept")]
    return screen_measured(measure(docs.drop(*clash), text), labels, stratum, doc_id, alpha, delta)
