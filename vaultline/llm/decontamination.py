"""Benchmark decontamination by template canonicalisation.

Words become template tokens: punctuation around them goes, letters are
lower-cased, and numbers, names and units turn into the typed placeholders
``<num>``, ``<name>`` and ``<unit>``. Windows of ``WINDOW`` tokens are hashed
and joined with the benchmark's windows; a window of placeholders only has no
template, so it is hashed by its words. A capital may open a sentence or a name, so each
window is hashed in up to three readings: strict (capitals inside a sentence
are names), plain (no capital is a name) and open (every capital is a name, so
that neither a sentence's start nor the word before an item matters). A window
is found when any reading of it agrees with any reading of the document. A
document is a candidate for an item when it holds at least ``SIMILARITY`` of the
item's distinct windows. Then the slots are checked: within one alignment
(document position minus item position) a slot value of the item must stand for
one value of the document throughout; windows with a slot that does not are
taken back. Windows of a looser reading answer for the stricter ones too, not
the other way round. What still reaches ``SIMILARITY`` is contaminated: a copy,
or the same question with other numbers, names and units.

Scale: windows are made inside the row. Before anything is shuffled they meet
a broadcast set of the benchmark hashes' low ``BUCKET_BITS`` bits, whose size is
bounded whatever the benchmark's; only survivors join the benchmark's windows.
Hits are grouped per (document, item), so no group is larger than a document.

Defined results: null texts and items are empty; an item with fewer than
``WINDOW`` words has no template and is found as a whole, by its words; an
item without letters or digits matches nothing; repeated rows are judged alike; a null doc_id keeps its row; item ids may repeat (their
windows count as one item); an empty benchmark or corpus gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import fresh, materialize, text_or_empty, words_of

WINDOW, SIMILARITY, BUCKET_BITS = 5, 0.8, 20
NUM, NAME, UNIT = "<num>", "<name>", "<unit>"
# Unit words; they count as units only after a number.
UNITS = ("km", "m", "cm", "mm", "mi", "ft", "in", "kg", "g", "mg", "lb", "oz", "l", "ml", "s", "sec", "min", "h",
         "hr", "ms", "hours", "hour", "minutes", "minute", "seconds", "second", "days", "day", "weeks", "week",
         "years", "year", "months", "month", "miles", "mile", "meters", "metres", "meter", "metre", "grams", "liters",
         "litres", "dollars", "euros", "cents", "percent", "degrees", "usd", "eur", "%", "$", "€")
NUMBER = r"^[^\p{L}\p{N}]*[0-9][0-9.,:/]*[^\p{L}\p{N}]*$"


# Readings, from strict to loose; capitals that are names: (opening a sentence, inside one).
STRICT, PLAIN, OPEN = 0, 1, 2
NAMES = {STRICT: (False, True), PLAIN: (False, False), OPEN: (True, True)}
OPENING, INSIDE = "^", "~"  # marks of capitalised words; no bare word starts with them


def bare(x: Column) -> Column:
    return F.lower(F.regexp_replace(x, r"^[^\p{L}\p{N}%$€]+|[^\p{L}\p{N}%$€]+$", ""))


def marked(words: Column) -> Column:
    """Array of tokens, one per word (so positions agree); capitals are marked."""
    def token(x: Column, i: Column) -> Column:
        before = F.get(words, i - 1)
        capital = x.rlike(r"^[^\p{L}\p{N}]*\p{Lu}\p{Ll}")
        inside = before.isNotNull() & ~before.rlike(r"[.!?:]\W*$")
        unit = before.rlike(NUMBER) & bare(x).isin(*UNITS)
        # Most words are lower-case letters, or those and one mark behind: unless they may be units they stay as they are.
        but_last = x.substr(F.lit(1), F.length(x) - 1)
        return (F.when(x.rlike(r"^\p{Ll}+$") & ~x.isin(*UNITS), x)
                .when(x.rlike(r"^\p{Ll}+[.,;:!?]$") & ~but_last.isin(*UNITS), but_last)
                .when(x.rlike(NUMBER), NUM)
                .when(capital, F.when(inside, F.concat(F.lit(INSIDE), bare(x))).when(unit, UNIT)
                      .otherwise(F.concat(F.lit(OPENING), bare(x))))
                .when(unit, UNIT).otherwise(bare(x)))
    return F.transform(words, token)


def read_as(m: Column, reading: int) -> Column:
    """The template token of a marked word in a reading."""
    opening, inside = NAMES[reading]
    word = F.substr(m, F.lit(2))
    return (F.when(m.startswith(INSIDE), F.lit(NAME) if inside else word)
            .when(m.startswith(OPENING), F.lit(NAME) if opening else word).otherwise(m))


def template(marks: Column, reading: int) -> Column:
    """The template tokens of marked words in a reading."""
    return F.transform(marks, lambda m: read_as(m, reading))


def is_slot(token: Column) -> Column:
    return token.isin(NUM, NAME, UNIT)


def window_hashes(words: Column, tokens: Column) -> Column:
    """Array of (at, level, h) of all windows in the strict reading, by position."""
    def plain(x: Column, i: Column) -> Column:
        return F.xxhash64(x, *[F.get(tokens, i + k) for k in range(1, WINDOW)])

    def careful(x: Column, i: Column) -> Column:
        only_slots = is_slot(x)
        for k in range(1, WINDOW):
            only_slots = only_slots & is_slot(F.get(tokens, i + k))
        return F.when(only_slots, F.xxhash64(*[F.lower(F.get(words, i + k)) for k in range(WINDOW)])).otherwise(plain(x, i))

    many = F.size(F.filter(tokens, is_slot)) >= WINDOW

    def placed(h):
        return lambda x, i: F.struct(i.alias("at"), F.lit(STRICT).alias("level"), h(x, i).alias("h"))

    hashes = F.when(many, F.transform(tokens, placed(careful))).otherwise(F.transform(tokens, placed(plain)))
    return F.slice(hashes, F.lit(1), F.greatest(F.size(tokens) - (WINDOW - 1), F.lit(0)))


def other_hashes(words: Column, marks: Column, tokens: Column, reading: int, mark: str) -> Column:
    """Array of (at, level, h) of the windows that hold a marked word, which a
    looser reading (its ``tokens``) tells otherwise than the strict one."""
    last = F.size(marks) - WINDOW
    where = F.filter(F.transform(marks, lambda m, i: F.when(m.startswith(mark), i)), lambda i: i.isNotNull())
    around = F.transform(where, lambda i: F.filter(F.sequence(F.greatest(i - (WINDOW - 1), F.lit(0)), i), lambda at: at <= last))

    def plain(at: Column) -> Column:
        return F.xxhash64(*[F.get(tokens, at + k) for k in range(WINDOW)])

    def careful(at: Column) -> Column:
        only_slots = is_slot(F.get(tokens, at))
        for k in range(1, WINDOW):
            only_slots = only_slots & is_slot(F.get(tokens, at + k))
        return F.when(only_slots, F.xxhash64(*[F.lower(F.get(words, at + k)) for k in range(WINDOW)])).otherwise(plain(at))

    def placed(h):
        return lambda at: F.struct(at.alias("at"), F.lit(reading).alias("level"), h(at).alias("h"))

    many = F.size(F.filter(tokens, is_slot)) >= WINDOW
    there = F.array_distinct(F.flatten(around))
    return F.when(many, F.transform(there, placed(careful))).otherwise(F.transform(there, placed(plain)))


def runs(words: Column, n: int | Column) -> Column:
    """Array of (at, level, h) of all runs of ``n`` words, for items shorter than a window."""
    found = F.transform(words, lambda x, i: F.struct(
        i.alias("at"), F.lit(STRICT).alias("level"),
        F.xxhash64(F.concat_ws(" ", F.transform(F.slice(words, i + 1, n), bare))).alias("h")))
    return F.slice(found, F.lit(1), F.greatest(F.size(words) - n + 1, F.lit(0)))


def _windows(df: DataFrame, keep: list[str], text: str, short: Callable[[Column], list[Column]]) -> DataFrame:
    """``keep`` plus one row (at, level, h) per window and per reading that
    tells it otherwise than the strict one; ``short`` adds runs of words."""
    b, w, m, t, p, o = fresh(df, "_body", "_words", "_marks", "_tokens", "_plain", "_open")
    # Tokens are columns of their own: lambdas look into them, and would make them anew for each window.
    df = (df.select(*keep, text_or_empty(text).alias(b)).withColumn(w, words_of(F.col(b))).withColumn(m, marked(F.col(w)))
          .withColumns({x: template(F.col(m), reading) for x, reading in ((t, STRICT), (p, PLAIN), (o, OPEN))}))
    return df.select(*keep, F.inline(F.concat(
        window_hashes(F.col(w), F.col(t)), other_hashes(F.col(w), F.col(m), F.col(p), PLAIN, INSIDE),
        other_hashes(F.col(w), F.col(m), F.col(o), OPEN, OPENING), *short(F.col(w)))))


def find_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
               item_id: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row per contaminated (document, item): doc_id, item_id, n_windows
    (item windows found with consistent slots, by the strictest reading that
    reaches ``similarity``), coverage (share of the item's windows), n_changed
    (slots with another value than the item's)."""
    items = benchmark.filter(F.col(item_id).isNotNull()).select(
        F.col(item_id).alias("item_id"), text_or_empty(item_text).alias("_text")).withColumn("_item", F.xxhash64("_text"))
    size = F.size(words_of(F.col("_text")))
    lengths = sorted(r[0] for r in items.select(size).filter(size.between(1, WINDOW - 1)).distinct().collect())  # at most 4

    def whole(words: Column) -> list[Column]:
        told = (F.size(words) < WINDOW) & F.exists(words, lambda x: bare(x) != "")
        found = runs(words, F.greatest(F.size(words), F.lit(1)))
        return [F.when(told, found).otherwise(F.slice(found, 1, 0))]

    raw = materialize(_windows(items, ["item_id", "_item"], "_text", whole), "benchmark-readings")
    strict = raw.filter(F.col("level") == STRICT)
    # A window is one however often it is repeated; its other readings lead to it too.
    own = (strict.join(strict.groupBy("item_id", "h").agg(F.min("at").alias("window")), ["item_id", "h"])
           .select("item_id", "_item", "at", "window").distinct())
    index = materialize(
        raw.join(own, ["item_id", "_item", "at"]).groupBy("item_id", "h", "window")
        .agg(F.min(F.struct("level", F.when(F.col("level") == STRICT, F.col("window")).otherwise(F.col("at")).alias("at"))).alias("first"))
        .select("item_id", "h", "window", F.col("first.level").alias("item_level"), F.col("first.at").alias("item_at")),
        "benchmark-windows")
    sizes = index.groupBy("item_id").agg(F.countDistinct("window").alias("n_item"))
    mask = F.lit(2 ** BUCKET_BITS - 1)
    buckets = index.select(F.col("h").bitwiseAND(mask).alias("bucket")).distinct()  # at most 2 ** BUCKET_BITS rows
    # Rows are told apart by id and content, so that a repeated or null id mixes no texts.
    key = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    rows = key.withColumn("content", F.xxhash64(text_or_empty("_text")))
    hits = (_windows(rows, ["doc_id", "content"], "_text", lambda words: [runs(words, n) for n in lengths])
            .withColumn("bucket", F.col("h").bitwiseAND(mask))
            .join(F.broadcast(buckets), "bucket", "left_semi")
            .join(index, "h")
            .select("doc_id", "content", "item_id", "at", "item_at", "window", F.greatest("level", "item_level").alias("level")))
    pairs = (hits.groupBy("doc_id", "content", "item_id")
             .agg(F.collect_set(F.struct("at", "item_at", "window", "level")).alias("hits"))  # at most one document's windows
             .join(sizes, "item_id")
             .filter(_covered("hits") >= similarity * F.col("n_item")))
    pairs = materialize(pairs, "leak-candidates")
    # Only candidates' texts are read again, for the slots: texts in no candidate's bucket are passed over at once.
    low = F.col("content").bitwiseAND(mask)
    texts = (rows.join(_content_buckets(pairs), low == F.col("_bucket"), "left_semi")
             .select(F.col("doc_id").alias("_id"), F.col("content").alias("_content"), "_text"))
    item_words = (items.select("item_id", words_of(F.col("_text")).alias("item_words"))
                  .groupBy("item_id").agg(F.min("item_words").alias("item_words"))
                  .withColumn("item_marks", marked(F.col("item_words")))
                  .withColumn("item_tokens", template(F.col("item_marks"), STRICT))
                  .withColumn("open_tokens", template(F.col("item_marks"), OPEN)).drop("item_marks"))
    both = (texts.join(pairs, pairs["doc_id"].eqNullSafe(texts["_id"]) & (pairs["content"] == texts["_content"]))
            .withColumn("words", words_of(text_or_empty("_text"))).drop("_text", "_id", "_content")
            .join(item_words, "item_id"))

    def slots_of(tokens: str):
        def slots(h: Column) -> Column:
            at = F.filter(F.transform(F.sequence(F.lit(0), F.lit(WINDOW - 1)), lambda k: h["item_at"] + k),
                          lambda q: is_slot(F.get(F.col(tokens), q)))
            return F.transform(at, lambda q: F.struct(
                (h["at"] - h["item_at"]).alias("line"), bare(F.get(F.col("item_words"), q)).alias("item_value"),
                bare(F.get(F.col("words"), h["at"] + q - h["item_at"])).alias("value")))
        return slots

    same_slot = lambda x, y: (x["line"] == y["line"]) & (x["item_value"] == y["item_value"])
    no_value = lambda x: F.struct(x["line"].alias("line"), x["item_value"].alias("item_value"))

    def judged(df: DataFrame, level: int, tokens: str) -> DataFrame:
        slots, broken, of = f"slots_{level}", f"broken_{level}", slots_of(tokens)
        upto = F.filter("hits", lambda h: h["level"] <= level)
        mine = F.filter("hits", lambda h: h["level"] == level)
        df = df.withColumn(slots, F.array_sort(F.array_distinct(F.flatten(F.transform(upto, of)))))
        df = df.withColumn(broken, F.transform(
            F.filter(slots, lambda x, i: F.coalesce(same_slot(x, F.get(F.col(slots), i + 1)), F.lit(False))), no_value))
        sound = F.filter(mine, lambda h: ~F.arrays_overlap(F.col(broken), F.transform(of(h), no_value)))
        df = df.withColumn(f"sound_{level}", F.when(F.size(broken) == 0, mine).otherwise(sound))
        return df.withColumn(f"told_{level}", F.col(slots) if level == STRICT else F.flatten(F.transform(f"sound_{level}", of)))

    for level in (STRICT, PLAIN, OPEN):
        both = judged(both, level, "open_tokens" if level == OPEN else "item_tokens")
    # A pair's figures are those of the strictest reading that finds it.
    need, found = similarity * F.col("n_item"), []
    for level in (STRICT, PLAIN, OPEN):
        both = both.withColumn(f"n_{level}", _covered(F.concat(*[F.col(f"sound_{k}") for k in range(level + 1)])).cast("long"))
        slots = F.array_distinct(F.concat(*[F.col(f"told_{k}") for k in range(level + 1)]))
        changed = F.size(F.filter(slots, lambda s: s["value"] != s["item_value"])).cast("long")
        found.append(F.when(F.col(f"n_{level}") >= need, F.struct(F.col(f"n_{level}").alias("n_windows"), changed.alias("n_changed"))))
    both = both.withColumn("found", F.coalesce(*found)).filter("found IS NOT NULL")
    return (both.select("doc_id", "item_id", "content", "found.n_windows",
                        (F.col("found.n_windows") / F.col("n_item")).alias("coverage"), "found.n_changed")
            .dropDuplicates(["doc_id", "content", "item_id"]))  # repeated rows


def _content_buckets(pairs: DataFrame) -> DataFrame:
    """Low bits of the contents to look at: at most 2 ** BUCKET_BITS rows, so
    that most other texts are told apart without a shuffle."""
    low = F.col("content").bitwiseAND(F.lit(2 ** BUCKET_BITS - 1))
    return F.broadcast(pairs.select(low.alias("_bucket")).distinct())


def _covered(hits: str | Column) -> Column:
    return F.size(F.array_distinct(F.transform(hits, lambda h: h["window"])))


def remove_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """``docs`` without the contaminated ones; clean rows are kept as they are."""
    leaks = materialize(find_leaks(docs, benchmark, doc_id, text, **kw).select("doc_id", "content").distinct(), "leaks")
    i, c, low = fresh(docs, "_leak_id", "_leak_content", "_leak_low")
    buckets = _content_buckets(leaks).toDF(low)
    body = F.xxhash64(text_or_empty(docs[text]))
    here = body.bitwiseAND(F.lit(2 ** BUCKET_BITS - 1)) == buckets[low]
    leaks = leaks.toDF(i, c)
    # Texts in no leak's bucket are clean at once; only the others are compared (and shuffled, when leaks are many).
    suspects = docs.join(buckets, here, "left_semi").join(
        leaks, docs[doc_id].eqNullSafe(leaks[i]) & (body == leaks[c]), "left_anti")
    return docs.join(buckets, here, "left_anti").unionByName(suspects)
