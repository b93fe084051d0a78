"""Personal data: regular expressions propose spans, checks confirm them and
nearby context words adjust their score.

Every kind has a pattern, an optional exact validator (Luhn for cards, mod 97
for IBANs, part values for addresses, digit counts for phones) and context
words. A span's score is the kind's prior, plus ``CONFIRMED`` where a checksum
passes, plus or minus ``CONTEXT`` for a supporting or opposing word within
``REACH`` characters. Candidates that fail their validator are dropped without
a retry. Kinds in ``BASE_KINDS`` are kept whenever they validate (their score
is information); the other kinds need ``THRESHOLD``.

Positions are code points, end exclusive. They come from splitting the text at
the matches of the same pattern: running sums of the lengths of the pieces and of
the matches give every offset. Sums, contexts and masking work on runs of
``RUN`` spans and never look back to the start of the text, so a text of many
spans takes time near to its length.

Secrets (access keys, tokens) are kinds of their own: ``key`` has a known
prefix, ``secret`` is a long run of letters and digits beside a word for one.

Defined results: a null text is empty and has no spans; spans of different
kinds may overlap; masking merges overlapping spans and names the kind that
starts first (ties: the longest). Repeated rows, any other nulls and extra
columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import fresh, text_or_empty

# Kinds in report order, with their patterns. Possessive forms
# match what the plain ones match but cannot backtrack or recurse, whatever the
# text; a card run under 13 digits cannot be one, so the pattern asks for 13.
# ``\\b`` reads letters beyond ASCII differently from one Java to the next: edges of words are spelled out.
LEFT, RIGHT = r"(?<![A-Za-z0-9_])", r"(?![A-Za-z0-9_])"
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": LEFT + r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)" + RIGHT,
    "ssn": LEFT + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + RIGHT,
    "key": LEFT + r"(?:A[KS]IA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{9,}[A-Za-z0-9]|sk_live_[A-Za-z0-9]{16,}"
           r"|eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{7,}[A-Za-z0-9_])" + RIGHT,
    "secret": r"[A-Za-z0-9+/_-]{24,}+={0,2}",
}
# A text without this cannot hold the kind; tested before the pattern runs.
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+", "iban": "", "ssn": "-", "key": "", "secret": ""}
BASE_KINDS = ("email", "ip", "card", "phone")
# Scores in hundredths, so that sums are exact.
PRIOR = {"email": 80, "ip": 60, "card": 40, "phone": 60, "iban": 30, "ssn": 35, "key": 80, "secret": 35}
CONFIRMED, CONTEXT, THRESHOLD, REACH = 40, 20, 50, 40
RUN = 256       # spans per run
NEIGHBOURS = 10  # matches are 4 characters or more, so no more of them lie within REACH
# Whole words, with or without a plural s.
CONTEXT_WORDS = {
    "email": ("mail", "email", "contact", "write"),
    "ip": ("ip", "address", "server", "host"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "tel", "call", "mobile"),
    "iban": ("iban", "account", "bank"),
    "ssn": ("ssn", "social", "security"),
    "key": ("key", "token", "access"),
    "secret": ("token", "secret", "password", "passwd", "pwd", "key", "apikey", "credential", "bearer", "api_key", "access_key",
               "secret_key", "private_key", "client_secret", "access_token", "auth_token", "api_token"),
}
AGAINST_WORDS = ("version", "order", "isbn", "serial", "part")
SPAN = "array<struct<kind:string,start:int,end:int,text:string,score:int>>"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _mod97(c: Column) -> Column:
    """Remainder by 97 of an IBAN's number form, digit by digit: any length."""
    s = F.replace(c, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(s, F.lit(5)), F.substr(s, F.lit(1), F.lit(4)))
    values = F.transform(F.filter(F.split(turned, ""), lambda x: x != ""), lambda x: F.when(
        x.rlike("[0-9]"), x.try_cast("int"))
        .otherwise(F.ascii(x) - 55))
    return F.aggregate(values, F.lit(0), lambda a, v: F.when(v > 9, (a * 100 + v) % 97).otherwise((a * 10 + v) % 97))


def _valid(kind: str, m: Column) -> Column:
    n = F.length(_digits(m))
    if kind == "ip":
        # At most 255: no part has a value over 255, leading zeros or not.
        return ~m.rlike(r"(?:^|\.)0*(?:[1-9][0-9]{3,}|[3-9][0-9]{2}|2[6-9][0-9]|25[6-9])(?:\.|$)")
    if kind == "card":
        return n.between(13, 19) & F.call_function("luhn_check", _digits(m))
    if kind == "phone":
        return n.between(9, 15)
    if kind == "iban":
        return _mod97(m) == 1
    if kind == "ssn":
        return ~m.rlike(r"^(?:000|666|9)|-00-|-0000$")
    if kind == "secret":
        return m.rlike("[0-9]") & m.rlike("[A-Za-z]")
    return F.lit(True)


def _near(c: Column, words: tuple[str, ...]) -> Column:
    return c.rlike(f"(?i){LEFT}(?:{'|'.join(words)})s?{RIGHT}")


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, worked out once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _runs(a: Column) -> Column:
    """An array in runs of ``RUN`` elements (an empty one: one empty run)."""
    last = F.greatest(F.floor((F.size(a) - 1) / RUN).cast("int"), F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(a, b * RUN + 1, RUN))


def _starts(pairs: Column) -> Column:
    """Offset of every match: running sums, run by run, so that appending costs
    a run's length and not the text's."""
    none = F.array().cast("array<int>")

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + p["gap"]
        return F.struct((start + p["size"]).alias("at"), F.concat(acc["out"], F.array(start)).alias("out"))

    def run(acc: Column, part: Column) -> Column:
        done = F.aggregate(part, F.struct(acc["at"].alias("at"), none.alias("out")), step)
        return _let(done, lambda d: F.struct(d["at"].alias("at"), F.concat(acc["out"], d["out"]).alias("out")))

    return F.aggregate(_runs(pairs), F.struct(F.lit(0).alias("at"), none.alias("out")), run, lambda a: a["out"])


def _spans(kind: str, text: Column) -> Column:
    pattern = PATTERNS[kind]
    # (match, text before it); the last pair is the text after the last match.
    pairs = F.zip_with(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1), lambda m, before: F.struct(
        m.alias("m"), F.length(before).alias("gap"), F.coalesce(F.length(m), F.lit(0)).alias("size"),
        F.left(before, F.lit(REACH)).alias("gap_head"), F.right(before, F.lit(REACH)).alias("gap_tail"),
        F.left(m, F.lit(REACH)).alias("head"), F.right(m, F.lit(REACH)).alias("tail")))

    def scored(ps: Column, starts: Column, p: Column, i: Column) -> Column:
        # The text around the match, from the pieces next to it: a neighbouring match, kept or not, does not end the context.
        before = [F.get(ps, i - k)[c] for k in range(NEIGHBOURS, 0, -1) for c in ("gap_tail", "tail")] + [p["gap_tail"]]
        after = [F.get(ps, i + k)[c] for k in range(1, NEIGHBOURS + 1) for c in ("gap_head", "head")]
        around = F.concat_ws(" ", F.right(F.concat_ws("", *before), F.lit(REACH)), F.left(F.concat_ws("", *after), F.lit(REACH)))
        score = _let(around, lambda c: F.lit(PRIOR[kind]) + (CONFIRMED if kind in ("card", "iban") else 0)
                     + F.when(_near(c, CONTEXT_WORDS[kind]), CONTEXT).otherwise(0)
                     - F.when(_near(c, AGAINST_WORDS), CONTEXT).otherwise(0))
        start = F.get(starts, i)
        return F.when(p["m"].isNotNull() & _valid(kind, p["m"]), F.struct(
            F.lit(kind).alias("kind"), start.alias("start"), (start + p["size"]).alias("end"),
            p["m"].alias("text"), F.least(F.lit(100), score).alias("score")))

    out = F.array_compact(_let(pairs, lambda ps: _let(_starts(ps), lambda starts: F.transform(
        ps, lambda p, i: scored(ps, starts, p, i)))))
    if kind not in BASE_KINDS:
        out = F.filter(out, lambda x: x["score"] >= THRESHOLD)
    possible = text.contains(NEEDS[kind]) if NEEDS[kind] else F.lit(True)
    if kind != "email":
        possible = possible & text.rlike(pattern)
    return F.when(possible, out).otherwise(F.array().cast(SPAN)).cast(SPAN)


def find_pii(docs: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """``docs`` plus ``out``: array of (kind, start, end, text, score in hundredths), by kind
    in the order of ``PATTERNS`` and then by start."""
    (t,) = fresh(docs, "t")
    df = docs.withColumn(t, text_or_empty(text))
    return df.withColumn(out, F.concat(*[_spans(k, F.col(t)) for k in PATTERNS])).drop(t)


def mask_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every found span replaced by ``<KIND>``; a null text stays
    null. Overlapping spans become one."""
    (p,) = fresh(docs, "p")
    found = find_pii(docs, text, p)
    order = F.sort_array(F.transform(F.col(p), lambda s: F.struct(
        s["start"].alias("start"), (-s["end"]).alias("neg_end"), s["kind"].alias("kind"))))
    body = F.col(text)

    # Run by run: each run's own stretch of the text is cut out once, so no span looks back to the text's start.
    def run(acc: Column, part: Column) -> Column:
        last = F.greatest(acc["at"], F.coalesce(F.array_max(F.transform(part, lambda s: -s["neg_end"])), F.lit(0)))
        stretch = F.substr(body, acc["at"] + 1, last - acc["at"])

        def step(base: Column, cut: Column):
            def one(a: Column, s: Column) -> Column:
                ahead = F.substr(cut, a["at"] - base + 1, s["start"] - a["at"])
                return F.struct(
                    F.greatest(a["at"], -s["neg_end"]).alias("at"),
                    F.when(s["start"] >= a["at"], F.concat(a["out"], ahead, F.lit("<"), F.upper(s["kind"]), F.lit(">")))
                    .otherwise(a["out"]).alias("out"))
            return one

        done = _let(stretch, lambda cut: F.aggregate(
            part, F.struct(acc["at"].alias("at"), F.lit("").alias("out")), step(acc["at"], cut)))
        return _let(done, lambda d: F.struct(d["at"].alias("at"), F.concat(acc["out"], d["out"]).alias("out")))

    masked = _let(order, lambda o: F.aggregate(
        _runs(o), F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), run,
        lambda a: F.concat(a["out"], F.substr(body, a["at"] + 1))))
    return found.withColumn(text, F.when(F.size(p) > 0, masked).otherwise(body)).drop(p)


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame, spans: str = "pii") -> list[Column]:
    """Counts per base kind, hash of the base spans, and all spans as text."""
    base = F.filter(F.col(spans), lambda s: s["kind"].isin(*BASE_KINDS))

    def count(kind: str) -> Column:
        return F.size(F.filter(F.col(spans), lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in BASE_KINDS]
    return [*counts, F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col(spans)).alias("spans")]
