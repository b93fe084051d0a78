"""DuckDB SQL of the queries that SQL can express, over the same tables. The
others need hashes, checksums or tokenizers SQL does not have; tests/llm hold
them against brute force."""

from __future__ import annotations

from vaultline.llm import centroids, decontamination as dc, pii, quality_rules as qr, url_rules

WS = r"[\x20\x09-\x0D]+"


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# ---------------------------------------------------------------- quality rules

def _quality() -> str:
    signals = {s: f"CASE WHEN {size} > 0 THEN 1000 * {count} // {size} ELSE 0 END" for s, (count, size) in qr.SIGNALS.items()}
    level = qr.ALPHA / len(qr.SIGNALS)
    cells = " UNION ALL ".join(
        f"SELECT stratum, {_quote(s)} AS signal, {i} AS step, {c} AS cutoff, count(*) FILTER (good >= 1) AS n_good, "
        f"count(*) FILTER (good < 1) AS n_bad, count(*) FILTER (good >= 1 AND {s} > {c}) AS k_good, "
        f"count(*) FILTER (good < 1 AND {s} > {c}) AS k_bad FROM held GROUP BY stratum"
        for s in qr.SIGNALS for i, c in enumerate(qr.CUTOFFS))
    rejects = ", ".join(f"CASE WHEN {s} > (SELECT cutoff FROM chosen c WHERE c.stratum IS NOT DISTINCT FROM f.stratum "
                        f"AND c.signal = {_quote(s)}) THEN {_quote(s)} END" for s in qr.SIGNALS)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang AS stratum, coalesce(text, '') AS body FROM documents),
w AS (SELECT rid, list_filter(string_split_regex(body, '{WS}'), lambda x: x <> '') AS words FROM d),
win AS (SELECT rid, i, words[i:i + 2] AS w3 FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, w3) AS n FROM win) WHERE n > 1),
cov AS (SELECT rid, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest([0, 1, 2]) AS k) GROUP BY rid),
ln AS (SELECT rid, list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
b AS (SELECT d.rid, d.doc_id, d.stratum, d.body, len(w.words) AS n_words,
        length(regexp_replace(body, '{WS}', '', 'g')) AS word_chars,
        length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        length(body) - length(replace(body, '!', '')) AS n_shouts, len(ln.lines) AS n_lines,
        len(ln.lines) - len(list_distinct(ln.lines)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words
      FROM d JOIN w USING (rid) JOIN ln USING (rid) LEFT JOIN cov USING (rid)),
f AS (SELECT *, n_words < {qr.MIN_WORDS} OR 100 * n_repeat_words > {qr.MAX_REPEAT_PERCENT} * n_words AS base_failed,
        {", ".join(f"{e} AS {s}" for s, e in signals.items())} FROM b),
truth AS (SELECT doc_id, min(quality) AS good FROM labels WHERE quality IS NOT NULL AND doc_id IS NOT NULL GROUP BY doc_id),
held AS (SELECT stratum, body, min(good) AS good, {", ".join(f"max({s}) AS {s}" for s in qr.SIGNALS)}
      FROM f JOIN truth USING (doc_id) WHERE NOT base_failed GROUP BY stratum, body),
cells AS ({cells}),
tested AS (SELECT *, CASE WHEN n_good > 0 AND k_good < n_good * {level} THEN
        list_sum(list_transform(range(0, k_good + 1), lambda i: exp(lgamma(n_good + 1) - lgamma(i + 1) - lgamma(n_good - i + 1)
          + i * ln({level}) + (n_good - i) * ln(1 - {level})))) ELSE 1 END AS p FROM cells),
seq AS (SELECT *, max(p) OVER (PARTITION BY stratum, signal ORDER BY step) AS p_value,
        k_bad / greatest(n_bad, 1) - k_good / greatest(n_good, 1) AS gain FROM tested),
chosen AS (SELECT stratum, signal, cutoff FROM (
        SELECT *, row_number() OVER (PARTITION BY stratum, signal ORDER BY gain DESC, step) AS r FROM seq
        WHERE p_value <= {qr.DELTA} / (SELECT {len(qr.SIGNALS)} * count(DISTINCT coalesce(stratum, chr(0))) FROM held)
          AND gain > 0) WHERE r = 1),
judged AS (SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        list_filter([CASE WHEN base_failed THEN 'base' END, {rejects}], lambda x: x IS NOT NULL) AS why FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, len(why) = 0 AS kept,
  array_to_string(why, ',') AS rejected_by FROM judged"""


# ---------------------------------------------------------------- decontamination

def _leaks() -> str:
    edge = r"^[^\p{L}\p{N}%$€]+|[^\p{L}\p{N}%$€]+$"
    units = ", ".join(map(_quote, dc.UNITS))
    slots = f"('{dc.NUM}', '{dc.NAME}', '{dc.UNIT}')"

    def bare(x: str) -> str:
        return f"lower(regexp_replace({x}, '{edge}', '', 'g'))"

    def template(words: str) -> str:
        w, before = f"{words}[i]", f"{words}[i - 1]"
        return rf"""list_transform(range(1, len({words}) + 1), lambda i: CASE
          WHEN regexp_matches({w}, '^\p{{Ll}}{{9,}}$') THEN {w}
          WHEN regexp_matches({w}, '{dc.NUMBER}') THEN '{dc.NUM}'
          WHEN regexp_matches({w}, '^[^\p{{L}}\p{{N}}]*\p{{Lu}}\p{{Ll}}') AND i > 1 AND NOT regexp_matches({before}, '[.!?:]\W*$') THEN '{dc.NAME}'
          WHEN i > 1 AND regexp_matches({before}, '{dc.NUMBER}') AND {bare(w)} IN ({units}) THEN '{dc.UNIT}'
          ELSE {bare(w)} END)"""

    def windows(name: str, keys: str) -> str:
        # A window of placeholders only is told by its words.
        return f"""{name} AS (SELECT {keys}, i - 1 AS pos, CASE
            WHEN len(list_filter(tokens[i:i + {dc.WINDOW - 1}], lambda x: x IN {slots})) = {dc.WINDOW}
            THEN list_transform(words[i:i + {dc.WINDOW - 1}], lambda x: lower(x)) ELSE tokens[i:i + {dc.WINDOW - 1}] END AS h
          FROM (SELECT *, unnest(range(1, len(words) - {dc.WINDOW - 2})) AS i FROM {name}_of))"""

    cut = f"list_filter(string_split_regex(coalesce(text, ''), '{WS}'), lambda x: x <> '')"
    return f"""
WITH bw_of AS (SELECT *, {template("words")} AS tokens FROM (SELECT item_id, {cut} AS words FROM benchmark WHERE item_id IS NOT NULL)),
dw_of AS (SELECT *, {template("words")} AS tokens FROM (SELECT DISTINCT doc_id, coalesce(text, '') AS body, {cut} AS words FROM documents)),
{windows("bw", "item_id")}, {windows("dw", "doc_id, body, words")},
ix AS (SELECT item_id, h, min(pos) AS item_at FROM bw GROUP BY item_id, h),
sizes AS (SELECT item_id, count(*) AS n_item FROM ix GROUP BY item_id),
hits AS (SELECT DISTINCT doc_id, body, words, item_id, dw.pos, item_at FROM dw JOIN ix USING (h)),
pairs AS (SELECT doc_id, body, item_id, n_item FROM hits JOIN sizes USING (item_id)
  GROUP BY doc_id, body, item_id, n_item HAVING count(DISTINCT item_at) >= {dc.SIMILARITY} * n_item),
h AS (SELECT hits.*, n_item, b.words AS item_words, b.tokens AS item_tokens FROM hits
  JOIN pairs p ON p.doc_id IS NOT DISTINCT FROM hits.doc_id AND p.body = hits.body AND p.item_id = hits.item_id
  JOIN bw_of b ON b.item_id = hits.item_id),
k AS (SELECT *, unnest(range(0, {dc.WINDOW})) AS k FROM h),
slots AS (SELECT doc_id, body, item_id, pos, item_at, pos - item_at AS line, {bare("item_words[item_at + k + 1]")} AS item_value,
  {bare("words[pos + k + 1]")} AS value FROM k WHERE item_tokens[item_at + k + 1] IN {slots}),
broken AS (SELECT doc_id, body, item_id, line, item_value FROM slots GROUP BY ALL HAVING count(DISTINCT value) > 1),
bad AS (SELECT DISTINCT s.doc_id, s.body, s.item_id, s.pos, s.item_at FROM slots s JOIN broken b
  ON s.doc_id IS NOT DISTINCT FROM b.doc_id AND s.body = b.body AND s.item_id = b.item_id AND s.line = b.line AND s.item_value = b.item_value),
sound AS (SELECT * FROM h WHERE NOT EXISTS (SELECT 1 FROM bad b WHERE b.doc_id IS NOT DISTINCT FROM h.doc_id AND b.body = h.body
  AND b.item_id = h.item_id AND b.pos = h.pos AND b.item_at = h.item_at)),
changed AS (SELECT doc_id, body, item_id, count(DISTINCT {{'l': line, 'i': item_value, 'v': value}}) FILTER (value <> item_value) AS n
  FROM slots GROUP BY doc_id, body, item_id)
SELECT s.doc_id, s.item_id, count(DISTINCT item_at) AS n_windows, count(DISTINCT item_at) / any_value(n_item) AS coverage,
  coalesce(any_value(c.n), 0) AS n_changed
FROM sound s LEFT JOIN changed c ON c.doc_id IS NOT DISTINCT FROM s.doc_id AND c.body = s.body AND c.item_id = s.item_id
GROUP BY s.doc_id, s.body, s.item_id HAVING count(DISTINCT item_at) >= {dc.SIMILARITY} * any_value(n_item)"""


# ---------------------------------------------------------------- URL rules

def _urls() -> str:
    rules = sorted(url_rules.LIST_RULES, key=lambda r: -len(r[0] + r[1]))
    fit = [(f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))", h + p, v) for h, p, v in rules]
    name = "CASE " + " ".join(f"WHEN {c} THEN '{r}'" for c, r, _ in fit) + " END"
    listed = "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for c, _, v in fit) + " END"

    def toks(expr: str, by: str, kind: str) -> str:
        return (f"list_transform(list_filter(string_split_regex(lower({expr}), '{by}'), lambda x: x <> ''), "
                f"lambda x: '{kind}' || regexp_replace(x, '[0-9]+', '#', 'g'))")

    return f"""
WITH RECURSIVE u0 AS (SELECT row_number() OVER () AS rid, page_id, url, coalesce(url, '') AS u FROM pages),
u1 AS (SELECT *, CASE WHEN strpos(u, '://') > 0 THEN substr(u, strpos(u, '://') + 3) ELSE '' END AS rest FROM u0),
u2 AS (SELECT *, translate(regexp_extract(rest, '^[^/?#]*', 0), '{url_rules.UPPER}', '{url_rules.LOWER}') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u1),
u AS (SELECT *, list_distinct(list_concat({toks("host", "[.]", "h:")},
        CASE WHEN regexp_extract(host, '[^.]+\\.[^.]+$', 0) <> '' THEN ['h:' || regexp_extract(host, '[^.]+\\.[^.]+$', 0)] ELSE [] END,
        {toks("path", "[^\\p{L}\\p{N}-]+", "p:")}, {toks("regexp_extract(u, '\\?([^#]*)', 1)", "[&;]", "q:")})) AS items FROM u2),
truth AS (SELECT doc_id AS page_id, max(quality = 0) AS bad FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
known AS (SELECT row_number() OVER () AS id, items, bad FROM u JOIN truth USING (page_id) WHERE len(items) > 0),
ti AS (SELECT id, unnest(items) AS t FROM known),
sets AS (SELECT id, [t] AS ant FROM ti
        UNION ALL SELECT s.id, list_append(s.ant, ti.t) FROM sets s JOIN ti ON ti.id = s.id AND ti.t > s.ant[-1]),
counted AS (SELECT ant, count(*) AS n, count(*) FILTER (bad) AS n_bad FROM sets JOIN known USING (id) GROUP BY ant),
rules AS (SELECT ant, array_to_string(ant, ' ') AS rule_id, n_bad / n AS confidence FROM counted
        WHERE n_bad >= greatest(1, ceil({url_rules.MIN_SUPPORT} * (SELECT count(*) FROM known))) AND n_bad / n >= {url_rules.MIN_CONFIDENCE}),
kept AS (SELECT * FROM rules r WHERE NOT EXISTS (SELECT 1 FROM rules s WHERE len(s.ant) < len(r.ant) AND list_has_all(r.ant, s.ant)
        AND s.confidence >= r.confidence)),
fired AS (SELECT rid, min({{'c': -confidence, 'r': rule_id}}).r AS mined_rule FROM u JOIN kept ON list_has_all(u.items, kept.ant) GROUP BY rid)
SELECT page_id, host, path, {name} AS rule, coalesce({listed}, CASE WHEN mined_rule IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
  mined_rule FROM u LEFT JOIN fired USING (rid)"""


# ---------------------------------------------------------------- personal data

# The contract's plain patterns, and the added kinds'.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    **{k: pii.PATTERNS[k].replace(pii.LEFT, r"\b").replace(pii.RIGHT, r"\b") for k in ("iban", "ssn", "key")},
    "secret": r"[A-Za-z0-9+/_-]{24,}={0,2}",
}


def _pii() -> str:
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    luhn = (f"list_sum(list_transform(range(1, length({digits}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN "
            f"CAST(substr(reverse({digits}), i, 1) AS INT) ELSE (CASE WHEN CAST(substr(reverse({digits}), i, 1) AS INT) > 4 "
            f"THEN 2 * CAST(substr(reverse({digits}), i, 1) AS INT) - 9 ELSE 2 * CAST(substr(reverse({digits}), i, 1) AS INT) END) END)) % 10 = 0")
    bare = "replace(m, ' ', '')"
    number = (f"array_to_string(list_transform(string_split(substr({bare}, 5) || substr({bare}, 1, 4), ''), "
              "lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN c ELSE CAST(ascii(c) - 55 AS VARCHAR) END), '')")
    mod97 = f"list_reduce(list_transform(string_split({number}, ''), lambda x: CAST(x AS INT)), lambda a, x: (a * 10 + x) % 97) = 1"
    valid = {
        "email": "true",
        "ip": "len(list_filter(string_split(m, '.'), lambda x: length(ltrim(x, '0')) > 3 OR coalesce(try_cast(ltrim(x, '0') AS INT), 0) > 255)) = 0",
        "card": f"length({digits}) BETWEEN 13 AND 19 AND {luhn}",
        "phone": f"length({digits}) BETWEEN 9 AND 15", "iban": mod97,
        "ssn": "NOT regexp_matches(m, '^(?:000|666|9)|-00-|-0000$')", "key": "true",
        "secret": "regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]')",
    }

    def near(words: tuple[str, ...]) -> str:
        return f"regexp_matches(around, '(?i)\\b(?:{'|'.join(words)})s?\\b')"

    score = {k: f"{pii.PRIOR[k] + (pii.CONFIRMED if k in ('card', 'iban') else 0)} + CASE WHEN {near(pii.CONTEXT_WORDS[k])} THEN {pii.CONTEXT} ELSE 0 END "
                f"- CASE WHEN {near(pii.AGAINST_WORDS)} THEN {pii.CONTEXT} ELSE 0 END" for k in PLAIN}
    parts = " UNION ALL ".join(
        f"SELECT rid, {i} AS ord, {_quote(k)} AS kind, regexp_extract_all(body, {_quote(p)}) AS ms, "
        f"string_split_regex(body, {_quote(p)}) AS gs FROM d" for i, (k, p) in enumerate(PLAIN.items()))
    ok = " OR ".join(f"(kind = '{k}' AND {v}" + (f" AND {score[k]} >= {pii.THRESHOLD}" if k not in pii.BASE_KINDS else "") + ")"
                     for k, v in valid.items())
    span = "kind || ':' || s || ':' || (s + length(m))"
    base = "kind IN (" + ", ".join(map(_quote, pii.BASE_KINDS)) + ")"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body FROM documents),
found AS ({parts}),
each AS (SELECT rid, ord, kind, ms, gs, unnest(range(1, len(ms) + 1)) AS i FROM found),
put AS (SELECT rid, ord, kind, ms[i] AS m,
  CAST(list_sum(list_transform(gs[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s FROM each),
placed AS (SELECT put.*, substr(body, greatest(s - {pii.REACH}, 0) + 1, s - greatest(s - {pii.REACH}, 0)) || ' ' ||
  substr(body, s + length(m) + 1, {pii.REACH}) AS around FROM put JOIN d USING (rid)),
good AS (SELECT rid, ord, kind, m, CAST(s AS BIGINT) AS s FROM placed WHERE {ok}),
told AS (SELECT rid, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in pii.BASE_KINDS)},
  string_agg({span}, ',' ORDER BY ord, s) FILTER ({base}) AS base, string_agg({span}, ',' ORDER BY ord, s) AS spans FROM good GROUP BY rid)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in pii.BASE_KINDS)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN told USING (rid)"""


# ---------------------------------------------------------------- WARC

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
q AS (SELECT page_id, strlen(body) AS n, sha1(body) AS sha, max(page_id) OVER (PARTITION BY body) AS last FROM p)
SELECT page_id, n AS payload_bytes,
  array_to_string(list_transform(range(0, 8), lambda g: array_to_string(list_transform([15, 10, 5, 0],
    lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(sha, 1 + 5 * g, 5) AS INT) >> s) & 31), 1)), '')), '') AS payload_digest,
  CASE WHEN last IS NULL OR page_id IS NOT DISTINCT FROM last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM last THEN last END AS refers_to FROM q"""

# ---------------------------------------------------------------- clusters

KEPT = """
WITH kept AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS row_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
 FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x) AND abs(x) <= 524288)) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS k, v AS c FROM kept WHERE vec_id IS NOT NULL
 ORDER BY sha256('2:' || vec_id), v LIMIT 40)"""
ASSIGN = """, a{i} AS MATERIALIZED (SELECT vec_id, v, arg_min(struct_pack(k := k, d := d), struct_pack(d := d, k := k)) AS near FROM (
  SELECT vec_id, row_id, v, k, CAST(list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d FROM kept, c{i})
  GROUP BY vec_id, row_id, v)"""
MOVE = """, c{j} AS MATERIALIZED (SELECT k, coalesce(m, c) AS c FROM c{i} LEFT JOIN (
  SELECT k, list(q ORDER BY pos) AS m FROM (
    SELECT k, pos, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS q
    FROM (SELECT near.k AS k, unnest(v) AS x, unnest(range(len(v))) AS pos FROM a{i}) GROUP BY k, pos) GROUP BY k) USING (k))"""


def _clusters() -> str:
    steps = "".join(ASSIGN.format(i=i) + MOVE.format(i=i, j=i + 1) for i in range(centroids.ROUNDS))
    return KEPT + steps + ASSIGN.format(i=centroids.ROUNDS) + f"""
SELECT vec_id, CAST(near.k AS INT) AS cluster, near.d AS distance, CAST(sum(near.d) OVER (PARTITION BY near.k) AS BIGINT) AS cluster_inertia,
 CAST(sum(near.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256 FROM a{centroids.ROUNDS} JOIN c{centroids.ROUNDS} ON k = near.k"""


# ---------------------------------------------------------------- fill in the middle

FIM = """
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
 sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
 sha256(t) AS restored_sha256
FROM (SELECT *, substr(t, 1, a) AS pre, substr(t, a + 1, b - a) AS mid, substr(t, b + 1) AS suf,
 CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
  WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
 FROM (SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b
  FROM (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
   list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')), i, 8) AS BIGINT)) AS h FROM documents)))"""

ORACLES = {
    "op1_template_decontamination": _leaks(),
    "op2_risk_controlled_quality": _quality(),
    "op3_association_url_rules": _urls(),
    "op4_pii_spans": _pii(),
    "op5_salvage_warc": WARC,
    "op12_laesa_clusters": _clusters(),
    "op13_frame_fill_in_middle": FIM,
}
