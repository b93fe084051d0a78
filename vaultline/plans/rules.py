"""Data-quality rule cells -> typed rules.

A ``Validations`` cell may hold several rules separated by ``;`` or by
top-level commas: ``Not Null; Range(1, 10)``. The rule *name* is case-folded,
its argument is kept as written (a regex keeps its case). The argument is
everything between the first ``(`` and the last ``)``. Anything not
recognised becomes an ``unsupported`` rule so it is reported, never dropped;
a blank cell means no rule.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace

# Accepted rule spellings -> rule kind.
RULE_NAMES = {
    "not null": "not_null", "not_null": "not_null", "notnull": "not_null", "required": "not_null",
    "unique": "unique", "primary key": "unique", "primary_key": "unique",
    "range": "range", "between": "range",
    "in": "accepted_values", "accepted_values": "accepted_values", "accepted values": "accepted_values",
    "regex": "regex", "pattern": "regex",
    "max_length": "max_length", "min_length": "min_length",
    "length": "length_between", "length_between": "length_between",
    "expression": "expression", "expression_is_true": "expression",
    "unique_combination": "unique_combination",
    "relationships": "relationships",
    "chronology": "chronology",
    "hash_key": "hash_key_format", "hash_key_format": "hash_key_format",
    "not blank": "not_blank", "not_blank": "not_blank",
}

# Rules that look at one row at a time; the others need a shuffle over a key.
ROW_KINDS = {"not_null", "range", "accepted_values", "regex", "max_length", "min_length",
             "length_between", "expression", "hash_key_format", "not_blank", "cast_failed"}
KEYED_KINDS = {"unique", "unique_combination", "relationships", "chronology"}

# Reject handling, strongest first (the order decides which wins per row).
HANDLING_ORDER = ("fail_job", "quarantine", "discard", "log")
_HANDLING_SPELLINGS = {
    "fail": "fail_job", "fail_job": "fail_job", "fail job": "fail_job", "abort": "fail_job",
    "quarantine": "quarantine", "reject": "quarantine",
    "discard": "discard", "drop": "discard", "skip": "discard",
    "log": "log", "log_warning": "log", "log warning": "log", "warn": "log", "log and continue": "log",
}


@dataclass(frozen=True)
class Rule:
    column: str | None
    kind: str
    args: tuple = ()
    text: str = ""
    table: str | None = None
    handling: str = "quarantine"
    severity: str = "error"
    status: str = "ok"          # ok | unsupported | malformed
    message: str = ""
    extra: dict = field(default_factory=dict, compare=False, hash=False)
    label: str | None = None    # set by ``named`` where kind and column do not tell rules apart

    @property
    def name(self) -> str:
        """Identifier used in failure arrays and summaries, unique within a list
        that went through ``named``."""
        return self.label or (f"{self.kind}:{self.column}" if self.column else self.kind)

    @property
    def effective_handling(self) -> str:
        """``severity=warn`` downgrades any handling to ``log``."""
        return "log" if self.severity == "warn" else self.handling

    @property
    def is_row_rule(self) -> bool:
        return self.status == "ok" and self.kind in ROW_KINDS

    @property
    def is_keyed(self) -> bool:
        return self.status == "ok" and self.kind in KEYED_KINDS


def named(rules) -> list[Rule]:
    """The rules with unique names: where several share kind and column, the
    arguments are part of the name, then handling, then a number. The same list
    always gets the same names."""
    rules = [replace(r, label=None) for r in rules]
    same: dict[str, int] = {}
    for r in rules:
        same[r.name] = same.get(r.name, 0) + 1
    out, taken = [], set()
    for r in rules:
        label = r.name
        if same[label] > 1:
            label = f"{r.name}({', '.join(map(str, r.args))})" if r.args else r.name
            if label in taken:
                label = f"{label} {r.effective_handling}"
            n, base = 2, label
            while label in taken:
                label, n = f"{base} #{n}", n + 1
            r = replace(r, label=label)
        taken.add(label)
        out.append(r)
    return out


def problems(rules) -> list[dict]:
    """What a job must report: rules that cannot run."""
    return [{"column": r.column, "rule": r.text, "status": r.status, "message": r.message} for r in rules if r.status != "ok"]


def handling_in(text: str | None) -> str | None:
    """The reject handling that a free text ("Log and continue") names, if any."""
    words = re.findall(r"[a-z_]+", (text or "").lower())
    return next((_HANDLING_SPELLINGS[w] for w in words if w in _HANDLING_SPELLINGS), None)


def normalize_handling(text: str | None) -> str:
    t = (text or "").strip().lower()
    if not t:
        return "quarantine"
    if t in _HANDLING_SPELLINGS:
        return _HANDLING_SPELLINGS[t]
    for word, kind in _HANDLING_SPELLINGS.items():   # "quarantine and alert", ...
        if t.startswith(word):
            return kind
    raise ValueError(f"unknown reject handling {text!r}")


def split_cell(cell: str | None, seps: str = ";,", quotes_at_top: bool = False) -> list[str]:
    """Split a cell on ``;`` and on commas outside parentheses/quotes."""
    if cell is None:
        return []
    text = str(cell).strip()
    if not text or text.lower() in ("nan", "none", "null"):
        return []
    out, depth, quote, cur = [], 0, None, []
    for ch in text:
        if quote:
            cur.append(ch)
            if ch == quote:
                quote = None
            continue
        if ch in "'\"" and (depth > 0 or quotes_at_top):
            quote = ch
        elif ch == "(":
            depth += 1
        elif ch == ")":
            depth = max(0, depth - 1)
        elif ch in seps and depth == 0:
            out.append("".join(cur).strip())
            cur = []
            continue
        cur.append(ch)
    out.append("".join(cur).strip())
    return [p for p in out if p]


def _unquote(s: str) -> str:
    s = s.strip()
    if len(s) >= 2 and s[0] == s[-1] and s[0] in "'\"":
        return s[1:-1]
    return s


def _number(s: str):
    s = _unquote(s)
    if re.fullmatch(r"[+-]?\d+", s):
        return int(s)
    if re.fullmatch(r"[+-]?(\d+\.\d*|\.\d+|\d+)([eE][+-]?\d+)?", s):
        return float(s)
    return s


def _args(inner: str) -> list[str]:
    return split_cell(inner, seps=",", quotes_at_top=True) if inner.strip() else []


def parse_rule(text: str, column: str | None = None, table: str | None = None,
               handling: str | None = None, severity: str | None = None) -> Rule:
    """Parse one rule text (already split from its cell)."""
    raw = text.strip()
    base = dict(column=column, text=raw, table=table,
                handling=normalize_handling(handling), severity=(severity or "error").strip().lower())
    if "(" in raw:
        name = raw[:raw.index("(")].strip().lower()
        close = raw.rfind(")")
        if close < raw.index("("):
            return Rule(kind=RULE_NAMES.get(name, name), status="malformed",
                        message="no closing parenthesis", **base)
        inner = raw[raw.index("(") + 1:close]
    else:
        name, inner = raw.lower(), None
    name = re.sub(r"\s+", " ", name)
    kind = RULE_NAMES.get(name)
    if kind is None:
        return Rule(kind="unsupported", status="unsupported", message=f"unsupported rule {raw!r}", **base)

    def bad(msg):
        return Rule(kind=kind, status="malformed", message=msg, **base)

    if kind in ("not_null", "unique", "hash_key_format", "not_blank"):
        return Rule(kind=kind, **base)
    if inner is None:
        return bad("missing argument")
    if kind in ("regex", "expression"):
        arg = _unquote(inner)
        return Rule(kind=kind, args=(arg,), **base) if arg else bad("empty argument")
    parts = _args(inner)
    if kind == "range":
        if len(parts) != 2:
            return bad("range needs two bounds")
        lo, hi = (None if p.lower() in ("", "none", "null") else _number(p) for p in parts)
        return Rule(kind=kind, args=(lo, hi), **base)
    if kind == "accepted_values":
        if not parts:
            return bad("no values")
        # args: typed values for numeric columns; extra["texts"]: the values as
        # written, compared as text on string columns.
        return Rule(kind=kind, args=tuple(_number(p) for p in parts),
                    extra={"texts": tuple(_unquote(p) for p in parts)}, **base)
    if kind in ("max_length", "min_length"):
        if len(parts) != 1 or not isinstance(_number(parts[0]), int):
            return bad("length needs one integer")
        return Rule(kind=kind, args=(_number(parts[0]),), **base)
    if kind == "length_between":
        nums = [_number(p) for p in parts]
        if len(nums) != 2 or not all(isinstance(n, int) for n in nums):
            return bad("length needs two integers")
        return Rule(kind=kind, args=tuple(nums), **base)
    if kind == "unique_combination":
        cols = tuple(_unquote(p) for p in parts)
        return Rule(kind=kind, args=cols, **base) if cols else bad("no columns")
    if kind == "relationships":
        ref = [_unquote(p) for p in parts]
        if len(ref) == 1 and "." in ref[0]:
            ref = ref[0].split(".", 1)
        return Rule(kind=kind, args=tuple(ref), **base) if len(ref) == 2 else bad("needs table.column")
    if kind == "chronology":
        return Rule(kind=kind, args=tuple(_unquote(p) for p in parts), **base) if parts else bad("needs a load column")
    return bad("unhandled")


def parse_cell(cell, column=None, table=None, handling=None, severity=None) -> list[Rule]:
    return [parse_rule(t, column, table, handling, severity) for t in split_cell(cell)]


def rules_from_rows(rows) -> list[Rule]:
    """Rows with keys table_name, column_name, rule, reject_handling, severity
    (dicts or Rows of the canonical ``rules`` metadata table)."""
    out: list[Rule] = []
    for r in rows:
        d = r.asDict() if hasattr(r, "asDict") else dict(r)
        out += parse_cell(d.get("rule"), d.get("column_name"), d.get("table_name"),
                          d.get("reject_handling"), d.get("severity"))
    return out
