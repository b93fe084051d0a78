"""Rule-cell parsing: the rule spellings of the metadata sheets."""

import pytest

from vaultline.plans.rules import normalize_handling, parse_cell, parse_rule, split_cell


def kinds(cell):
    return [(r.kind, r.args, r.status) for r in parse_cell(cell, "c")]


def test_sheet_spellings():
    assert kinds("Not Null") == [("not_null", (), "ok")]
    assert kinds("Range(1, 10)") == [("range", (1, 10), "ok")]
    assert kinds("range(0, 10000)") == [("range", (0, 10000), "ok")]
    assert kinds("unique") == [("unique", (), "ok")]
    assert kinds("primary key") == [("unique", (), "ok")]


def test_regex_keeps_case_and_parentheses():
    # the whole argument, case kept, up to the LAST closing parenthesis
    assert kinds("Regex(^[a-zA-Z]+$)") == [("regex", ("^[a-zA-Z]+$",), "ok")]
    assert kinds("regex(^(ab|cd)+$)") == [("regex", ("^(ab|cd)+$",), "ok")]
    assert kinds("pattern('^[A-Z]{2,3}$')") == [("regex", ("^[A-Z]{2,3}$",), "ok")]


def test_unsupported_and_malformed_are_reported():
    assert kinds("Unsupported") == [("unsupported", (), "unsupported")]
    assert kinds("min(3)")[0][2] == "unsupported"          # not read as in(...)
    assert kinds("range(1)")[0][2] == "malformed"
    assert kinds("regex(abc")[0][2] == "malformed"
    assert kinds("max_length(x)")[0][2] == "malformed"


def test_blank_cells_mean_no_rule():
    for cell in (None, "", "  ", "nan", "None"):
        assert parse_cell(cell, "c") == []


def test_several_rules_per_cell():
    assert [k for k, _, _ in kinds("not null; range(0, 5), max_length(5)")] == ["not_null", "range", "max_length"]
    assert split_cell("in('a,b', 'c'); not null") == ["in('a,b', 'c')", "not null"]


def test_accepted_values_keep_case_and_types():
    assert kinds("in('A,B', 'c')") == [("accepted_values", ("A,B", "c"), "ok")]
    assert kinds("in(1, 2, 3)") == [("accepted_values", (1, 2, 3), "ok")]


def test_open_range_and_relationships():
    assert kinds("range(, 10)")[0][2] == "malformed"
    assert kinds("range(null, 10)") == [("range", (None, 10), "ok")]
    assert kinds("relationships(customer.c_custkey)") == [("relationships", ("customer", "c_custkey"), "ok")]
    assert kinds("unique_combination(a, b)") == [("unique_combination", ("a", "b"), "ok")]
    assert kinds("chronology(load_datetime)") == [("chronology", ("load_datetime",), "ok")]


def test_handling_and_severity():
    r = parse_rule("not null", "c", handling="Log Warning", severity="WARN")
    assert r.handling == "log" and r.severity == "warn" and r.effective_handling == "log"
    assert normalize_handling("drop") == "discard"
    assert normalize_handling("Quarantine and alert") == "quarantine"
    assert normalize_handling(None) == "quarantine"
    with pytest.raises(ValueError):
        normalize_handling("explode")
    assert parse_rule("not null", "c", handling="quarantine", severity="warn").effective_handling == "log"
