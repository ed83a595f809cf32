"""Hand-derived rows for every text and outcome operator."""

from __future__ import annotations

import pytest

from recordloom.functions import outcomes as ox
from recordloom.functions import text as tx
from recordloom.functions import variants as vx
from recordloom.operators import cleaner, extract

CASES = {
    "first_number": (tx.first_number, {
        "EQF level 5": "5", "Level5": "5", "5.5": "5.5", "Level 5.5": "5.5",
        "Level 05 (3)": "05", "none": "", None: "",
    }),
    "first_integer": (tx.first_integer, {"EQF level 5": "5", "5.5": "5", "Level 05 (3)": "05", "none": "", None: ""}),
    "level_number": (tx.level_number, {
        "EQF level 5": "5", "Level5": "5", "EQFLevel 5": "", "5.5": "", "Level 5.5": "5",
        "\u00E9Level 3": "3", "Level\u00A07": "7", "Level 05 (3)": "05", "none": "", None: "",
    }),
    "strip_html": (tx.strip_html, {
        "<p>Hello&nbsp;&amp; bye</p>": "Hello&nbsp;& bye", "&lt;b&gt;x": "<b>x", "&amp;lt;": "<",
        "{color: red}": ": red", "a\u00A0\uFEFF\uFFFDb\x07c": "a b c", "{\x07word}": "word",
        "{ a {b}c": "c", "  x  y ": "x y", " {": "", "{a}": "", "x{ y": "x", "a {b}": "a",
        "{" * 20000: "", "a" + " \n" * 20000 + "b": "a b", None: "",
    }),
    "is_garbage": (tx.is_garbage, {
        **dict.fromkeys(["1.", "12", "ab", "NA NA", "NA  NA", "n/a", "N / A", "N A", "none",
                         "\u2014", "--", "...!", " ", "\u00A0", None, "\U0001f600"], True),
        **dict.fromkeys(["abc", "1) x", "nana", "n a a", "a \u2014 b", "n\\a", "\U0001f600a"], False),
    }),
    "strip_enumeration": (tx.strip_enumeration, {
        "1) a\n 2. b\n\n3) c ; 4) d": "a\nb\nc ; 4) d", "a) x": "a) x", "1.5 hours": "1.5 hours",
        "2020. Text": "Text", "1) 2) x": "2) x", "a\r\n1) b": "a\rb", "a\r\n\r\n 1) b": "a\rb", "a\u00851) b": "a\u00851) b",
        "a\u20281) b": "a\u2028b", "a\r1) b": "a\rb", None: None,
    }),
    "strip_labels": (tx.strip_labels, {
        "Title: A\nNote - b": "A b", "Title: A  Notes: b": "A b", "See note: x": "See x",
        "Note x": "Note x", "Title: \nNote - b": "Note - b", "subtitle: x": "subtitle: x",
        "a\n\n Titles \u2014 b": "a b", "LEARNING outcome :x": "x", None: "",
    }),
    "strip_bullets": (tx.strip_bullets, {
        "1. a\n2) b\n a. c\na) d\n(a) e\n- f\n\u2022g": "a\nb\nc\nd\ne\nf\ng", "Y. x": "Y. x", "1.5 x": "1.5 x",
    }),
    "strip_contacts": (tx.strip_contacts, {
        "a\nx@y.org\n+49 30 1234567 \nb": "a\n\n\nb", "mail x@y.org now": "mail x@y.org now",
    }),
    "strip_filler": (tx.strip_filler, {
        "Good. Please contact the provider for more information. ENROL NOW": "Good. . ",
        "Enrol now ": "", "abc": "abc", " ": " ",
        "National Qualification Framework (NQF) x": " x",
    }),
    "removed_filler": (tx.removed_filler, {
        "Good. Please contact the provider for more information. ENROL NOW":
            ["Please contact the provider for more information", "ENROL NOW"], "abc": [],
    }),
    "label_text": (lambda c: vx.label_text(vx.parse_json(c), c), {
        '"Ireland"': "Ireland", '{"de":"Irland","en":"Ireland"}': "Ireland",
        '{"en-US":"A","en-GB":"B"}': "B", '{"@value":"A","value":"B"}': "A",
        '{"fr":"Irlande","de":"Irland"}': "Irlande", '[{"de":"x"},{"en":"y"}]': "y",
        '[{"de":"x"},"z"]': "z", '[{"@value":"v"}]': "v", "null": None, '[{"de":"x"}]': None,
        "[]": None, '{"a":1}': None, "7": "7", "[7]": "7", '{"a":1,"b":"","c":"x"}': "",
    }),
    "parse_json": (lambda c: vx.text_at(vx.parse_json(c), "$"), {
        '{"a":1}': '{"a":1}', '{"a":1} x': None, "1, 2": None, "": None, '{"a":1}] junk': None,
        '[{"a":1}]]': None, "5": "5", '"s"': "s", '{"a":1,"a":2}': '{"a":2}', "{'a':1}": None,
        "[1,]": None, "01": None, "NaN": None,
    }),
    "last_path_segment": (tx.last_path_segment, {
        "http://data.example/snb/data/q/abc-1/": "abc-1", "http://x.org/a?p=/z": "a",
        "http://x.org/": None, "foo/bar": "bar", "http://x.org/a b": "a%20b", "http://x.org": None,
        "foo/bar?x=/z": "z",
    }),
    "last_slash_part": (tx.last_slash_part, {
        "http://data.example/snb/data/q/abc-1/": "abc-1", "http://x.org/a?p=/z": "z",
        "http://x.org/": "x.org", "foo/bar": "bar", "//": None,
    }),
    "safe_key": (tx.safe_key, {"a b/\u00E9.json": "a_b__.json"}),
    "notes_text": (ox.notes_text, {
        "[]": "", "": "", None: "",
        '[{"title":"t","additionalNote":["a"," b ",""]},{"additionalNote":"c"},null]': "a ; b ; c",
        '[{"additionalNote":["x","y"]},{"additionalNote":["z"]}': "x ; z",
        '{"additionalNote":["x","y"]}': "x", '[{"additionalNote":[7]}': "7",
        '[{"additionalNote":[a, b"c,d"]}': 'a ; b"c,d',
        '[{"additionalNote":["say \\"hi\\" \\\\"]}': 'say "hi" \\',
        '[{"additionalNote":["' + "x" * 50000 + '"]}': "x" * 50000,
        '[{"additionalNote":[7, true, null]}]': "7 ; true", '["a", 3]': "",
    }),
    "outcomes_text": (ox.outcomes_text, {
        '[{"title":"A","additionalNotes":"x\\n\\ny"}]': "A \u2014 x y",
        '[{"title":"1.","additionalNotes":""},{"title":"Use tools","additionalNotes":""}]': "Use tools",
        '["Plan work", 5, null]': "Plan work", '{"learningOutcome":[{"title":"Lead team"}]}': "Lead team",
        '{"title":"Solo task"}': "Solo task", "[{'title': 'Use tools', note: 'safely'}]": "Use tools \u2014 safely",
        "5": "", "null": "", "": "", None: "", '"text"': "",
        '["Plan work","Lead team"]': "Plan work\n\nLead team",
        '[{"title":"Plan work","additionalNotes":"x"},{"title":"B c d"': "Plan work \u2014 x\n\nB c d",
        '[{"x":1},{"y":2}': '"x":1\n\n"y":2',
        '[{"titleLiteral":"Abc","additionalNote":[{"noteLiteral":"n1"},{"note":"n2"},"s",null]}]': "Abc \u2014 n1 n2",
        '[{"name":"Abc","additionalNote":[],"notes":"not used"}]': "Abc",
        '[{"title":0,"prefLabel":"Abc","note":"n"}]': "Abc \u2014 n",
        '[{"title":"Abc","additionalNotes":["p","q"]}]': "Abc \u2014 p,q",
        '[{"title":"Abc","additionalNote":"text"}]': "Abc \u2014 text",
    }),
    "clean_text": (lambda c: cleaner.clean_text(c)["cleaned"], {
        "- Contact provider\nx@y.org\n1) go": "\n\ngo", "a": "a", None: "",
    }),
    "unescape": (tx.unescape_basic, {'a\\"b\\\\': 'a"b\\'}),
    "collapse": (tx.collapse_ws, {" a\u2003\n b ": "a b"}),
}


@pytest.mark.parametrize("name", CASES)
def test_golden(evaluate, name):
    fn, table = CASES[name]
    got = evaluate(fn, list(table))
    assert dict(zip(table, got, strict=True)) == table


def test_collapse_is_idempotent(evaluate):
    texts = [" a  b ", "\u00A0x\n\n y\uFEFF", ""]
    once = evaluate(tx.collapse_ws, texts)
    assert evaluate(tx.collapse_ws, once) == once


def test_filler_audit_accounts_for_every_character(evaluate):
    texts = ["Enrol now and see website for details, x", "For more information contact the provider!"]
    cleaned = evaluate(tx.strip_filler, texts)
    removed = evaluate(tx.removed_filler, texts)
    for text, left, gone in zip(texts, cleaned, removed, strict=True):
        assert len(text) == len(left) + sum(map(len, gone))


def test_envelope_shapes(spark):
    payloads = {
        '{"items":[1,2],"results":[3]}': 2, '{"results":[{"a":1}]}': 1, '{"hits":{"hits":[{}]}}': 1,
        '{"data":{"items":[{}]}}': 1, '{"data":{"results":[{}]}}': 1, "[{},{}]": 2,
        '{"z":["s"],"a":[{"k":1}],"b":[{},{}]}': 1, '{"z":[null,1],"a":[{}]}': 2, '{"a":5}': 0, "5": 0, "x": 0,
        '{"items":[],"other":[{}]}': 0,
    }
    rows = [(i, p) for i, p in enumerate(payloads)]
    pages = spark.createDataFrame(rows, "page int, payload string")
    counts = {r.page: r["count"] for r in extract.unnest_items(pages).groupBy("page").count().collect()}
    assert [counts.get(i, 0) for i in range(len(rows))] == list(payloads.values())
