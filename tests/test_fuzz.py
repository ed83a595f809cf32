"""Random texts: the merged Java patterns against the step-by-step SQL."""

from __future__ import annotations

import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from recordloom.functions import text as tx
from recordloom.operators import cleaner
from recordloom.plans import check_sql as q
from recordloom.plans.record_queries import cleaned_sql

PIECES = [
    " ", " ", "  ", "\t", "\n", "\n", "\x0b", " ", " ", "\uFEFF", " ", "\uFFFD", "\x07", "\x7f",
    "{", "}", "{ a", "{\n", "<", ">", "<b>", "</p >", "&", "&amp;", "&lt;", "&#39;", "&nbsp;", "&quot;",
    "a", "Bc", "d_e", "\u00E9", "\u00DF", "\u65E5", "\U0001f600", "7", "12", "1.", "2) ", "3.\n", "-", "\u2014", "\u2013", "\u2022", ":", " : ",
    "Title", "title:", "Titles -", "Note", "Notes:", "NOTE \u2014", "Learning Outcome:", "learningoutcome :", "x",
    "n/a", "N / A", "na", "none", "(a) ", "b. ", "c) ", "x@y.org", "+49 30 1234567", "\n+49 (0)30 555-12\n",
    "Enrol now", "contact provider", "for more information", "National Qualification Framework", " (NQF)", "...", "!",
]
CHECKS = {
    "trim": (tx.trim_ws, q.trim),
    "collapse": (tx.collapse_ws, q.collapse),
    "entities": (tx.decode_entities, q.entities),
    "strip_html": (tx.strip_html, q.strip_html),
    "strip_labels": (tx.strip_labels, q.strip_labels),
    "strip_enumeration": (tx.strip_enumeration, q.strip_enumeration),
    "strip_filler": (tx.strip_filler, q.strip_filler),
    "strip_bullets": (tx.strip_bullets, lambda x: q.sub(x, q.BULLET, "")),
    "strip_contacts": (tx.strip_contacts, lambda x: q.sub(x, q.CONTACT, "")),
    "clean_text": (lambda c: cleaner.clean_text(c)["cleaned"], cleaned_sql),
    "is_filled": (tx.is_filled, q.is_filled),
    "is_filled_null": (lambda c: tx.is_filled(c, ("null",)), lambda x: q.is_filled(x, True)),
}


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    made = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    return [*made, " [] ", "[]", " null", "NULL", ""]


@pytest.mark.parametrize("name", CHECKS)
def test_same_as_sql(evaluate, texts, name):
    fn, sql = CHECKS[name]
    frame = pd.DataFrame({"i": range(len(texts)), "t": texts})
    connection = duckdb.connect()
    connection.register("texts", frame)
    expected = [r[0] for r in connection.execute(f"SELECT {sql('t')} FROM texts ORDER BY i").fetchall()]
    got = evaluate(fn, texts)
    wrong = [(t, g, e) for t, g, e in zip(texts, got, expected, strict=True) if g != e]
    assert not wrong, wrong[:3]


def test_garbage_same_as_sql(evaluate, texts):
    plain = [t for t in texts if all(ord(c) < 65536 for c in t)]
    short = [t[:n] for t in plain[:1500] for n in (1, 2, 3, 5)]
    frame = pd.DataFrame({"i": range(len(short)), "t": short})
    connection = duckdb.connect()
    connection.register("texts", frame)
    expected = [r[0] for r in connection.execute(f"SELECT {q.is_garbage('t')} FROM texts ORDER BY i").fetchall()]
    got = evaluate(tx.is_garbage, short)
    wrong = [(t, g, e) for t, g, e in zip(short, got, expected, strict=True) if g != e]
    assert not wrong, wrong[:3]


def test_audit_accounts_for_every_character(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "s string")
    audit = rows.select("s", cleaner.clean_text(F.col("s")).alias("c")).select("s", "c.cleaned", "c.removed")
    for r in audit.collect():
        gone = sum(map(len, r.removed))
        blank_left = r.cleaned == "" and gone < len(r.s)
        assert len(r.s) == len(r.cleaned) + gone or (blank_left and not set(r.s) - set("".join(r.removed)) - set(tx.WS_CHARS))
