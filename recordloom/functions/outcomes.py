"""Learning-outcome lists: reading, repairing, flattening."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordloom.constants import NOTE_SEMICOLON, PARAGRAPH, TITLE_DASH, WS, WS_CHARS
from recordloom.functions import text as tx
from recordloom.functions import variants as vx
from recordloom.functions.text import let

_NO_ITEMS = "cast(array() as array<struct<title:string,notes:string>>)"


# --- from parsed documents -------------------------------------------------


def note_texts(doc: Column, body: Column) -> Column:
    """All `learningOutcome[*].additionalNote[*].noteLiteral` texts, in order.

    A literal may be one label or a list of labels. The JSON texts of the literals are cut out
    of the record level by level, each level read once, and met by their index; they are needed
    (and made) only where a literal is an object or a list.
    """
    texts = "array<string>"
    needed = body.rlike(rf'"noteLiteral"{WS}*:{WS}*[\[{{]') | body.contains("\\u")

    def parts(text: Column, path: str) -> Column:
        return F.from_json(F.get_json_object(text, path), texts)

    def literals(n: Column, raw: Column) -> Column:
        many = vx.array_at(n, "$.noteLiteral")

        def listed(raws: Column) -> Column:
            return F.transform(many, lambda x, k: vx.label_text(x, F.get(raws, k)))

        return F.when(many.isNotNull(), let(F.from_json(raw, texts), listed)).otherwise(
            F.array(vx.label_text(vx.variant_at(n, "$.noteLiteral"), raw))
        )

    def per_outcome(lo: Column, raw: Column) -> Column:
        def of_notes(raws: Column) -> Column:
            return F.flatten(
                F.transform(
                    vx.elements_at(lo, "$.additionalNote"),
                    lambda n, j: literals(n, F.get_json_object(F.get(raws, j), "$.noteLiteral")),
                )
            )

        return let(parts(raw, "$.additionalNote"), of_notes)

    def of_outcomes(raws: Column) -> Column:
        return F.flatten(
            F.transform(
                vx.elements_at(doc, "$.learningOutcome"), lambda lo, i: per_outcome(lo, F.get(raws, i))
            )
        )

    notes = let(F.when(needed, parts(body, "$.learningOutcome")), of_outcomes)
    return F.filter(notes, lambda t: t != "")


def lo_outcomes(doc: Column) -> Column:
    """`array<struct<title, additionalNote:array<string>>>` of a learning opportunity."""

    def note(n: Column) -> Column:
        literal = vx.variant_at(n, "$.noteLiteral")
        return F.when(vx.is_text(literal), F.nullif(vx.text_at(n, "$.noteLiteral"), F.lit("")))

    def outcome(lo: Column) -> Column:
        notes = F.transform(vx.elements_at(lo, "$.additionalNote"), note)
        return F.struct(
            vx.text_at(lo, "$.title", "").alias("title"),
            F.filter(notes, lambda t: t.isNotNull()).alias("additionalNote"),
        )

    los = vx.elements_at(doc, "$.learningAchievementSpecification.learningOutcome")
    return F.transform(los, outcome)


def qual_outcomes(doc: Column) -> Column:
    """`array<struct<title, additionalNotes>>` of a qualification; null entries skipped."""

    def outcome(lo: Column) -> Column:
        notes = F.transform(
            vx.elements_at(lo, "$.additionalNote"), lambda n: vx.filled_at(n, "$.noteLiteral")
        )
        return F.struct(
            vx.first_filled(vx.filled_at(lo, "$.title")).alias("title"),
            F.array_join(notes, PARAGRAPH).alias("additionalNotes"),
        )

    los = F.filter(vx.elements_at(doc, "$.learningOutcome"), lambda lo: ~F.is_variant_null(lo))
    return F.transform(los, outcome)


# --- from raw text cells ---------------------------------------------------


# The three repairs of a cell that is not JSON, in this order
# (single-quoted words, single-quoted values, bare keys).
_REPAIRS = [
    (rf"([\[{{,]{WS}*)'([^']+)'({WS}*[:,\]}}])", '$1"$2"$3'),
    (rf":{WS}*'([^']*)'", ': "$1"'),
    (rf'"?+(?<![a-zA-Z0-9_])([a-zA-Z0-9_]++)"?+{WS}*+:', '"$1":'),
]

# Patterns that find titles and notes in a cell beyond repair.
_TITLE = rf"""(?i)title["']?{WS}*:{WS}*["']([^"']+)["']"""
_NOTE = (
    rf"""(?i)(?:additionalNotes?|noteLiteral)["']?{WS}*:{WS}*["']([^"']*)["']"""
)
_BLOCK_TITLE = rf"""title[^:]*:{WS}*["']([^"']+)["']"""
_BLOCK_NOTE = rf"""additionalNote[^:]*:{WS}*["']([^"']*)["']"""


def repair_json(c: Column) -> Column:
    for pattern, replacement in _REPAIRS:
        c = F.regexp_replace(c, pattern, replacement)
    return c


def _item_parts(item: Column) -> Column:
    """Raw title and notes of one list item of any known shape."""
    title = vx.first_at(item, ["$.title", "$.titleLiteral", "$.prefLabel", "$.name"], vx.plain)
    note_list = F.transform(
        vx.array_at(item, "$.additionalNote"),
        lambda n: vx.first_at(n, ["$.noteLiteral", "$.note"], vx.plain),
    )
    single = vx.variant_at(item, "$.additionalNote")
    note = vx.first_of(
        [
            vx.variant_at(item, "$.additionalNotes"),
            F.when(vx.is_text(single), single),
            *[vx.variant_at(item, p) for p in ("$.noteLiteral", "$.note", "$.notes")],
        ],
        vx.plain,
    )
    notes = F.when(note_list.isNotNull(), F.array_join(note_list, PARAGRAPH)).otherwise(note)
    return F.struct(
        F.when(vx.is_text(item), vx.text_at(item, "$"))
        .otherwise(tx.or_empty(title))
        .alias("title"),
        tx.or_empty(notes).alias("notes"),
    )


def _items_of(v: Column) -> Column:
    """An array as it is, an object's `learningOutcome` list, or the object alone."""
    return F.coalesce(
        vx.array_at(v, "$"),
        vx.array_at(v, "$.learningOutcome"),
        F.when(vx.kind(v).startswith("OBJECT"), F.array(v)),
        F.expr("cast(array() as array<variant>)"),
    )


def _found_by_pattern(cell: Column) -> Column:
    """Titles and notes picked out of unparsable text, paired in order."""
    titles = F.regexp_extract_all(cell, F.lit(_TITLE), F.lit(1))
    notes = F.regexp_extract_all(cell, F.lit(_NOTE), F.lit(1))
    paired = let(
        notes,
        lambda ns: F.transform(
            titles,
            lambda t, i: F.struct(t.alias("title"), tx.or_empty(F.get(ns, i)).alias("notes")),
        ),
    )

    def block(b: Column) -> Column:
        title = F.nullif(F.regexp_extract(b, _BLOCK_TITLE, 1), F.lit(""))
        return F.struct(
            F.coalesce(title, b).alias("title"),
            F.regexp_extract(b, _BLOCK_NOTE, 1).alias("notes"),
        )

    pieces = F.transform(
        F.split(cell, rf"\}},{WS}*\{{"),
        lambda b: tx.trim_ws(F.regexp_replace(b, r"\A[\[{]|\}\]\z", "")),
    )
    blocks = F.transform(F.filter(pieces, lambda b: b != ""), block)
    return F.when(F.size(titles) > 0, paired).otherwise(blocks)


def parse_outcomes(cell: Column) -> Column:
    """Title / notes pairs of an outcome cell: JSON, nearly JSON, or just text."""
    none = F.expr(_NO_ITEMS)

    def parts(v: Column) -> Column:
        return F.transform(_items_of(v), _item_parts)

    def parsed(s: Column) -> Column:
        # The repaired text is parsed only where the text as it is was not JSON.
        return let(
            F.coalesce(vx.parse_json(s), vx.parse_json(repair_json(s))),
            lambda v: F.when(v.isNotNull(), parts(v)).otherwise(_found_by_pattern(s)),
        )

    return F.when(tx.or_empty(cell) == "", none).otherwise(let(tx.trim_ws(cell), parsed))


def compose_outcomes(items: Column) -> Column:
    """Clean title / notes pairs, drop the ones that say nothing, join by a blank line."""
    cleaned = F.transform(
        items,
        lambda x: F.struct(
            tx.strip_labels(x["title"]).alias("t"), tx.strip_labels(x["notes"]).alias("n")
        ),
    )
    lines = F.transform(
        cleaned,
        lambda x: F.when(
            (x["t"] != "") & (x["n"] != ""), F.concat(x["t"], F.lit(TITLE_DASH), x["n"])
        ).otherwise(F.concat(x["t"], x["n"])),
    )
    return F.array_join(F.filter(lines, lambda t: ~tx.is_garbage(t)), PARAGRAPH)


def outcomes_text(cell: Column) -> Column:
    """Readable text of a raw outcome cell."""
    return compose_outcomes(parse_outcomes(cell))


# Notes inside a cell that is not a JSON list - the first string
# of every list, or else everything between the brackets.
_FIRST_NOTE = rf'"additionalNote"{WS}*:{WS}*\[{WS}*"((?:[^"\\]++|\\[^\n\r\u2028\u2029])*+)"'
_BRACKETS = rf'"additionalNote"{WS}*:{WS}*\[([^\]]+)\]'
_PIECE = r'(?:[^",]++|"[^"]*+")'


def _between_commas(c: Column) -> Column:
    """Non-empty stretches between the commas that have an even number of quotes behind them.

    Quotes pair up from the end, so with an odd number the first one ends a stretch's
    quoted beginning.
    """
    quotes = F.length(F.regexp_replace(c, '[^"]++', ""))
    odd = F.regexp_extract_all(c, F.lit(rf'\A[^"]*+"{_PIECE}*+|{_PIECE}++'), F.lit(0))
    even = F.regexp_extract_all(c, F.lit(rf"{_PIECE}++"), F.lit(0))
    return F.when(quotes % 2 == 1, odd).otherwise(even)


def notes_text(cell: Column) -> Column:
    """All `additionalNote` texts of a raw outcome cell, joined."""
    s = tx.trim_ws(tx.or_empty(cell))

    def of_entry(entry: Column) -> Column:
        single = F.when(
            vx.is_text(vx.variant_at(entry, "$.additionalNote")),
            F.array(vx.text_at(entry, "$.additionalNote")),
        )
        return F.coalesce(
            F.transform(vx.array_at(entry, "$.additionalNote"), vx.scalar_text),
            single,
            F.expr("cast(array() as array<string>)"),
        )

    def non_empty(texts: Column) -> Column:
        return F.filter(F.transform(texts, tx.trim_ws), lambda t: t != "")

    def from_list(entries: Column) -> Column:
        return non_empty(F.flatten(F.transform(entries, of_entry)))

    def from_text(t: Column) -> Column:
        quoted = non_empty(
            F.transform(F.regexp_extract_all(t, F.lit(_FIRST_NOTE), F.lit(1)), tx.unescape_basic)
        )
        inner = F.regexp_extract_all(t, F.lit(_BRACKETS), F.lit(1))
        bare = F.transform(
            F.flatten(F.transform(inner, _between_commas)),
            lambda p: F.btrim(p, F.lit(WS_CHARS + "\"'")),
        )
        return let(
            quoted,
            lambda q: F.when(F.size(q) > 0, q).otherwise(F.filter(bare, lambda p: p != "")),
        )

    def read(t: Column) -> Column:
        entries = vx.array_at(vx.parse_json(t), "$")
        return let(
            entries,
            lambda es: F.when(es.isNotNull(), from_list(es)).otherwise(from_text(t)),
        )

    return F.when(s.isin("", "[]"), "").otherwise(
        F.array_join(let(s, read), NOTE_SEMICOLON)
    )
