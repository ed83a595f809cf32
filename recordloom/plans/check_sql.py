"""SQL fragments (DuckDB) for the checking queries, one step per rule."""

from __future__ import annotations

from recordloom.constants import ENTITIES, FILLER_PHRASES

_BODY = (
    r"\t\n\x{0B}\f\r \x{00A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"
)
WS = f"[{_BODY}]"
NL = "chr(10)"


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sub(x: str, pattern: str, replacement: str) -> str:
    return f"regexp_replace({x}, {quoted(pattern)}, {quoted(replacement)}, 'g')"


def trim(x: str) -> str:
    return sub(x, f"^{WS}+|{WS}+$", "")


def collapse(x: str) -> str:
    return trim(sub(x, f"{WS}+", " "))


def entities(x: str) -> str:
    for entity, char in ENTITIES:
        x = f"replace({x}, {quoted(entity)}, {quoted(char)})"
    return x


def strip_html(x: str) -> str:
    x = entities(sub(x, "<[^>]*>", " "))
    x = sub(x, rf"\{{{WS}*[A-Za-z0-9_-]*{WS}*", " ")
    x = sub(x, r"[{}]", " ")
    x = sub(x, r"[\x00-\x1F\x7F]", " ")
    x = sub(x, r"\x{FFFD}", " ")
    return f"coalesce({collapse(x)}, '')"


def strip_labels(x: str) -> str:
    x = sub(x, r"\x{FFFD}", " ")
    x = sub(
        x,
        rf"(?i)(^|\n){WS}*(Title|Titles|Learning Outcome|LearningOutcome|Notes|Note)"
        rf"{WS}*[:\-\x{{2014}}]{WS}*",
        r"\1",
    )
    x = sub(x, rf"(?i)\b(Title|Notes|Note|Learning Outcome|LearningOutcome){WS}*:{WS}*", "")
    return strip_html(x)


def strip_enumeration(x: str) -> str:
    return sub(x, rf"(?m)^{WS}*\d+[).]{WS}+", "")


BULLET = (
    r"(?m)^[ \t]*(?:\d+[.)][ \t]+|[a-z][.)][ \t]+|\([a-z]\)[ \t]+|[\-\x{2022}][ \t]*)"
)
CONTACT = (
    r"(?m)^[ \t]*(?:[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"
    r"|\+?[0-9][0-9 ()./\-]{5,}[0-9])[ \t]*$"
)
FILLER = "(?i)" + "|".join(
    p.replace("(", r"\(").replace(")", r"\)") for p in sorted(FILLER_PHRASES, key=lambda p: -len(p))
)


def find_all(x: str, pattern: str) -> str:
    return f"regexp_extract_all({x}, {quoted(pattern)})"


def strip_filler(x: str) -> str:
    left = sub(x, FILLER, "")
    return f"CASE WHEN {left} <> {x} AND {trim(left)} = '' THEN '' ELSE {left} END"


def is_garbage(x: str) -> str:
    t = trim(x)
    na = rf"(?i)^(?:n{WS}*/{WS}*a|na(?:{WS}+na)?|n{WS}*a|none|[\-\x{{2013}}\x{{2014}}]+)$"
    punctuation = rf"^[\p{{P}}\p{{S}}{_BODY}]+$"
    return (
        f"(length({t}) < 3 OR regexp_matches({t}, '^\\d+\\.$') OR regexp_matches({t}, '^\\d+$')"
        f" OR regexp_matches({t}, {quoted(na)}) OR regexp_matches({t}, {quoted(punctuation)}))"
    )


def is_filled(x: str, null_word: bool = False) -> str:
    t = f"coalesce({trim(x)}, '')"
    more = f" AND lower({t}) <> 'null'" if null_word else ""
    return f"({t} NOT IN ('', '[]'){more})"


# Lines of every document: doc_id, lang, source, i (from 0), x.
LINES = f"""
  SELECT doc_id, lang, source, text, generate_subscripts(ls, 1) - 1 AS i, unnest(ls) AS x
  FROM (SELECT *, list_filter(string_split(text, {NL}), lambda s: s <> '') AS ls FROM documents)
"""
