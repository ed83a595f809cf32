"""Text columns: trimming, HTML, enumeration markers, labels, boilerplate.

Every function takes a Column and returns a Column built from JVM-side
expressions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordloom.constants import (
    ENTITIES,
    FILLER_PHRASES,
    WS,
    WS_BODY,
    WS_CHARS,
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it several times in `body`."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def replace_where(c: Column, mark: str, pattern: str, replacement: str) -> Column:
    """`regexp_replace` only where `mark`, which every match contains, occurs at all."""
    return let(
        c,
        lambda t: F.when(t.contains(mark), F.regexp_replace(t, pattern, replacement)).otherwise(t),
    )


def trim_ws(c: Column) -> Column:
    """Trim every white-space character, not only U+0020."""
    return F.btrim(c, F.lit(WS_CHARS))


# Characters that are no white space, control or brace; tested first, because the
# full classes are many ranges long and most characters are letters.
_PLAIN = r"(?![!-z|~\xA1-\u167F])"
_WS_RUN = rf"{_PLAIN}(?: (?={WS})|(?! ){WS}){WS}*+"


def collapse_ws(c: Column) -> Column:
    """Every run of white space to one space; a lone space needs no change."""
    return F.trim(F.regexp_replace(c, _WS_RUN, " "))


# --- level numbers -------------------------------------------------------


def first_number(c: Column) -> Column:
    return or_empty(F.regexp_extract(c, r"(\d+(?:\.\d+)?)", 1))


def first_integer(c: Column) -> Column:
    return or_empty(F.regexp_extract(c, r"(\d+)", 1))


def level_number(c: Column) -> Column:
    """The digits of "Level N"; the word must not continue another ASCII word."""
    return or_empty(F.regexp_extract(c, rf"(?i)(?<![A-Za-z0-9_])Level{WS}*(\d+)", 1))


# --- markup --------------------------------------------------------------


def decode_entities(c: Column) -> Column:
    def decode(text: Column) -> Column:
        decoded = text
        for entity, char in ENTITIES:
            decoded = F.replace(decoded, F.lit(entity), F.lit(char))
        return F.when(text.contains("&"), decoded).otherwise(text)

    return let(c, decode)


# An opening brace takes the word after it along; braces, control characters,
# U+FFFD and white space all become the same single space. The quantifiers are
# possessive, so long runs need no regex stack. A lone space is left alone: it is
# its own replacement, and by far the most frequent run.
_NOISE_BODY = rf"}}\x00-\x1F\x7F\uFFFD{WS_BODY}"
_BRACE_WORD = rf"\{{{WS}*+[A-Za-z0-9_-]*+"
_NOISE_RUN = (
    rf"{_PLAIN}(?: {_PLAIN}(?=[{{{_NOISE_BODY}])|(?! )[{_NOISE_BODY}]|{_BRACE_WORD})"
    rf"(?:{_PLAIN}[{_NOISE_BODY}]|{_BRACE_WORD})*+"
)


def strip_html(c: Column) -> Column:
    """Tags, entities, brace blocks, control characters -> plain text.

    Tags that only appear after entity decoding stay.
    """
    # A tag that is never closed is taken as one match and put back, so that the text
    # behind it is not searched again from each further `<`.
    untagged = replace_where(c, "<", r"<[^>]*+>|(<[^>]*+\z)", "$1 ")
    return or_empty(F.trim(F.regexp_replace(decode_entities(untagged), _NOISE_RUN, " ")))


# --- markers and labels --------------------------------------------------


# A line starts after any ECMAScript line terminator, also between CR and LF;
# Java's own `^` knows one terminator more (U+0085) and skips the CR LF case.
_ENUMERATION = rf"(?m)(?:^(?<!\u0085)|\n(?<=\r\n)){WS}*\d+[).]{WS}+"


def strip_enumeration(c: Column) -> Column:
    """Remove "1) " or "2. " at line starts, with blank lines before it."""
    return F.regexp_replace(c, _ENUMERATION, "")


# Labels dropped at the start of a text or line, then anywhere.
_LINE_LABELS = "Title|Titles|Learning Outcome|LearningOutcome|Notes|Note"
_INLINE_LABELS = "Title|Notes|Note|Learning Outcome|LearningOutcome"
_LINE_LABEL = rf"{WS}*(?i:{_LINE_LABELS}){WS}*[:\-\u2014]{WS}*"
_INLINE_LABEL = rf"(?=[TtNnLl])(?<![A-Za-z0-9_])(?i:{_INLINE_LABELS}){WS}*:{WS}*"


def strip_labels(c: Column) -> Column:
    """Remove "Title:", "Notes -" and the like, then strip HTML."""
    c = F.replace(c, F.lit("\uFFFD"), F.lit(" "))
    c = F.regexp_replace(c, rf"\A{_LINE_LABEL}", "")
    c = replace_where(c, "\n", rf"\n{_LINE_LABEL}", "\n")
    c = replace_where(c, ":", _INLINE_LABEL, "")
    return strip_html(c)


BULLET = r"(?md)^[ \t]*(?:\d+[.)][ \t]+|[a-z][.)][ \t]+|\([a-z]\)[ \t]+|[-\u2022][ \t]*)"


def strip_bullets(c: Column) -> Column:
    return F.regexp_replace(c, BULLET, "")


# --- boilerplate with audit ----------------------------------------------


def phrase_pattern(phrases: list[str]) -> str:
    """Any-case alternation, longest phrase first, tried only at a first letter."""
    ordered = sorted(phrases, key=len, reverse=True)
    escaped = [p.replace("(", r"\(").replace(")", r"\)") for p in ordered]
    letters = "".join(sorted({p[0].lower() + p[0].upper() for p in phrases}))
    return f"(?=[{letters}])(?i:{'|'.join(escaped)})"


FILLER = phrase_pattern(FILLER_PHRASES)
CONTACT = (
    r"(?md)^[ \t]*(?:[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
    r"|\+?[0-9][0-9 ()./-]{5,}[0-9])[ \t]*$"
)


def find_all(c: Column, pattern: str) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(0))


def strip_filler(c: Column) -> Column:
    """Remove the filler phrases; a text of nothing else becomes empty."""
    return let(
        F.regexp_replace(c, FILLER, ""),
        lambda left: F.when((left != c) & (trim_ws(left) == ""), "").otherwise(left),
    )


def removed_filler(c: Column) -> Column:
    return find_all(c, FILLER)


def strip_contacts(c: Column) -> Column:
    """Remove lines holding only a phone number or an e-mail address."""
    return F.regexp_replace(c, CONTACT, "")


def removed_contacts(c: Column) -> Column:
    return find_all(c, CONTACT)


def removed_bullets(c: Column) -> Column:
    return find_all(c, BULLET)


# --- predicates ----------------------------------------------------------


# A bare number, "n/a" forms, dashes, or punctuation only.
_SAYS_NOTHING = (
    rf"\A(?:\d+\.?|(?i:n{WS}*/{WS}*a|na(?:{WS}+na)?|n{WS}*a|none)|[-\u2013\u2014]+"
    rf"|[\p{{P}}\p{{S}}{WS_BODY}]+)\z"
)


def is_garbage(c: Column) -> Column:
    """Text that says nothing: too short, a bare number, n/a forms, punctuation."""

    def test(t: Column) -> Column:
        # Length counts UTF-16 units, so one character beyond the BMP counts twice.
        short = (F.length(t) == 2) & ~t.rlike(r"[\x{10000}-\x{10FFFF}]")
        return (F.length(t) < 2) | short | t.rlike(_SAYS_NOTHING)

    return let(trim_ws(or_empty(c)), test)


def is_filled(c: Column, null_words: tuple[str, ...] = ()) -> Column:
    """Not null, not blank, not "[]" and none of `null_words` in any case."""
    t = trim_ws(or_empty(c))
    filled = ~t.isin("", "[]")
    if null_words:
        filled = filled & ~F.lower(t).isin(*null_words)
    return filled


# --- small helpers -------------------------------------------------------


def excerpt(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def unescape_basic(c: Column) -> Column:
    c = F.replace(c, F.lit('\\"'), F.lit('"'))
    return F.replace(c, F.lit("\\\\"), F.lit("\\"))


def safe_key(c: Column) -> Column:
    return F.regexp_replace(c, r"[^A-Za-z0-9_.-]", "_")


def last_path_segment(uri: Column) -> Column:
    """Last non-empty segment of the URI's path; of the text if it has no scheme."""
    path = F.regexp_extract(uri, r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/?#]*)?([^?#]*)", 1)
    in_path = F.replace(F.regexp_extract(path, r"([^/]+)/*$", 1), F.lit(" "), F.lit("%20"))
    in_text = F.regexp_extract(uri, r"([^/]+)/?$", 1)
    has_scheme = uri.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:")
    return F.nullif(F.when(has_scheme, in_path).otherwise(in_text), F.lit(""))


def last_slash_part(url: Column) -> Column:
    """Text after the last slash, trailing slashes dropped, query kept."""
    trimmed = F.regexp_replace(url, r"/+$", "")
    return F.nullif(F.substring_index(trimmed, "/", -1), F.lit(""))
