"""Tolerant access to JSON of unknown shape, held as VARIANT."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.functions.text import let

# Fixed value: closes the array a text is wrapped in before parsing. The parser
# ignores what follows a complete value; if the mark is not found at index 1,
# the text was not exactly one JSON value.
_END = "\u241Eend"


def _wrapped(text: Column) -> Column:
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{_END}"]')))


def _unwrapped(w: Column) -> Column:
    is_whole = F.try_variant_get(w, "$[1]", "string") == _END
    return F.when(is_whole, F.try_variant_get(w, "$[0]", "variant"))


def parse_json(text: Column) -> Column:
    """VARIANT of exactly one JSON value, NULL for anything else."""
    return let(_wrapped(text), _unwrapped)


def with_json(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """Add column `out` with the parsed text; NULL marks a malformed text."""
    wrapped = f"__{out}_wrapped"
    return (
        df.withColumn(wrapped, _wrapped(F.col(text_col)))
        .withColumn(out, _unwrapped(F.col(wrapped)))
        .drop(wrapped)
    )


def keep_rows(df: DataFrame, condition: Column) -> DataFrame:
    """Filter on computed columns.

    The optimizer moves a plain filter below the projection that computes its
    inputs, which then are computed twice (a whole JSON parse, for instance).
    Here every row yields itself or nothing, after its columns are known.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.select(F.inline(F.when(condition, F.array(row))))


def kind(v: Column) -> Column:
    """STRING, BIGINT, BOOLEAN, VOID, ARRAY<..>, OBJECT<..>; NULL when absent."""
    return F.schema_of_variant(v)


def is_text(v: Column) -> Column:
    return F.coalesce(kind(v) == "STRING", F.lit(False))


def text_at(v: Column, path: str, default: str | None = None) -> Column:
    """Value at `path` as text (JSON text for an object or array)."""
    value = F.try_variant_get(v, path, "string")
    return value if default is None else F.coalesce(value, F.lit(default))


def variant_at(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def array_at(v: Column, path: str) -> Column:
    """Elements of the array at `path`; NULL when there is no array."""
    return F.try_variant_get(v, path, "array<variant>")


def elements_at(v: Column, path: str) -> Column:
    return F.coalesce(array_at(v, path), F.expr("cast(array() as array<variant>)"))


def filled(v: Column) -> Column:
    """Text of a value that counts as true, else NULL.

    Missing, null, "", false and 0 count as false; the texts "false" and "0" do not.
    """
    return let(
        text_at(v, "$"),
        lambda t: F.when(t == "", None)
        .when(t.isin("false", "0") & ~is_text(v), None)
        .otherwise(t),
    )


def filled_at(v: Column, path: str) -> Column:
    return filled(variant_at(v, path))


def plain(v: Column) -> Column:
    """As `filled`, for text composition: an array gives its scalars joined by a
    comma, an object gives NULL."""
    items = F.transform(elements_at(v, "$"), lambda x: F.coalesce(scalar_text(x), F.lit("")))
    return let(
        filled(v),
        lambda t: F.when(~t.rlike(r"^[\[{]") | is_text(v), t).when(
            kind(v).startswith("ARRAY"), F.nullif(F.array_join(items, ","), F.lit(""))
        ),
    )


def first_of(values: list[Column], read: Callable[[Column], Column]) -> Column:
    """First text that `read` finds in the values, else NULL."""
    return F.get(F.array_compact(F.transform(F.array(*values), read)), F.lit(0))


def first_at(v: Column, paths: list[str], read: Callable[[Column], Column] = filled) -> Column:
    return first_of([variant_at(v, p) for p in paths], read)


def scalar_text(v: Column) -> Column:
    """Text of a string, number or boolean; NULL for null, objects and arrays."""
    return F.when(~kind(v).rlike("^(?:ARRAY|OBJECT|VOID)"), F.try_variant_get(v, "$", "string"))


def json_at(body: Column, path: Column) -> Column:
    """JSON text at a path that is itself computed."""
    return F.call_function("get_json_object", body, path)


def first_filled(*options: Column) -> Column:
    return F.coalesce(*options, F.lit(""))


# Label keys by preference.
_ENGLISH = ["$.en", "$['en-GB']", "$['en-US']"]
_VALUE = ["$['@value']", "$.value"]


def _first_string_value(raw: Column) -> Column:
    """First value that is a string, in document order (a VARIANT sorts its keys)."""
    values = F.map_values(F.from_json(raw, "map<string,variant>"))
    return F.try_variant_get(F.get(F.filter(values, is_text), F.lit(0)), "$", "string")


def _array_label(v: Column) -> Column:
    items = array_at(v, "$")
    english = F.get(F.array_compact(F.transform(items, lambda x: first_at(x, _ENGLISH))), F.lit(0))
    first_string = F.nullif(
        F.try_variant_get(F.get(F.filter(items, is_text), F.lit(0)), "$", "string"), F.lit("")
    )
    valued = F.get(F.array_compact(F.transform(items, lambda x: first_at(x, _VALUE))), F.lit(0))
    return F.coalesce(english, first_string, valued, scalar_text(F.get(items, F.lit(0))))


def label_text(v: Column, raw: Column) -> Column:
    """One text for a label that may be a string, a list or a language map.

    English first, then `@value` / `value`, then the first string. `raw` is the
    label's own JSON text and is read only for the last case.
    """

    def by_kind(k: Column) -> Column:
        return (
            F.when(k == "STRING", F.try_variant_get(v, "$", "string"))
            .when(k.startswith("ARRAY"), _array_label(v))
            .when(
                k.startswith("OBJECT"),
                F.coalesce(first_at(v, _ENGLISH + _VALUE), _first_string_value(raw)),
            )
            .otherwise(scalar_text(v))
        )

    return let(kind(v), by_kind)
