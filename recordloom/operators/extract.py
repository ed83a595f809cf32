"""From parsed JSON records to flat columns."""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from recordloom.constants import NOTE_PIPE
from recordloom.functions import outcomes as ox
from recordloom.functions import text as tx
from recordloom.functions import variants as vx

# Below this, any JSON text fits one VARIANT value.
VARIANT_BYTES = 16 << 20

# --- countries --------------------------------------------------------------


def _first_address_label(locations: Column) -> Column:
    addresses = F.flatten(F.transform(locations, lambda loc: vx.elements_at(loc, "$.address")))
    labels = F.transform(addresses, lambda a: vx.filled_at(a, "$.countryCode.prefLabel"))
    return F.get(F.filter(labels, lambda t: t.isNotNull()), F.lit(0))


def provider_country(doc: Column) -> Column:
    """First country of any provider address, else of any publisher address, else ''."""
    provider_locations = F.flatten(
        F.transform(
            vx.elements_at(doc, "$.providedBy"), lambda p: vx.elements_at(p, "$.location")
        )
    )
    return vx.first_filled(
        _first_address_label(provider_locations),
        _first_address_label(vx.elements_at(doc, "$.publisher.location")),
    )


def publisher_country(doc: Column) -> Column:
    return vx.first_filled(
        vx.filled_at(doc, "$.publisher.location[0].address[0].countryCode.prefLabel")
    )


def _label_search() -> Callable[[Column], Column]:
    """Column function: the JSON texts of all `countryCode.prefLabel` of a record, in document order.

    A record may nest to any depth, which no column expression follows without reading it once a
    level; here it is parsed once and walked once, a whole Arrow batch at a time. The functions
    are nested so that they travel by value: executors need not have this package.
    """

    def texts(body: str | None) -> list[str]:
        # The raw text may spell the key with escapes.
        if body is None or ("countryCode" not in body and "\\u" not in body):
            return []
        try:
            nodes = [json.loads(body)]
        except (ValueError, RecursionError):
            return []
        found = []
        while nodes:
            node = nodes.pop()
            if isinstance(node, dict):
                code = node.get("countryCode")
                if isinstance(code, dict) and code.get("prefLabel") is not None:
                    text = json.dumps(code["prefLabel"], ensure_ascii=False)
                    found.append(text.encode("utf-8", "replace").decode())
                children = list(node.values())
            else:
                children = node if isinstance(node, list) else []
            nodes += [c for c in reversed(children) if isinstance(c, dict | list)]
        return found

    def search(bodies: pd.Series) -> pd.Series:
        return bodies.map(texts)

    return F.pandas_udf(search, "array<string>")


def country_labels(body: Column) -> Column:
    """JSON texts of all country labels of a record; see `deep_country`."""
    return _label_search()(body)


def first_label(labels: Column) -> Column:
    def named_by(t: Column) -> Column:
        return tx.let(vx.parse_json(t), lambda v: F.nullif(vx.label_text(v, t), F.lit("")))

    named = F.transform(labels, named_by)
    return F.get(F.filter(named, lambda t: t.isNotNull()), F.lit(0))


def deep_country(body: Column) -> Column:
    """First country label anywhere in the record, in document order; NULL for what is no record.

    An object's own label comes before those of its parts; an empty label counts as none. Where
    other fields come from the parsed record, take `country_labels` before parsing: next to
    a UDF, the optimizer would parse the record again for every field.
    """
    return first_label(country_labels(body))


# --- other fields -----------------------------------------------------------


def lo_level(doc: Column) -> Column:
    return vx.first_filled(
        vx.filled_at(doc, "$.learningAchievementSpecification.EQFLevel.prefLabel"),
        vx.filled_at(doc, "$.EQFLevel.prefLabel"),
    )


def qual_level(doc: Column) -> Column:
    return vx.first_filled(vx.filled_at(doc, "$.EQFLevel.prefLabel"))


def multilingual_level(doc: Column, body: Column) -> Column:
    label = vx.label_text(
        vx.variant_at(doc, "$.EQFLevel.prefLabel"),
        F.get_json_object(body, "$.EQFLevel.prefLabel"),
    )
    return tx.or_empty(label)


def lo_summary(doc: Column) -> Column:
    path = "$.learningAchievementSpecification.learningOutcomeSummary.noteLiteral"
    literal = vx.variant_at(doc, path)
    return F.when(vx.is_text(literal), tx.trim_ws(vx.text_at(doc, path))).otherwise("")


def qual_summary(doc: Column) -> Column:
    return vx.first_filled(vx.filled_at(doc, "$.learningOutcomeSummary.noteLiteral"))


def entry_requirement(doc: Column) -> Column:
    return vx.first_filled(vx.filled_at(doc, "$.entryRequirement.noteLiteral"))


def record_uri(doc: Column) -> Column:
    return vx.first_filled(
        vx.filled_at(doc, "$.uri"), vx.filled_at(doc, "$['@id']"), vx.filled_at(doc, "$.id")
    )


# Id-like keys of a list item, by preference.
ID_KEYS = ["id", "uuid", "identifier", "escoIdentifier", "uri"]


def item_id(item: Column) -> Column:
    """First id-like value that is present, even if empty."""
    return F.coalesce(*[vx.text_at(item, f"$.{k}") for k in ID_KEYS])


def item_key(item: Column) -> Column:
    """The item's id for telling repeats; NULL where the id is empty, 0 or false."""
    ids = [vx.variant_at(item, f"$.{k}") for k in ID_KEYS]
    return vx.filled(F.coalesce(*[F.when(~F.is_variant_null(v), v) for v in ids]))


# --- result pages -----------------------------------------------------------


def envelope_items(page: Column, payload: Column) -> Column:
    """Item list of a result page: a known location, else the first list of objects."""
    known = ("$.items", "$.results", "$.hits.hits", "$.data.items", "$.data.results", "$")

    def holds_objects(v: Column) -> Column:
        return vx.kind(F.try_variant_get(v, "$[0]", "variant")).rlike("^(?:ARRAY|OBJECT|VOID)")

    values = F.map_values(F.from_json(payload, "map<string,variant>"))
    lists = F.filter(values, lambda v: vx.array_at(v, "$").isNotNull() & holds_objects(v))
    return F.coalesce(
        *[vx.array_at(page, path) for path in known],
        vx.array_at(F.get(lists, F.lit(0)), "$"),
        F.expr("cast(array() as array<variant>)"),
    )


def unnest_items(
    pages: DataFrame, payload: str = "payload", courses_only: bool = False
) -> DataFrame:
    """One row per list item: the page's other columns, `pos`, `item` (VARIANT).

    With `courses_only` a page counts only if it has a `courses` list.
    """
    parsed = vx.with_json(pages, payload, "__page")
    page = F.col("__page")
    items = vx.array_at(page, "$.courses") if courses_only else envelope_items(page, F.col(payload))
    kept = [c for c in pages.columns if c != payload]
    return parsed.select(*kept, F.posexplode(items).alias("pos", "item"))


def page_facts(
    pages: DataFrame, payload: str = "payload", courses_only: bool = True
) -> DataFrame:
    """Per page: is it readable, how many items, its own and the last page number.

    The items are those that `unnest_items` gives. Without `courses_only` a page is
    readable if it is JSON, and one without any item list is an empty page.
    """

    def whole(path: str) -> Column:
        number = F.when(
            vx.kind(vx.variant_at(F.col("__page"), path)).rlike("^(?:BIGINT|DECIMAL|DOUBLE)"),
            F.try_variant_get("__page", path, "double"),
        )
        return F.when(number == F.floor(number), number.cast("bigint"))

    parsed = vx.with_json(pages, payload, "__page")
    page = F.col("__page")
    if courses_only:
        courses = vx.array_at(page, "$.courses")
        readable = courses.isNotNull()
    else:
        courses = envelope_items(page, F.col(payload))
        readable = page.isNotNull()
    kept = [c for c in pages.columns if c != payload]
    return parsed.select(
        *kept,
        readable.alias("readable"),
        F.coalesce(F.size(courses), F.lit(0)).cast("bigint").alias("n_items"),
        whole("$.paginationInfos.currentPageNumber").alias("page_number"),
        whole("$.paginationInfos.totalPageCount").alias("page_count"),
    )


# --- whole records ----------------------------------------------------------


def _is_record() -> Column:
    return F.col("__doc").isNotNull() & ~F.is_variant_null("__doc")


def _rows(docs: DataFrame, body: str, watch: Observation | None, *columns: Column) -> DataFrame:
    """Columns of every well-formed document; `watch` counts those `read` and those `dead`."""
    parsed = vx.with_json(docs, body, "__doc")
    if watch is not None:
        dead = F.count_if(~_is_record()).alias("dead")
        parsed = parsed.observe(watch, F.count(F.lit(1)).alias("read"), dead)
    valid = _is_record().alias("__valid")
    return vx.keep_rows(parsed.select(*columns, valid), F.col("__valid")).drop("__valid")


def _cell(items: Column, as_json: bool) -> Column:
    return F.to_json(items) if as_json else items


def malformed(docs: DataFrame, body: str = "body") -> DataFrame:
    """Records whose body is not JSON, or is just `null`; the complement of the extracts."""
    return vx.keep_rows(vx.with_json(docs, body, "__doc"), ~_is_record()).drop("__doc")


def dead_reason(body: Column) -> Column:
    """Why a body is no record: `too large` for well-formed JSON beyond one VARIANT, else `bad json`."""
    parsed = F.from_json(body, "__none string, __bad string", {"columnNameOfCorruptRecord": "__bad"})
    large = F.octet_length(body) > VARIANT_BYTES
    return F.when(large & parsed["__bad"].isNull(), "too large").otherwise("bad json")


def lo_records(
    docs: DataFrame,
    body: str = "body",
    file: str = "file",
    outcomes_as_json: bool = True,
    watch: Observation | None = None,
) -> DataFrame:
    """Learning-opportunity documents to flat rows.

    The outcome list is JSON text as in the CSV form, or stays an array.
    """
    d = F.col("__doc")
    return _rows(
        docs,
        body,
        watch,
        F.col(file).alias("file"),
        vx.text_at(d, "$.title", "").alias("title"),
        provider_country(d).alias("countryCode.prefLabel"),
        lo_level(d).alias("EQFLevel.prefLabel"),
        lo_summary(d).alias("learningOutcomeSummary.noteLiteral"),
        _cell(ox.lo_outcomes(d), outcomes_as_json).alias("learningOutcome"),
    )


def qual_records(
    docs: DataFrame,
    body: str = "body",
    file: str = "file",
    with_entry: bool = False,
    outcomes_as_json: bool = True,
    watch: Observation | None = None,
) -> DataFrame:
    """Qualification documents to flat rows; `entryRequirement` on request."""
    d = F.col("__doc")
    entry = [entry_requirement(d).alias("entryRequirement")] if with_entry else []
    return _rows(
        docs,
        body,
        watch,
        vx.first_filled(vx.filled_at(d, "$.title")).alias("qualificationName"),
        publisher_country(d).alias("country"),
        qual_level(d).alias("qualificationLevel"),
        qual_summary(d).alias("description"),
        _cell(ox.qual_outcomes(d), outcomes_as_json).alias("learningOutcomes"),
        *entry,
        F.col(file).alias("sourceFile"),
    )


def multilingual_records(
    docs: DataFrame,
    body: str = "body",
    folder: str = "country",
    require_outcome: bool = True,
    watch: Observation | None = None,
) -> DataFrame:
    """Multilingual qualification documents to flat rows.

    The folder names the country where the record does not.
    """
    d = F.col("__doc")
    raw = F.col(body)
    flat = _rows(
        docs.withColumn("__labels", country_labels(raw)),
        body,
        watch,
        vx.text_at(d, "$.title", "").alias("title"),
        F.coalesce(first_label(F.col("__labels")), F.col(folder)).alias("country"),
        multilingual_level(d, raw).alias("qualificationLevel"),
        vx.text_at(d, "$.description", "").alias("description"),
        ox.note_texts(d, raw).alias("notes"),
        record_uri(d).alias("uri"),
    )
    if require_outcome:
        flat = vx.keep_rows(flat, F.size("notes") > 0)
    return flat.select(
        "title",
        "country",
        "qualificationLevel",
        tx.first_number(F.col("qualificationLevel")).alias("qualificationLevelNum"),
        "description",
        F.array_join("notes", NOTE_PIPE).alias("learningOutcome"),
        "uri",
    )
