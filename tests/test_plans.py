"""The plans of the main jobs have the shape they should have at scale."""

from __future__ import annotations

import re

import pytest
from conftest import SF_DIR

import __spark_entry__ as entry_module
from recordloom.plans import catalogue

QUERIES = {k: v for k, v in entry_module.queries().items() if k in catalogue.QUERIES}


def plans(spark, name):
    execution = QUERIES[name](spark, SF_DIR)._jdf.queryExecution()
    return execution.optimizedPlan().toString(), execution.executedPlan().toString()


@pytest.mark.parametrize("name", ["qual_dataset", "lo_dataset", "multilingual_records"])
def test_a_record_is_parsed_once(spark, name):
    optimized, _ = plans(spark, name)
    # Country labels, short texts of their own, are parsed too: as variables of a lambda.
    assert len(re.findall(r"VariantExpressionEvalUtils\.parseJson\(concat\(\[, (?!lambda)", optimized)) == 1
    assert len(re.findall(r"parseJson\(concat\(\[, lambda", optimized)) <= 1


@pytest.mark.parametrize("name", ["html_strip", "qual_dataset", "lo_dataset", "outcome_text", "cleaned_rows"])
def test_row_work_has_no_python_and_no_key_shuffle(spark, name):
    _, physical = plans(spark, name)
    assert "Python" not in physical
    if name != "cleaned_rows":
        assert "hashpartitioning" not in physical


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(("stream", "json_document"))])
def test_no_cross_joins(spark, name):
    _, physical = plans(spark, name)
    assert "CartesianProduct" not in physical


def test_scans_read_what_is_needed(spark):
    _, physical = plans(spark, "crawl_counters")
    schema = re.search(r"ReadSchema: struct<([^>]*)>", physical).group(1)
    assert "props" not in schema and "value" not in schema
    _, physical = plans(spark, "detail_manifest")
    assert "lang" not in re.search(r"ReadSchema: struct<([^>]*)>", physical).group(1)


def test_filters_reach_the_scan(spark):
    _, physical = plans(spark, "allow_list")
    assert "EqualTo(r_name,EUROPE)" in physical
