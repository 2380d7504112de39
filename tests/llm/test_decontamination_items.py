"""Short benchmark items, and ids of any type."""

import datetime
import decimal

import pytest

from assayer.llm import decontaminate

DOCS = [(1, "the house by the river is the oldest one here"), (2, "The!"), (3, "the"), (4, "read more"), (5, "more read"), (6, None), (7, "one two three four five")]


def test_short_items_need_half_of_the_text(spark):
    docs = spark.createDataFrame([(*r, "x") for r in DOCS], "doc_id int, text string, item_id string")
    items = spark.createDataFrame([(1, "the"), (2, "read more"), (3, ""), (4, "two three four five")], "item_id int, text string")
    got = {tuple(r) for r in decontaminate.contaminations(docs, items).collect()}
    assert got == {(2, 1, 1.0, 1), (3, 1, 1.0, 1), (4, 2, 1.0, 1), (7, 4, 1.0, 1)}
    kept = {r["doc_id"] for r in decontaminate.clean_documents(docs, items).collect()}
    assert kept == {1, 5, 6}


@pytest.mark.parametrize(
    "kind, value",
    [("smallint", 7), ("decimal(9,2)", decimal.Decimal("7.50")), ("date", datetime.date(2020, 1, 2)), ("double", 7.5), ("binary", bytearray(b"7"))],
)
def test_item_ids_of_any_type(spark, kind, value):
    docs = spark.createDataFrame([(value, "one two three four five six seven")], f"doc_id {kind}, text string")
    items = spark.createDataFrame([(value, "zero one two three four five six")], f"item_id {kind}, text string")
    (row,) = decontaminate.contaminations(docs, items).collect()
    assert row["item_id"] == value and row["doc_id"] == value and row["coverage"] == pytest.approx(6 / 7)
