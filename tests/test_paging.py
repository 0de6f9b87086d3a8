"""Pages by the last key of the page before."""

import random

import pytest

from kpiloom.operators import serving


@pytest.mark.parametrize("keys", [{"a": "asc", "b": "desc", "id": "asc"}, {"a": "desc", "b": "asc", "id": "desc"}])
def test_tokens_give_every_row_once_in_order(spark, keys):
    """Ties and nulls in the keys, pages that end within them."""
    draw = random.Random(2)
    rows = [(draw.choice([None, 1, 2, 3]), draw.choice([None, "x", "y"]), i) for i in range(97)]
    df = spark.createDataFrame(rows, "a int, b string, id int").repartition(5)
    place = {"a": 0, "b": 1, "id": 2}
    want = rows
    for name, direction in reversed(keys.items()):
        held = sorted((r for r in want if r[place[name]] is not None), key=lambda r: r[place[name]], reverse=direction == "desc")
        want = held + [r for r in want if r[place[name]] is None]
    got, last = [], None
    while True:
        page = serving.page_after(df, keys, last, 10)
        rows_of_page = [tuple(r) for r in page.collect()]
        if not rows_of_page:
            break
        assert len(rows_of_page) <= 10
        got += rows_of_page
        last = serving.last_keys(page, keys)
        assert tuple(last[name] for name in keys) == tuple(rows_of_page[-1][place[name]] for name in keys)
    assert got == want


def test_rows_before_the_token_are_filtered_below_the_sort(spark, tmp_path):
    path = str(tmp_path / "mart")
    spark.range(1000).selectExpr("id", "id * 2 as v").write.parquet(path)
    page = serving.page_after(spark.read.parquet(path), {"id": "desc"}, {"id": 500}, 100)
    text = page._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in text and text.index("TakeOrdered") < text.index("Filter") < text.index("Scan")
    # Of a key that may be null, both branches go down to the scan.
    assert "PushedFilters: [Or(" in text or "LessThan(id,500)" in text
    assert [r["id"] for r in page.collect()] == list(range(499, 399, -1))


def test_bad_directions_and_empty_tables(spark):
    empty = spark.createDataFrame([], "id int")
    assert serving.last_keys(serving.page_after(empty, {"id": "asc"}), {"id": "asc"}) is None
    with pytest.raises(ValueError):
        serving.page_after(empty, {"id": "up"})
