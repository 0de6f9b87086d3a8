"""Quartiles and fences from sketches against exact ones."""

import datetime
import math
import random

from pyspark.sql import functions as F

from kpiloom.operators import quartiles

DAY = datetime.date(2024, 1, 1)


def deliveries(spark, rows):
    df = spark.createDataFrame(rows, "supplier_id bigint, day int, lead_time_days int")
    return df.withColumn("delivery_date", F.date_add(F.lit(DAY), F.col("day")))


def disc(values, at):
    values = sorted(values)
    return values[max(math.ceil(at * len(values)) - 1, 0)]


def drawn(seed, suppliers=3, days=50, most=4):
    draw = random.Random(seed)
    rows = [(s, d, draw.choice([None, *range(1, 20), 60])) for s in range(suppliers) for d in range(days) for _ in range(draw.randint(0, most))]
    return rows


def test_small_sketches_are_exact(spark):
    rows = drawn(1)
    found = quartiles.of_periods(quartiles.daily_sketches(deliveries(spark, rows)), F.lit("all"))
    for r in found.collect():
        leads = [lead for s, _, lead in rows if s == r["supplier_id"] and lead is not None]
        assert r["deliveries"] == len(leads) <= quartiles.K
        assert [r["q1"], r["median"], r["q3"]] == [disc(leads, at) for at in (0.25, 0.5, 0.75)]


def test_large_sketches_stay_within_the_bound(spark):
    """A million different values in 400 daily sketches of one supplier, merged."""
    df = spark.range(1_000_000).select(
        F.lit(1).cast("bigint").alias("supplier_id"),
        (F.col("id") % 400).cast("int").alias("day"),
        ((F.col("id") * 7919) % 1_000_003).cast("int").alias("lead_time_days"),
        F.date_add(F.lit(DAY), (F.col("id") % 400).cast("int")).alias("delivery_date"),
    )
    row = quartiles.of_periods(quartiles.daily_sketches(df), F.lit("all")).first()
    for name, at in quartiles.QUARTILES.items():
        assert abs(row[name] / 1_000_003 - at) < quartiles.BOUND
    checked = quartiles.check(df, F.lit("all")).first()
    assert checked["within_bound"] and checked["deliveries"] == 1_000_000


def test_check_finds_a_wrong_quartile(spark, monkeypatch):
    df = deliveries(spark, [(1, i % 30, i) for i in range(150)])
    assert quartiles.check(df, F.lit("all")).first()["within_bound"]
    monkeypatch.setitem(quartiles.QUARTILES, "q1", 0.25)
    wrong = quartiles._quartiles
    monkeypatch.setattr(quartiles, "_quartiles", lambda s: [wrong(s)[2].alias("q1"), *wrong(s)[1:]])
    assert not quartiles.check(df, F.lit("all")).first()["within_bound"]


def test_fences_equal_those_of_raw_rows(spark):
    rows = drawn(2, most=3)
    df = deliveries(spark, rows)
    by_day = quartiles.fences(quartiles.daily_sketches(df), 10)
    found = {(r["supplier_id"], r["date"]): r for r in by_day.collect()}
    days_of = {}
    for s, d, lead in rows:
        if lead is not None:
            days_of.setdefault((s, d), []).append(lead)
    assert len(found) == len(days_of)
    want = []
    for (s, d), leads in days_of.items():
        r = found[s, DAY + datetime.timedelta(days=d)]
        days = sorted(x for t, x in days_of if t == s and x < d)[-10:]
        base = [lead for x in days for lead in days_of[s, x]]
        assert r["based_on"] == len(base) and r["deliveries"] == len(leads)
        if len(base) < 4:
            assert r["low_fence"] is None and r["q1"] is None
            continue
        q1, q3 = disc(base, 0.25), disc(base, 0.75)
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        assert (r["q1"], r["q3"], r["low_fence"], r["high_fence"]) == (q1, q3, low, high)
        want += [(s, d, lead) for lead in leads if not low <= lead <= high]
    got = [(r["supplier_id"], r["day"], r["lead_time_days"]) for r in quartiles.outside(df, by_day).collect()]
    assert want and sorted(got) == sorted(want)


def test_no_deliveries(spark):
    none = deliveries(spark, [(1, 1, None)])
    assert quartiles.fences(quartiles.daily_sketches(none)).count() == 0
    assert quartiles.check(none, F.lit("all")).count() == 0
