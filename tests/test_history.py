"""As-of joins and versions kept up to date by load, against plain Python."""

import datetime
import random

from pyspark.sql import functions as F

from kpiloom.operators import dimensions, history
from kpiloom.sources import warehouse


def day(n):
    return datetime.date(2024, 1, 1) + datetime.timedelta(days=n)


def changes_of(spark, rows):
    return spark.createDataFrame([(k, day(d), v) for k, d, v in rows], "k bigint, valid_from date, v int")


def built(rows):
    """Versions by hand: the highest value of a key's day, runs of one value folded."""
    by_day = {}
    for k, d, v in rows:
        if (k, d) not in by_day or v > by_day[k, d]:
            by_day[k, d] = v
    out = []
    for k in sorted({k for k, _ in by_day}):
        starts = []
        for d in sorted(d for key, d in by_day if key == k):
            if not starts or by_day[k, d] != starts[-1][1]:
                starts.append((d, by_day[k, d]))
        for i, (d, v) in enumerate(starts):
            until = starts[i + 1][0] if i + 1 < len(starts) else None
            out.append((k, day(d), v, i + 1, until if until is None else day(until - 1), until is None))
    return out


def rows_of(df):
    return sorted(tuple(r) for r in df.select("k", "valid_from", "v", "version", "valid_to", "is_current").collect())


def test_loads_in_any_order_equal_one_build(spark, tmp_path):
    draw = random.Random(4)
    rows = [(draw.randrange(8), draw.randrange(40), draw.randrange(3)) for _ in range(300)]
    parts = [rows[:120], rows[120:121], [r for r in rows[121:] if r[0] < 2], [r for r in rows[121:] if r[0] >= 2]]
    path = str(tmp_path / "h")
    so_far = []
    for number, part in enumerate(parts, 1):
        history.record(spark, path, number, changes_of(spark, part), "k", "v")
        so_far += part
        assert sorted(built(so_far)) == rows_of(history.current(spark, path, "k"))
    # Only touched keys are written.
    stored = warehouse.read(spark, f"{path}/versions")
    assert [r["k"] for r in stored.filter("load_number = 2").select("k").distinct().collect()] == [rows[120][0]]
    # A load that runs again replaces itself.
    history.record(spark, path, 4, changes_of(spark, parts[3]), "k", "v")
    assert sorted(built(rows)) == rows_of(history.current(spark, path, "k"))
    out = str(tmp_path / "compact")
    history.compact(spark, path, "k", out)
    history.record(spark, out, 1, changes_of(spark, [(0, 50, 9), (99, 1, 1)]), "k", "v")
    assert sorted(built(rows + [(0, 50, 9), (99, 1, 1)])) == rows_of(history.current(spark, out, "k"))


def test_readers_of_a_broken_load_see_the_table_before_it(spark, tmp_path):
    """The driver is lost between observations and versions: the old versions stand, and the repeated
    load brings the new ones."""
    path = str(tmp_path / "h")
    history.record(spark, path, 1, changes_of(spark, [(1, 1, 5), (2, 1, 5)]), "k", "v")
    before = rows_of(history.current(spark, path, "k"))
    late = changes_of(spark, [(1, 3, 6)])
    warehouse.overwrite(late.select("k", "valid_from", "v"), f"{path}/observed/load_number=2")
    assert rows_of(history.current(spark, path, "k")) == before
    history.record(spark, path, 2, late, "k", "v")
    assert rows_of(history.current(spark, path, "k")) == sorted(built([(1, 1, 5), (2, 1, 5), (1, 3, 6)]))


def test_as_of_gives_the_version_of_the_day(spark):
    draw = random.Random(7)
    seen = [(draw.randrange(6), 5 + draw.randrange(60), draw.randrange(9)) for _ in range(120)]
    versions = dimensions.versions(changes_of(spark, seen).groupBy("k", "valid_from").agg(F.max("v").alias("v")), "k", "v")
    facts = [(i, draw.randrange(8), draw.randrange(80)) for i in range(500)]
    rows = [(i, k, day(d)) for i, k, d in facts] + [(900, None, day(9)), (901, 1, None), (0, facts[0][1], day(facts[0][2]))]
    df = spark.createDataFrame(rows, "id bigint, k bigint, on date")
    table = built(seen)

    def known(k, on):
        at = [v for key, start, v, *_ in table if k is not None and on is not None and key == k and start <= on]
        return at[-1] if at else None

    got = history.as_of(df, versions, "k", "on", ["v", "version"])
    assert got.columns == ["k", "on", "id", "v", "version"]
    want = sorted(((i, k, on, known(k, on)) for i, k, on in rows), key=repr)
    assert sorted(((r["id"], r["k"], r["on"], r["v"]) for r in got.collect()), key=repr) == want


def test_hot_key_is_reduced_to_its_days(spark):
    """A key with most of the facts is put in order by its days alone."""
    facts = spark.range(200_000).select(F.lit(1).cast("bigint").alias("k"), F.date_add(F.lit(day(0)), (F.col("id") % 30).cast("int")).alias("on"))
    versions = dimensions.versions(changes_of(spark, [(1, 0, 1), (1, 10, 2)]), "k", "v")
    joined = history.as_of(facts, versions, "k", "on", ["v"])
    counts = {r["v"]: r["n"] for r in joined.groupBy("v").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {1: sum(1 for i in range(200_000) if i % 30 < 10), 2: sum(1 for i in range(200_000) if i % 30 >= 10)}
    text = joined._jdf.queryExecution().executedPlan().toString()
    window = text[text.index("Window"):]
    assert "HashAggregate" in window and "Window" not in text[: text.index("Join")]


def test_nothing_known(spark):
    facts = spark.createDataFrame([(1, 1, day(1))], "id bigint, k bigint, on date")
    empty = dimensions.versions(changes_of(spark, []), "k", "v")
    assert [(r["id"], r["v"]) for r in history.as_of(facts, empty, "k", "on", ["v"]).collect()] == [(1, None)]
    assert history.as_of(facts.filter("false"), empty, "k", "on", ["v"]).count() == 0


def test_wide_load_sorts_its_keys_once(spark, tmp_path, monkeypatch):
    """A load of more keys than are broadcast: one sort and no join, with late days, null keys and null values."""
    monkeypatch.setattr(history, "BROADCAST_KEYS", 2)
    draw = random.Random(9)
    rows = [(draw.randrange(9), draw.randrange(12), draw.randrange(3)) for _ in range(90)]
    path, plans = str(tmp_path / "h"), []
    overwrite = warehouse.overwrite
    monkeypatch.setattr(warehouse, "overwrite", lambda df, to: (plans.append(df._jdf.queryExecution().executedPlan().toString()), overwrite(df, to)))
    history.record(spark, path, 1, changes_of(spark, rows[:60]), "k", "v")
    history.record(spark, path, 2, changes_of(spark, rows[60:]), "k", "v")
    wide = plans[-1]
    assert "Join" not in wide and wide.count("Sort [") == 1 and "HashAggregate" not in wide
    assert sorted(built(rows)) == rows_of(history.current(spark, path, "k"))
    odd = spark.createDataFrame([(None, day(1), 1), (20, day(1), None), (20, day(1), 4), (21, day(2), None), (22, day(3), 1)], "k bigint, valid_from date, v int")
    history.record(spark, path, 3, odd, "k", "v")
    got = [r[:3] for r in rows_of(history.current(spark, path, "k").filter("k >= 20 or k is null").withColumn("v", F.coalesce("v", F.lit(-1))))]
    assert got == [(20, day(1), 4), (21, day(2), -1), (22, day(3), 1)]
