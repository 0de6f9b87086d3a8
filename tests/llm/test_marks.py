"""Packed columns come back, and a bitmap of ids misses none."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpiloom.llm import marks, packing


@pytest.mark.parametrize("n", [0, 1, 2, 5000])
def test_packed_columns_come_back(n):
    draw = np.random.default_rng(n)
    key = np.sort(draw.integers(0, 1 << 64, n, dtype=np.uint64))
    near, far = draw.integers(-5, 100, n), draw.integers(-(1 << 63), (1 << 63) - 1, n)
    got = packing.unpacked(packing.packed(key.view(np.int64), near, far), 3)
    assert (got[0] == key).all()
    assert (got[1].view(np.int64) == near).all() and (got[2].view(np.int64) == far).all()


@pytest.mark.parametrize("most", [marks.MAX_BITS, 64])
def test_no_id_is_missed(spark, monkeypatch, most):
    monkeypatch.setattr(marks, "MAX_BITS", most)
    known = marks.marked(spark.range(0, 3000, 3))
    hit = {r["id"] for r in spark.range(3000).filter(known(F.col("id"))).collect()}
    assert set(range(0, 3000, 3)) <= hit
    assert len(hit) < 1300 if most > 64 else len(hit) == 3000
