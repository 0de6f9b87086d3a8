"""A bitmap of ids, to keep rows that surely have no partner out of a shuffle.

It has some bits for each id up to a fixed size, so what is collected and broadcast is bounded whatever the
number of ids. An id that is in the table is always marked; a few others are too, so the rows that pass
still have to be joined. Far more ids than bits mark nearly everything: the join is then as if there were
no bitmap.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the bitmap for each id, and at most: 16 MB.
ID_BITS, MAX_BITS = 16, 1 << 27


def _place(ids: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(ids.cast("bigint")), F.lit(bits))


def bitmap(ids: DataFrame, like: int = 0):
    """A function that gives the place of a column of ids, and the broadcast words in which to look for it
    with ``found``. ``ids`` is one column, a written table: it is read twice. The bitmap is sized for
    ``like`` ids at least."""
    bits = min(max(1 << (ID_BITS * max(ids.count(), like)).bit_length(), 64), MAX_BITS)
    place = ids.select(_place(F.col(ids.columns[0]), bits).alias("at"))
    word = F.shiftright("at", 6).alias("word")
    bit = F.expr("shiftleft(1L, cast(at & 63 as int))")
    marks = place.groupBy(word).agg(F.bit_or(bit).alias("bits")).toArrow()
    words = np.zeros(bits >> 6, np.int64)
    words[marks["word"].to_numpy()] = marks["bits"].to_numpy()
    return lambda column: _place(column, bits), ids.sparkSession.sparkContext.broadcast(words.view(np.uint64))


def found(words: np.ndarray, at: pa.Array) -> np.ndarray:
    """Whether each place is marked."""
    place = at.to_numpy(zero_copy_only=False)
    return words[place >> 6] >> (place & 63).astype(np.uint64) & np.uint64(1) == 1


def marked(ids: DataFrame):
    """A function that tells of a column of ids whether each may be in ``ids`` (see ``bitmap``)."""
    place, words = bitmap(ids)

    @F.arrow_udf("boolean")
    def known(at: pa.Array) -> pa.Array:
        return pa.array(found(words.value, at))

    return lambda column: known(place(column))
