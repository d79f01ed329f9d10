"""A Bloom filter of a column's values, of fixed size whatever their number.

Built by Spark as bit sets (partial aggregation per task), at most ``bits / 64``
numbers come to the driver and become one literal of the plan. A row that is
not among the values mostly fails the test, one that is always passes, so a
join behind it decides.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 20


def _places(value: Column, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(value, F.lit(i)), F.lit(bits)) for i in range(hashes)]


def bloom_filter(values: DataFrame, column: str, bits: int = BITS, hashes: int = 1) -> Callable[[Column], Column]:
    """The test whether a column of the same type may be among ``column`` of ``values``; false for NULL."""
    if bits % 64 or bits <= 0:
        raise ValueError("bits must be a positive multiple of 64")
    place = F.explode(F.array(*_places(F.col(column), bits, hashes))).alias("_p")
    words = (values.where(F.col(column).isNotNull()).select(place)
             .groupBy(F.shiftright("_p", 6).alias("at"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(_p & 63 as int))")).alias("word")))
    held = [0] * (bits // 64)
    for r in words.collect():
        held[r["at"]] = r["word"]
    literal = F.from_json(F.lit(json.dumps(held)), "array<bigint>")  # folded when planned

    def test(value: Column) -> Column:
        found = value.isNotNull()
        for p in _places(value, bits, hashes):
            word = literal[F.shiftright(p, 6).cast("int")]
            weight = F.call_function("shiftleft", F.lit(1).cast("bigint"), p.bitwiseAND(F.lit(63)).cast("int"))
            found = found & (word.bitwiseAND(weight) != 0)
        return found

    return test
