"""A Bloom filter of ids as a join, to leave most unwanted rows out before a shuffle.

The filter is a table of 64-bit words, each with the bits of the ids that hash there. Rows
are joined with it by word, as a broadcast, and kept if their bit is set: all rows of the
ids that it was made from, and about one in ``BITS`` of the others. An exact join must
follow; it only has less to move. ``BITS`` for each id are taken up to ``MOST_WORDS`` words
in all, which bounds the broadcast; with more ids, more others pass, and none is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaargraph.workspace import cut

BITS = 16  # for each id
MOST_WORDS = 1 << 20


class Bloom:
    def __init__(self, ids: DataFrame, column: str) -> None:
        """From a stored table of ids; its rows are counted first."""
        self.words = max(1, min(-(-ids.count() * BITS // 64), MOST_WORDS))
        word, bit = self._place(column)
        self.table = cut(
            ids.select(word.alias("_word"), bit.alias("_bit"))
            .groupBy("_word")
            .agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_mask")),
            "bloom",
        )

    def _place(self, column: str) -> tuple[Column, Column]:
        place = F.pmod(F.xxhash64(column), F.lit(64 * self.words))
        return F.floor(place / 64).cast("long"), (place % 64).cast("int")

    def only(self, df: DataFrame, column: str) -> DataFrame:
        """The rows of ``df`` whose id may be one of the filter's; a NULL id may be one if
        the filter has one."""
        word, bit = self._place(column)
        placed = df.withColumns({"_word": word, "_bit": bit})
        met = placed.join(F.broadcast(self.table), "_word")
        return met.where(F.getbit("_mask", "_bit") == 1).select(df.columns)
