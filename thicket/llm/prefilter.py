"""A fixed-size map of ids that keeps long texts out of shuffles.

Before a join of long texts with a list of ids, the rows whose id cannot be in
the list are told apart without a shuffle: the ids set bits in a table of at
most ``SLOTS`` rows of 64 bits, which is broadcast.  Its size is bounded
whatever the length of the list; a list too long for it lets more rows pass,
and the join that follows decides, so no result depends on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of the map: 16.8 million bits, about 12 MB in memory.
SLOTS = 1 << 18
_SLOT, _BIT, _BITS = "__map_slot", "__map_bit", "__map_bits"


def split_listed(docs: DataFrame, ids: DataFrame, column: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(rows of docs that may be in ids, rows that cannot be); both have the columns of docs.

    Every row whose id is in ids(column) is in the first part.  A null id may
    be in either.  An empty list puts all rows in the second part.
    """
    slot = F.pmod(F.xxhash64(column), F.lit(SLOTS)).cast("int")
    bit = F.pmod(F.xxhash64(F.col(column), F.lit(1)), F.lit(64)).cast("int")
    bits = ids.select(slot.alias(_SLOT), bit.alias(_BIT)).groupBy(_SLOT).agg(F.bit_or(F.expr(f"shiftleft(1L, {_BIT})")).alias(_BITS))
    marked = docs.withColumn(_SLOT, slot).withColumn(_BIT, bit).join(F.broadcast(bits), _SLOT, "left")
    listed = F.expr(f"shiftright(coalesce({_BITS}, 0L), {_BIT}) & 1L = 1L")
    return tuple(marked.filter(keep).select(*(F.col(f"`{c}`") for c in docs.columns)) for keep in (listed, ~listed))
