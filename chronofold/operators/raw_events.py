"""Raw payloads by their content: which stored event, or earlier one of the same batch, a payload repeats.

A store is append-only and large, a batch small: the payload itself is never compared or shuffled, only its digest. A bit map
of the stored digests, of a fixed number of bits whatever the store holds, says which payloads are new for sure; only the
others meet the store, in an equal join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bits of the map: 2**26 are 8 MB, in rows of 4 KB, so that the map may be broadcast.
BITS = 26
_ROW_BITS = 15


def content(payload: Column) -> Column:
    """The digest by which payloads are the same; a null payload has none."""
    return F.sha2(payload.cast("binary"), 256)


def _place(keys: Sequence[str], bits: int) -> Column:
    return F.xxhash64(*keys, F.lit(bits)).bitwiseAND(F.lit((1 << bits) - 1).cast("bigint"))


def bit_map(stored: DataFrame, keys: Sequence[str], bits: int = BITS) -> DataFrame:
    """row, map: a bit for the hash of each row's keys; at most 2**bits bits whatever stored holds."""
    at = _place(keys, bits)
    rows = stored.select(F.shiftright(at, _ROW_BITS).alias("row"), at.bitwiseAND(F.lit((1 << _ROW_BITS) - 1).cast("bigint")).alias("bit"))
    return rows.groupBy("row").agg(F.bitmap_construct_agg("bit").alias("map"))


def maybe_stored(incoming: DataFrame, maps: DataFrame, keys: Sequence[str], bits: int = BITS) -> DataFrame:
    """incoming with _maybe: false where no stored row can have its keys."""
    at = _place(keys, bits)
    out = incoming.withColumn("_row", F.shiftright(at, _ROW_BITS)).withColumn("_bit", at.bitwiseAND(F.lit((1 << _ROW_BITS) - 1).cast("bigint")).cast("int"))
    out = out.join(F.broadcast(maps.select(F.col("row").alias("_row"), "map")), "_row", "left")  # bounded by bits
    byte = F.conv(F.hex(F.substr("map", F.shiftright("_bit", 3) + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.expr("shiftright(_byte, _bit & 7) & 1") == 1
    return out.withColumn("_byte", byte).withColumn("_maybe", F.coalesce(hit, F.lit(False))).drop("_row", "_bit", "_byte", "map")


def find_identical(stored: DataFrame, incoming: DataFrame, keys: Sequence[str], payload: str, id_col: str, bits: int = BITS) -> DataFrame:
    """incoming with content (a digest) and identical_to: the smallest id of a stored event with the same keys and payload, else of
    an earlier incoming one, else null.

    stored: keys, content, id_col. Null keys or payloads are like nothing. Ids order events."""
    by = [*keys, "content"]
    rows = incoming.withColumn("content", content(F.col(payload)))
    usable = F.lit(True)
    for c in by:
        usable = usable & F.col(c).isNotNull()
    same = Window.partitionBy(*by)
    first = F.min(F.when(usable, F.col(id_col))).over(same)
    rows = rows.withColumn("_first", first)
    old = stored.dropna(subset=by).groupBy(*by).agg(F.min(id_col).alias("_old"))
    judged = maybe_stored(rows, bit_map(stored.dropna(subset=by), by, bits), by, bits)
    again = judged.where(F.col("_maybe")).join(old, by, "left")
    new = judged.where(~F.col("_maybe")).withColumn("_old", F.lit(None).cast(stored.schema[id_col].dataType))
    out = again.unionByName(new)
    earlier = F.when(usable & (F.col("_first") < F.col(id_col)), F.col("_first"))
    return out.withColumn("identical_to", F.coalesce("_old", earlier)).drop("_maybe", "_old", "_first")
