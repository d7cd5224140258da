"""Order books as of any instant: the nearest base before it, and the changes since.

Bases are snapshots of all levels (with the number of the last change that they hold) and CLEAR changes, which leave an
empty book. One window over a book's bases, changes and questions, in their order, carries the newest base, the highest
number seen since and whether one was skipped; only changes numbered above all before them apply. Each applied change
then holds for its level until the next one of the same base, so that a question meets the changes of its own base only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Order of rows of one instant: a base, then changes by number, then questions.
_BASE, _CHANGE, _ASK = 0, 1, 2
LEVELS = "array<struct<side:string,price:{0},quantity:{1}>>"


def book_as_of(snapshots: DataFrame, changes: DataFrame, asks: DataFrame) -> DataFrame:
    """Each ask's (book, ask_id, at) levels, a row each, with what they rest on; an ask without levels has one row of null levels.

    snapshots: book, ts, seq (the last change that it holds), levels (array of side, price, quantity). changes: book, ts,
    seq, action (SET, DELETE, CLEAR), side, price, quantity. Result: book, ask_id, at, base_ts, base_seq, last_seq (the
    highest number applied), gap (a number between is missing), status (OK, GAP, NO_BASE), side, price, quantity. What
    arrives at the instant of a question counts. A change that is not above the numbers before it since the base is stale
    and left out; a null book, ts or seq takes no part."""
    kind = {f.name: f.dataType.simpleString() for f in changes.schema.fields}
    levels = LEVELS.format(kind["price"], kind["quantity"])
    s = snapshots.dropna(subset=["book", "ts", "seq"]).select("book", "ts", F.lit(_BASE).alias("kind"), F.col("seq").cast("bigint").alias("seq"), F.coalesce(F.col("levels").cast(levels), F.array().cast(levels)).alias("levels"))
    c = changes.dropna(subset=["book", "ts", "seq"]).select("book", "ts", F.lit(_CHANGE).alias("kind"), F.col("seq").cast("bigint").alias("seq"), "action", "side", "price", "quantity")
    a = asks.dropna(subset=["book", "at"]).select("book", F.col("at").alias("ts"), F.lit(_ASK).alias("kind"), "ask_id")
    every = s.unionByName(c, allowMissingColumns=True).unionByName(a, allowMissingColumns=True)
    is_base = (F.col("kind") == _BASE) | F.col("action").eqNullSafe("CLEAR")
    order = ["ts", "kind", "seq"]
    run = Window.partitionBy("book").orderBy(*order, "ask_id").rowsBetween(Window.unboundedPreceding, 0)
    every = every.withColumn("is_base", is_base).withColumn("base", F.last(F.when(F.col("is_base"), F.struct("ts", "seq", "kind")), ignorenulls=True).over(run)).withColumn("base_no", F.sum(F.col("is_base").cast("bigint")).over(run))
    since = Window.partitionBy("book", "base_no").orderBy(*order, "ask_id")
    before = F.max("seq").over(since.rowsBetween(Window.unboundedPreceding, -1))
    every = every.withColumn("before", before)
    applies = (F.col("kind") == _CHANGE) & ~F.col("is_base") & (F.col("base_no") > 0) & (F.col("seq") > F.col("before"))
    every = every.withColumn("applies", applies).withColumn("skipped", applies & (F.col("seq") > F.col("before") + 1))
    so_far = since.rowsBetween(Window.unboundedPreceding, 0)
    every = every.withColumn("gap", F.max("skipped").over(so_far)).withColumn("last_seq", F.max("seq").over(so_far))
    asked = every.where(F.col("kind") == _ASK).select("book", "ask_id", F.col("ts").alias("at"), "base_no", F.col("base.ts").alias("base_ts"), F.col("base.seq").alias("base_seq"), F.when(F.col("base_no") > 0, F.col("last_seq")).alias("last_seq"), F.coalesce("gap", F.lit(False)).alias("gap"))
    status = F.when(F.col("base_no") == 0, "NO_BASE").when(F.col("gap"), "GAP").otherwise("OK")
    asked = asked.withColumn("status", status)
    first = every.where(F.col("kind") == _BASE).select("book", "base_no", "ts", "seq", F.explode("levels").alias("l"))
    first = first.groupBy("book", "base_no", "ts", "seq", "l.side", "l.price").agg(F.max("l.quantity").alias("quantity"))
    set_ = first.select("book", "base_no", "ts", "seq", F.lit("SET").alias("action"), "side", "price", "quantity")
    moved = every.where("applies").select("book", "base_no", "ts", "seq", "action", "side", "price", "quantity")
    by_level = Window.partitionBy("book", "base_no", "side", "price").orderBy("seq")
    held = set_.unionByName(moved).withColumn("until", F.lead("ts").over(by_level)).where("action = 'SET'")
    h = held.select("book", "base_no", F.col("ts").alias("_from"), "until", "side", "price", "quantity")
    q = asked.alias("q")
    on = (F.col("q.book") == F.col("h.book")) & (F.col("q.base_no") == F.col("h.base_no")) & (F.col("h._from") <= F.col("q.at")) & (F.col("h.until").isNull() | (F.col("h.until") > F.col("q.at")))
    return q.join(h.alias("h"), on, "left").select("q.book", "q.ask_id", "q.at", "q.base_ts", "q.base_seq", "q.last_seq", "q.gap", "q.status", "h.side", "h.price", "h.quantity")
