"""The revision state of each key in a stream: what a row is, compared with the last revision that was kept.

The state of a key (a series and a bar, say) is the number of its newest revision and a digest of its fields, whatever
the number of rows; it is kept for good, as a late row is a correction and never dropped. Rows of one micro-batch are
taken in their order columns' order, micro-batches as they come, so that rows that arrive in order get what
ingest.append_if_changed gives for all of them at once, also through restarts. With quiet_seconds a timer of processing
time says when a key has had no row for so long: a row SETTLED with its newest revision number, once until the next row.
"""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SETTING = "spark.sql.streaming.stateStore.providerClass"


def digest(fields: Sequence[str]) -> Column:
    """Equal for rows whose fields are equal, nulls included."""
    return F.sha2(F.to_json(F.struct(*[F.col(f).alias(f"f{i}") for i, f in enumerate(fields)]), {"ignoreNullFields": "false"}), 256)


def _place(row: Row) -> tuple:
    """A row's place in the order; a struct comes as a dict where a stream goes on from a store, and as a Row elsewhere."""
    order = row["_order"]
    return tuple((x is not None, x) for x in (order.values() if isinstance(order, dict) else order))


class _Changes(StatefulProcessor):
    def __init__(self, quiet_seconds: float | None, width: int):
        self.quiet, self.no_order = quiet_seconds, {f"o{i}": None for i in range(width)}

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "revision_no bigint, digest string")

    @staticmethod
    def _row(key: tuple, order, outcome: str, number: int) -> Row:
        return Row(**{f"k{i}": k for i, k in enumerate(key)}, _order=order, outcome=outcome, revision_no=number)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        number, print_ = self.last.get() if self.last.exists() else (0, None)
        for r in sorted(rows, key=_place):
            outcome = "UNCHANGED"
            if number == 0 or r["_digest"] != print_:
                number, print_ = number + 1, r["_digest"]
                outcome = "INSERTED" if number == 1 else "CORRECTED"
            yield self._row(key, r["_order"], outcome, number)
        self.last.update((number, print_))
        if self.quiet is not None:
            for at in list(self.handle.listTimers()):
                self.handle.deleteTimer(at)
            self.handle.registerTimer(int(time.time() * 1000 + self.quiet * 1000))

    def handleInitialState(self, key: tuple, initialState: Row, timerValues) -> None:
        self.last.update((initialState["_number"], initialState["_digest"]))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.last.exists():
            yield self._row(key, Row(**self.no_order), "SETTLED", self.last.get()[0])

    def close(self) -> None:
        pass


def changes(stream: DataFrame, keys: Sequence[str], fields: Sequence[str], order: Sequence[str], quiet_seconds: float | None = None, stored: DataFrame | None = None) -> DataFrame:
    """keys, order columns, outcome (INSERTED, CORRECTED, UNCHANGED; SETTLED by a timer) and revision_no of each row.

    stored: keys, fields and revision_no of a store that the stream goes on from; of a key its highest revision counts, and
    only where the checkpoint is new. The session must have RocksDB as its state store when the query starts; start() sees to that."""
    rows = stream.select(*keys, F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)]).alias("_order"), digest(fields).alias("_digest"))
    names = [f"k{i}" for i in range(len(keys))]
    schema = rows.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], "_order", F.lit("").alias("outcome"), F.lit(0).cast("bigint").alias("revision_no")).schema
    first = None
    if stored is not None:
        newest = stored.groupBy(*keys).agg(F.max(F.struct(F.col("revision_no").cast("bigint").alias("_number"), digest(fields).alias("_digest"))).alias("_n"))
        first = newest.select(*keys, "_n.*").groupBy(*keys)
    out = rows.groupBy(*keys).transformWithState(_Changes(quiet_seconds, len(order)), schema, "update", "none" if quiet_seconds is None else "processingTime", first)
    return out.select(*[F.col(n).alias(k) for k, n in zip(keys, names)], *[F.col(f"_order.o{i}").alias(c) for i, c in enumerate(order)], "outcome", "revision_no")


def start(changed: DataFrame, store: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Work off what there is into a Parquet store, a folder a micro-batch: one that is done again replaces its own.

    once: in one micro-batch. Needed with quiet_seconds, as a stream with timers of processing time never runs dry."""
    spark = changed.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{store}/batch_id={number}")

    before = spark.conf.get(SETTING, None)
    spark.conf.set(SETTING, PROVIDER)  # a query keeps the settings that it starts with
    try:
        return changed.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint).trigger(**({"once": True} if once else {"availableNow": True})).start()
    finally:
        spark.conf.unset(SETTING) if before is None else spark.conf.set(SETTING, before)
