"""Tables by month and hash bucket: months are registered first, writes replace only the partitions that they touch.

A month has 0 (no) or 2 to 64 buckets of its own, fixed when it is registered; registering it again changes nothing. A row of
a month that is not registered is an error, before anything is written. Partitions are folders (event_month, bucket), so a
read of a range or a key lists and scans those alone.
"""

from __future__ import annotations

import json
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.errors import InvalidArgument, NotFound
from chronofold.sources import places

MOST_BUCKETS = 64


class MonthTable:
    def __init__(self, spark: SparkSession, path: str, ts: str, key: str):
        """path: a folder; ts: the timestamp that tells the month; key: what buckets are dealt by."""
        self.spark, self.path, self.ts, self.key = spark, str(path).rstrip("/"), ts, key

    def register(self, month: str | date, buckets: int = 0) -> int:
        """The month's number of buckets: as asked, or as it was registered before."""
        if buckets < 0 or buckets > MOST_BUCKETS or buckets == 1:
            raise InvalidArgument(f"buckets must be 0 or between 2 and {MOST_BUCKETS}")
        name = month.strftime("%Y-%m") if isinstance(month, date) else datetime.strptime(month[:7], "%Y-%m").strftime("%Y-%m")
        places.create(self.spark, f"{self.path}/_months/{name}.json", json.dumps({"event_month": name, "buckets": buckets}).encode())
        return json.loads(places.read(self.spark, f"{self.path}/_months/{name}.json"))["buckets"]

    def months(self) -> dict[str, int]:
        """Registered months and their buckets."""
        found = (json.loads(places.read(self.spark, f"{self.path}/_months/{n}")) for n in places.names(self.spark, f"{self.path}/_months"))
        return {m["event_month"]: m["buckets"] for m in found}

    def _bucket(self, month: Column, months: dict[str, int]) -> Column:
        buckets = F.try_element_at(F.create_map(*[F.lit(x) for pair in months.items() for x in pair]), month)
        return F.when(buckets > 0, F.pmod(F.xxhash64(self.key), buckets)).otherwise(0).cast("int")

    def write(self, rows: DataFrame) -> None:
        """Replace the partitions that rows has rows of; all others stay. Large partitions are split over several files and tasks."""
        months = self.months()
        if not months:
            raise NotFound(f"no month of {self.path} is registered")
        month = F.date_format(self.ts, "yyyy-MM")
        known = F.coalesce(month.isin(*months), F.lit(False))
        other = rows.where(~known).select(month.alias("m")).first()
        if other is not None:
            raise NotFound(f"month {other.m} of {self.path} is not registered")
        out = rows.withColumn("event_month", month).withColumn("bucket", self._bucket(F.col("event_month"), months))
        out.hint("rebalance", "event_month", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_month", "bucket").parquet(f"{self.path}/data")

    def read(self, since: datetime, until: datetime, key=None) -> DataFrame:
        """Rows with since <= ts < until (and of a key): only the partitions that may hold them are listed and scanned."""
        months = self.months()
        wanted = {m: n for m, n in months.items() if f"{since:%Y-%m}" <= m <= f"{until:%Y-%m}"}
        data = self.spark.read.option("basePath", f"{self.path}/data").schema(self._schema()).parquet(f"{self.path}/data")
        out = data.where(F.col("event_month").isin(*wanted) if wanted else F.lit(False)).where((F.col(self.ts) >= F.lit(since)) & (F.col(self.ts) < F.lit(until)))
        if key is not None:
            kind = out.schema[self.key].dataType
            at = self.spark.range(1).select(F.xxhash64(F.lit(key).cast(kind)).alias("h")).first().h
            places_ = F.lit(False)
            for m, n in wanted.items():
                places_ = places_ | ((F.col("event_month") == m) & (F.col("bucket") == (at % n if n else 0)))
            out = out.where(places_).where(F.col(self.key) == F.lit(key))
        return out

    def _schema(self):
        found = self.spark.read.parquet(f"{self.path}/data").schema
        for f in found:
            if f.name == "event_month":
                f.dataType = self.spark.range(0).select(F.lit("").alias("s")).schema["s"].dataType
        return found
