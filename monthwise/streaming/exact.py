"""Calendar months closed record by record on a stream.

The same rule as :mod:`monthwise.operators.replay`, kept up batch by batch: every record moves the
watermark, so within a batch the earliest arrival from a month's deadline on closes that month, and what
comes after it is late. Between batches only the greatest day and the sums of open months are needed.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from monthwise.config import WATERMARK_DAYS
from monthwise.operators.monthly import exact_units
from monthwise.operators.replay import with_lateness
from monthwise.sinks.batch_log import BATCH, BatchLog
from monthwise.sinks.bucket_store import BucketStore
from monthwise.streaming.jobs import run_batches


def _settled_before(greatest: dt.date, delay_days: int) -> dt.date:
    """Months before this one are closed once a record of day ``greatest`` has been seen."""
    return (greatest - dt.timedelta(days=delay_days)).replace(day=1)


class ExactMonthJob:
    """Records ``series..., day, sales, seq`` in; closed months in ``closed``, late records in ``late``.

    ``seq`` is the arrival number (offset, ingest id). Rows of one batch may come in any order, but a later
    batch must not hold earlier arrivals; one that does fails the job. Records without a day or a ``seq``
    have to be set aside before. However the arrivals are cut into batches, the months and late records are
    those of one batch replay over all of them.

    State is one exact sum for each series and open month, in hash buckets of the series. A batch
    rewrites the buckets of its series, and all of them when it closes a month.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        series: Sequence[str] = (),
        delay_days: int = WATERMARK_DAYS,
        scale: int | None = None,
        day: str = "day",
        sales: str = "sales",
        seq: str = "seq",
        buckets: int = 16,
    ):
        self.series, self.delay, self.scale = list(series), delay_days, scale
        self.day, self.sales, self.seq = day, sales, seq
        self.checkpoint = f"{root}/checkpoint"
        self.closed = BatchLog(spark, f"{root}/closed", merge_every=16)
        self.late = BatchLog(spark, f"{root}/late", merge_every=16)
        self.open = BucketStore(spark, f"{root}/open", self.series, buckets)

    def handle(self, batch: DataFrame, batch_id: int) -> None:
        done = self.open.version()
        if done is not None and batch_id <= done:
            return
        batch = batch.persist()
        try:
            self._handle(batch, batch_id)
        finally:
            batch.unpersist()

    def _handle(self, batch: DataFrame, batch_id: int) -> None:
        seen = json.loads(self.open.note() or "null")
        here = batch.agg(
            F.max(F.col(self.day).cast("date")).alias("day"),
            F.min(self.seq).alias("first"), F.max(self.seq).alias("last"),
        ).first()
        if here["day"] is None or here["first"] is None:
            return
        if seen and here["first"] <= seen["seq"]:
            raise ValueError(f"arrival {here['first']} came after arrival {seen['seq']} was processed")
        before = dt.date.fromisoformat(seen["day"]) if seen else None
        after = here["day"] if before is None else max(before, here["day"])
        closes = _settled_before(after, self.delay)
        marked = with_lateness(batch, self.day, self.seq, self.delay).drop("is_closed")
        moved = before is None or closes > _settled_before(before, self.delay)
        if before is not None:
            gone = F.col("month") < F.lit(_settled_before(before, self.delay))
            marked = marked.withColumn("is_late", F.col("is_late") | F.coalesce(gone, F.lit(False)))
        self.late.write(marked.filter("is_late").drop("is_late"), batch_id)

        fresh = marked.filter(~F.col("is_late") & F.col("month").isNotNull())
        sums = fresh.groupBy(*self.series, "month").agg(self._part().alias("part"))
        touched = list(range(self.open.buckets)) if moved else self.open.touched(sums)
        old = self.open.read(only=touched)
        if old is not None:
            sums = sums.unionByName(old)
        total = F.sum("part").alias("part")
        sums = self.open.spread(sums).groupBy(*self.series, "month").agg(total).persist()
        try:
            if moved:
                self.closed.write(self._months(sums.filter(F.col("month") < F.lit(closes))), batch_id)
            note = json.dumps({"day": after.isoformat(), "seq": here["last"]})
            still_open = sums.filter(F.col("month") >= F.lit(closes))
            self.open.replace(still_open, batch_id, touched, note, spread=False)
        finally:
            sums.unpersist()

    def _part(self):
        """A sum that can be added to: whole units of the amounts, or doubles as they come."""
        if self.scale is None:
            return F.sum(self.sales)
        return exact_units(F.col(self.sales), self.scale)

    def _months(self, sums: DataFrame) -> DataFrame:
        total = F.col("part").cast("double")
        if self.scale is not None:
            total = total / F.lit(float(10**self.scale))
        return sums.select(*self.series, "month", F.coalesce(total, F.lit(0.0)).alias("sales"))

    def months(self) -> DataFrame | None:
        """``series..., month, sales`` of all closed months; None before the first."""
        rows = self.closed.read()
        return None if rows is None else rows.drop(BATCH)

    def late_records(self) -> DataFrame | None:
        """The records that came after their month was closed."""
        rows = self.late.read()
        return None if rows is None else rows.drop(BATCH)

    def start(self, records: DataFrame, every: str | None = None) -> StreamingQuery:
        return run_batches(records, self.handle, self.checkpoint, every)
