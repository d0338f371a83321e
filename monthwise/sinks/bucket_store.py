"""Rows in hash buckets of their keys, of which a change rewrites only those it touches."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthwise.sinks import files

BUCKET = "bucket"


@dataclass(frozen=True)
class _Index:
    """What a version consists of: ``places`` says under which version each bucket lies."""

    buckets: int
    schema: dict
    note: str
    places: dict[int, int]

    @classmethod
    def read(cls, text: str) -> _Index:
        body = json.loads(text)
        body["places"] = {int(b): v for b, v in body["places"].items()}
        return cls(**body)

    def fields(self) -> list[T.StructField]:
        return T.StructType.fromJson(self.schema).fields


class BucketStore:
    """A table whose content at a version is one directory for each bucket.

    A version writes new directories for the buckets it changes, in one job, and then a small index
    file that says under which version every bucket lies. The index is the commit: until it is complete,
    readers see the version before, and a writer cut short repeats its version. The buckets of the
    version before are kept, so that readers of the moment can finish; older ones are removed. There are
    never more than twice ``buckets`` directories.

    The number of buckets is fixed by the first version. Without ``keys`` there is one. It should grow with
    the table: a bucket is written by one task.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], buckets: int = 16):
        if buckets < 1:
            raise ValueError("at least one bucket")
        self.spark, self.keys = spark, list(keys)
        self._wanted = buckets if self.keys else 1
        self._versions, self._index = f"{root}/versions", f"{root}/index"
        self._seen: dict[int, _Index] = {}

    def committed(self) -> list[int]:
        """The versions that can be read: the current one and the one before."""
        found = files.names(self.spark, f"{self._index}/*.json")
        return sorted(int(name.removesuffix(".json")) for name in found)

    def version(self) -> int | None:
        """The current version; None before the first."""
        done = self.committed()
        return done[-1] if done else None

    def _entry(self, version: int | None = None) -> _Index | None:
        version = self.version() if version is None else version
        if version is None:
            return None
        if version not in self._seen:
            self._seen[version] = _Index.read(files.read_text(self.spark, f"{self._index}/{version}.json"))
        return self._seen[version]

    def note(self) -> str | None:
        """What the current version's writer noted with it."""
        entry = self._entry()
        return entry.note if entry else None

    @property
    def buckets(self) -> int:
        entry = self._entry()
        return entry.buckets if entry else self._wanted

    def bucket(self) -> Column:
        """The bucket of a row."""
        if not self.keys:
            return F.lit(0)
        return F.pmod(F.hash(*self.keys), F.lit(self.buckets))

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets that rows fall into, at most ``buckets`` numbers."""
        found = rows.select(self.bucket().alias(BUCKET)).distinct().collect()
        return sorted(r[BUCKET] for r in found)

    def _place(self, version: int, bucket: int) -> str:
        return f"{self._versions}/version-{version}/{BUCKET}={bucket}"

    def read(self, only: Sequence[int] | None = None) -> DataFrame | None:
        """All rows, or those of some buckets, in one pass; None before the first version."""
        entry = self._entry()
        if entry is None:
            return None
        schema = T.StructType(entry.fields())
        places = sorted(entry.places.items())
        paths = [self._place(v, b) for b, v in places if only is None or b in only]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def spread(self, rows: DataFrame) -> DataFrame:
        """One task for each bucket, with the exchange that aggregates by the keys need."""
        return rows.repartition(self.buckets, *self.keys) if self.keys else rows.coalesce(1)

    def replace(
        self, rows: DataFrame, version: int, buckets: Sequence[int], note: str = "", spread: bool = True
    ) -> None:
        """Make ``rows`` the whole content of ``buckets``, into which all of them fall.

        Versions ascend; one that is complete is not written again. ``spread`` says whether rows still
        have to be exchanged, see :meth:`spread`. Columns that the table lacks widen it.
        """
        before = self._entry()
        if before is not None and version <= self.version():
            return
        count, kept = self.buckets, before.places if before else {}
        path = f"{self._versions}/version-{version}"
        placed = (self.spread(rows) if spread else rows).withColumn(BUCKET, self.bucket())
        placed.write.mode("overwrite").partitionBy(BUCKET).parquet(path)
        places = {b: v for b, v in kept.items() if b not in set(buckets)}
        written = files.names(self.spark, f"{path}/{BUCKET}=*")
        places |= {int(name.split("=", 1)[1]): version for name in written}
        fields = {f.name: f for f in rows.schema}
        if before:
            fields = {f.name: f for f in before.fields()} | fields
        nullable = [T.StructField(f.name, f.dataType, True) for f in fields.values()]
        entry = _Index(count, T.StructType(nullable).jsonValue(), note, places)
        files.write_text(self.spark, f"{self._index}/{version}.json", json.dumps(asdict(entry)))
        self._prune()

    def _prune(self) -> None:
        done = self.committed()
        kept = {place for v in done[-2:] for place in self._entry(v).places.items()}
        for old in done[:-2]:
            gone = set(self._entry(old).places.items()) - kept
            for bucket, version in gone:
                files.delete(self.spark, self._place(version, bucket))
            for version in {v for _, v in gone} - {v for _, v in kept}:
                files.delete(self.spark, f"{self._versions}/version-{version}")
            files.delete(self.spark, f"{self._index}/{old}.json")
            self._seen.pop(old, None)
