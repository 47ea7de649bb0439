"""Merging what many small batches have written into few files.

A table of batches lies in ``{path}/{name}``, one folder per batch. Version K of its merged form holds the rows of all
batches up to K, with their batch number, in folders by account hash (and by day). A version is written first and named
by a manifest afterwards, a single small file, so a reader sees it whole or not at all. Readers take the newest manifest
and the batches after its number. A batch is only merged when a later one runs, so one that is run again is never among
the merged; merging again up to the same number does nothing.

Folders that a newer version replaces are left to be deleted when no reader of an older version is left; none that reads
now lists them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ROWS_PER_FILE = 2_000_000
BUCKETS = 16
#: Up to so many batches after the merged ones are named one by one; beyond that, their folders are listed.
NAMED_BATCHES = 1_000
_MANIFEST = "day STRING, at LONG"


def read_or_empty(spark: SparkSession, paths: str | list[str], schema: StructType, base: str) -> DataFrame:
    """The files at ``paths``; no rows where nothing has been written yet."""
    try:
        if paths:
            return spark.read.schema(schema).option("basePath", base).parquet(*([paths] if isinstance(paths, str) else paths))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    return spark.createDataFrame([], schema)


#: The folder of rows without a day.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def bucket_of(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


@dataclass(frozen=True)
class BatchTable:
    """A table written batch by batch. ``schema`` has its columns, with ``batch_id`` and, with ``by_day``, ``event_date``.
    ``key`` deals rows to buckets and ``spread_by`` deals a large bucket, as of a hot key, to several files."""

    path: str
    name: str
    schema: StructType
    key: str
    spread_by: str
    by_day: bool = False

    @property
    def batches(self) -> str:
        return f"{self.path}/{self.name}" if self.name else self.path

    @property
    def merged(self) -> str:
        return f"{self.path}/merged-{self.name}" if self.name else f"{self.path}-merged"

    @property
    def manifest(self) -> str:
        return f"{self.merged}-manifest"

    def newest(self, spark: SparkSession) -> tuple[int, dict[str, int]]:
        """The last merged batch, -1 if none, and the version that holds each day's rows (``""`` without days)."""
        schema = StructType.fromDDL(_MANIFEST + ", version LONG")
        rows = read_or_empty(spark, self.manifest, schema, self.manifest)
        last = rows.agg(F.max("version")).first()[0]
        if last is None:
            return -1, {}
        # One row per day.
        return last, {r.day: r.at for r in rows.filter(F.col("version") == last).collect() if r.day is not None}

    def _tail(self, spark: SparkSession, after: int, upto: int | None, days: list[str] | None) -> DataFrame:
        """Rows of the batches after the merged ones."""
        path = self.batches
        if self.by_day:
            path += f"/event_date={{{','.join(days)}}}" if days is not None else "/event_date=*"
        named = upto is not None and upto - after <= NAMED_BATCHES
        path += f"/batch_id={{{','.join(str(b) for b in range(after + 1, upto + 1))}}}" if named else "/batch_id=*"
        if (named and upto <= after) or days == []:
            path = []
        rows = read_or_empty(spark, path, self.schema, self.batches).filter(F.col("batch_id") > after)
        return rows if upto is None else rows.filter(F.col("batch_id") <= upto)

    def _merged_rows(self, spark: SparkSession, at: dict[str, int]) -> DataFrame:
        """Rows of some days' versions. A folder that the manifest names must be there: its absence is an error."""
        kept = StructType([*self.schema.fields, *StructType.fromDDL("bucket INT").fields])
        paths = [f"{self.merged}/version={v}" + (f"/event_date={d}" if self.by_day else "") for d, v in at.items()]
        if not paths:
            return spark.createDataFrame([], kept)
        return spark.read.schema(kept).option("basePath", self.merged).parquet(*paths)

    def read(self, spark: SparkSession, upto: int | None = None, days: list[str] | None = None, buckets: list[int] | None = None) -> DataFrame:
        """Rows of the batches up to ``upto``, of some days, and at least those of some buckets."""
        last, at = self.newest(spark)
        tail = self._tail(spark, last, upto, days)
        old = self._merged_rows(spark, {d: v for d, v in at.items() if days is None or d in days})
        if buckets is not None:
            old = old.filter(F.col("bucket").isin(buckets))
        if upto is not None:
            old = old.filter(F.col("batch_id") <= upto)
        names = self.schema.fieldNames()
        return old.select(*names).unionByName(tail.select(*names))

    def compact(self, spark: SparkSession, upto: int, reduce: Callable[[DataFrame], DataFrame] | None = None) -> None:
        """Merges all batches up to ``upto``. Days without new rows keep their folders."""
        last, at = self.newest(spark)
        if upto <= last:
            return
        tail = self._tail(spark, last, upto, None)
        days = [""]
        if self.by_day:
            days = [NO_DAY if r[0] is None else str(r[0]) for r in tail.select("event_date").distinct().collect()]
        if days:
            names = self.schema.fieldNames()
            before = self._merged_rows(spark, {d: at[d] for d in days if d in at})
            rows = tail.select(*names).unionByName(before.select(*names))
            self._write(rows if reduce is None else reduce(rows), f"{self.merged}/version={upto}")
        named = [(d, v) for d, v in {**at, **{d: upto for d in days}}.items()] or [(None, None)]
        spark.createDataFrame(named, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.manifest}/version={upto}")

    def _write(self, rows: DataFrame, path: str) -> None:
        rows = rows.withColumn("bucket", bucket_of(F.col(self.key)))
        folder = ["event_date", "bucket"] if self.by_day else ["bucket"]
        # One row per day and bucket.
        sizes = rows.groupBy(*[F.col(c).alias(f"_{c}") for c in folder]).agg(F.ceil(F.count(F.lit(1)) / ROWS_PER_FILE).alias("_files"))
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in folder]
        dealt = rows.join(F.broadcast(sizes), same).withColumn("_file", F.pmod(F.xxhash64(self.spread_by), F.col("_files")))
        dealt = dealt.repartition(*folder, "_file").select(*rows.columns)
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*folder).parquet(path)
