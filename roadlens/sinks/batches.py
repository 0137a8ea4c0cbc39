"""Numbered batches written exactly once: appended to a store, or kept as a table of last values by key.

A batch that is run again after a crash, with the same number and rows, leaves what one run leaves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 8
COMPACT_AFTER = 20


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _file_system(spark, path)
    return files.exists(place)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; nothing if it is not there."""
    files, place = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    files, place = _file_system(spark, path)
    files.delete(place, True)


def append_batch(df: DataFrame, store: str, writer: str, number: int) -> None:
    """Appends batch ``number`` of ``writer`` to a flat folder of Parquet files.

    The rows are written beside the store first. A marked folder is whole, so from then on a repetition only
    moves the files that are still there, whose names are their own.
    """
    spark = df.sparkSession
    staging = f"{store}/_{writer}-{number}"
    if not exists(spark, f"{staging}/_SUCCESS"):
        df.write.mode("overwrite").parquet(staging)
    files, target = _file_system(spark, store)
    path = spark._jvm.org.apache.hadoop.fs.Path
    for name in children(spark, staging):
        if name.startswith("part-") and not files.rename(path(f"{staging}/{name}"), path(f"{store}/{name}")):
            raise OSError(f"cannot move {staging}/{name}")
    for name in children(spark, store):  # the staging of batches that are done
        if name.startswith(f"_{writer}-") and int(name.rpartition("-")[2]) < number:
            remove(spark, f"{store}/{name}")


class LastValues:
    """The last ``columns`` of each ``key`` (text) as of any batch, in buckets by key hash.

    A batch adds a small table of its keys; after ``compact_after`` of them one table of all keys takes their
    place. What batch n sees is what the batches before it wrote, also when n itself was written already. With a
    ``since`` older values are not seen, and are left out when tables are put together.
    """

    def __init__(self, root: str, key: str, columns: str, buckets: int = BUCKETS, compact_after: int = COMPACT_AFTER):
        self.root, self.key, self.buckets, self.compact_after = root, key, buckets, compact_after
        self.columns = [f.name for f in T._parse_datatype_string(columns)]
        self.schema = f"{key} string, {columns}, stamp bigint, kind string, batch bigint, bucket int"

    def _tables(self, spark: SparkSession, kind: str) -> list[int]:
        """Numbers of the whole tables of a kind."""
        names = children(spark, f"{self.root}/kind={kind}")
        numbers = sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))
        return [n for n in numbers if exists(spark, f"{self.root}/kind={kind}/batch={n}/_SUCCESS")]

    def before(self, spark: SparkSession, number: int, since: int | None = None) -> DataFrame:
        """key, columns and stamp of every key as of the batches before ``number``."""
        base = max((n for n in self._tables(spark, "base") if n < number), default=-1)
        wanted = [n for n in self._tables(spark, "delta") if base < n < number]
        names = [self.key, *self.columns, "stamp"]
        if base < 0 and not wanted:
            return spark.createDataFrame([], self.schema).select(*names, "bucket")
        kind, batch = F.col("kind"), F.col("batch")
        rows = spark.read.schema(self.schema).parquet(self.root)
        rows = rows.filter(((kind == "base") & (batch == base)) | ((kind == "delta") & batch.isin(wanted)))
        if since is not None:
            rows = rows.filter(F.col("stamp") >= since)
        if len(wanted) + (base >= 0) > 1:
            last = F.max_by(F.struct(*names[1:]), "batch").alias("_last")
            rows = rows.groupBy("bucket", self.key).agg(last).select(self.key, "_last.*", "bucket")
        return rows.select(*names, "bucket")

    def bucket(self, key: str | None = None):
        return F.pmod(F.xxhash64(key or self.key), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, kind: str, number: int) -> None:
        (rows.repartition(self.buckets, "bucket").sortWithinPartitions("bucket", self.key)
         .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/kind={kind}/batch={number}"))

    def put(self, rows: DataFrame, number: int, since: int | None = None) -> None:
        """Adds what batch ``number`` knows of its keys: key, columns and stamp, one row a key."""
        spark = rows.sparkSession
        self._write(rows.select(self.key, *self.columns, "stamp", self.bucket().alias("bucket")), "delta", number)
        done = self._tables(spark, "base")
        if number - max(done, default=-1) >= self.compact_after:
            self._write(self.before(spark, number + 1, since), "base", number)
            # The batch just written may run again, and then must see the tables before it: they stay until the next one.
        for kind, last in (("base", max(done, default=-1)), ("delta", max((n for n in done if n < number), default=-1) + 1)):
            for n in self._tables(spark, kind):
                if n < last:
                    remove(spark, f"{self.root}/kind={kind}/batch={n}")
