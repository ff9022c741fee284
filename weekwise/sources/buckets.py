"""Tables of one run in the same buckets: joins and aggregations on the bucket key need no exchange."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from weekwise.sources.files import Folder, work_folder


class BucketedTables:
    """Relations written once, each dealt by its key to the same number of buckets, one sorted file a bucket.

    The files lie below the session's ``spark.checkpoint.dir`` (lineage is
    cut: a lost executor costs no recomputation); the session catalog holds
    their bucket layout under names of this run.  A bucket holds all rows of
    its keys, so relations should be combined to few rows per key first.
    ``drop`` removes tables and files; a run that dies leaves its folder.
    """

    def __init__(self, spark: SparkSession, buckets: int | None = None) -> None:
        self.spark = spark
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.run = uuid.uuid4().hex
        self._folder = Folder(spark, f"{work_folder(spark, 'buckets')}/{self.run}")
        self._tables: dict[str, DataFrame] = {}

    def _table(self, name: str) -> str:
        return f"weekwise_{self.run}_{name}"

    def write(self, df: DataFrame, name: str, key: str) -> DataFrame:
        """``df`` as a table bucketed by ``key``; NULL keys share a bucket."""
        (df.repartition(self.buckets, key).write.format("parquet").bucketBy(self.buckets, key).sortBy(key)
         .option("path", self._folder.path(name)).saveAsTable(self._table(name)))
        self._tables[name] = self.spark.table(self._table(name))
        return self._tables[name]

    def has(self, df: DataFrame) -> bool:
        return any(df is x for x in self._tables.values())

    def are_stored(self) -> bool:
        return all(self._folder.exists(x) and self.spark.catalog.tableExists(self._table(x)) for x in self._tables)

    def drop(self) -> None:
        for name in self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(name)}")
        self._folder.delete("")
        self._tables.clear()
