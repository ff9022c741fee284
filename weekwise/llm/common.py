"""Helpers the operators share: tables, scratch tables, skewed lookups."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

# A key is hot when more than 1/HOT_KEYS of all rows carry it, so at most
# HOT_KEYS keys can be hot, whatever the size of the input.
HOT_KEYS = 1000
# A hot key's rows are dealt to this many tasks.
HOT_SPREAD = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z only; null counts as empty."""
    return F.translate(F.coalesce(col, F.lit("")), UPPER, LOWER)


def held_out(doc_id: Column) -> Column:
    """Rows kept away from label fitting: crc32 of the id as text, mod 4, is 2.

    A null id is never held out.
    """
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster shares for intermediate tables.

    It is the session's ``spark.checkpoint.dir``.  Only a local session
    (tests) may go without the setting and gets a folder of its own.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="weekwise-llm-"))
        current = spark.sparkContext.getCheckpointDir()
    return current


def fresh(columns: list[str], name: str) -> str:
    """``name``, or a longer form of it that none of ``columns`` has."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


class Scratch:
    """Intermediate tables in the shared folder.

    A written table cuts the lineage: when an executor is lost, later stages
    read it again instead of recomputing what stands before it.  ``drop``
    frees a table that no pending plan reads.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self.n = 0

    def path(self, name: str) -> str:
        self.n += 1
        return f"{self.root}/{self.n}-{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def sweep(self) -> None:
        """Let Spark remove the shuffle files of plans that have been written.

        It does so when the driver collects the plans, which may otherwise be
        long after; meanwhile they fill the executors' disks.
        """
        gc.collect()
        self.spark._jvm.System.gc()

    def clear(self) -> None:
        """Free all tables, when no pending plan reads any."""
        self.drop(self.root)

    def drop(self, *frames_or_paths) -> None:
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        for x in frames_or_paths:
            path = jvm.org.apache.hadoop.fs.Path(x if isinstance(x, str) else x._scratch_path)
            path.getFileSystem(conf).delete(path, True)


def salted_lookup(left: DataFrame, right: DataFrame, keys: list[str], weight: str,
                  spread: list[str], how: str = "inner") -> DataFrame:
    """Join ``left`` to ``right`` (one row per key) without a hot task.

    ``right[weight]`` is the number of left rows of the key.  The hot keys,
    at most ``HOT_KEYS`` by their definition, are broadcast as a flag; their
    left rows are dealt by a hash of ``spread`` and their right rows repeated
    once per part.  All other keys join as they are.  Both sides grow with the
    input, so neither is broadcast at any size.  The weight column is dropped.
    """
    total = right.agg(F.sum(weight)).head()[0] or 0
    bound = max(total // HOT_KEYS, 10_000)
    is_hot = F.col(weight) > bound
    if total <= bound:
        return left.join(right.drop(weight).hint("merge"), keys, how)
    hot = right.filter(is_hot).select(*keys, F.lit(True).alias("_hot"))
    dealt = (left.join(F.broadcast(hot), keys, "left")
             .withColumn("_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(*spread), F.lit(HOT_SPREAD))
                                         ).otherwise(F.lit(0)).cast("int"))
             .drop("_hot"))
    copies = right.withColumn(
        "_salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(HOT_SPREAD - 1)))
                           .otherwise(F.array(F.lit(0))))).drop(weight)
    return dealt.join(copies.hint("merge"), [*keys, "_salt"], how).drop("_salt")
