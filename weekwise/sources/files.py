"""A folder on any file system that Spark reads (Hadoop API)."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


class Folder:
    """Names, moves and deletions below one path."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._jvm = spark._jvm
        self._gateway = spark.sparkContext._gateway
        conf = spark._jsc.hadoopConfiguration()
        path = self._jvm.org.apache.hadoop.fs.Path(root)
        self._fs = path.getFileSystem(conf)
        self.root = self._fs.makeQualified(path).toString()
        self._context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path("").toUri(), conf)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}" if name else self.root

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self.path(name))

    def names(self, below: str = "") -> list[str]:
        """Names of the entries, oldest first; of none if there is no such folder."""
        if not self.exists(below):
            return []
        found = [(s.getModificationTime(), s.getPath().getName()) for s in self._fs.listStatus(self._path(below))]
        return [name for _, name in sorted(found)]

    def age_ms(self, name: str, now_ms: int) -> int:
        return now_ms - self._fs.getFileStatus(self._path(name)).getModificationTime()

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(name))

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)

    def touch(self, name: str) -> None:
        self._fs.create(self._path(name), True).close()

    def replace(self, source: str, target: str) -> None:
        """Move a file over another in one step of the file system."""
        option = self._jvm.org.apache.hadoop.fs.Options.Rename
        options = self._gateway.new_array(option, 1)
        options[0] = option.OVERWRITE
        self._context.rename(self._path(source), self._path(target), options)


def work_folder(spark: SparkSession, name: str) -> str:
    """A place for tables between jobs: below the session's ``spark.checkpoint.dir``, which executors share.

    Only a local session may go without that setting and gets a temporary folder.
    """
    shared = spark.sparkContext.getCheckpointDir()
    if shared is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or "cluster" in master:
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        return tempfile.mkdtemp(prefix=f"weekwise-{name}-")
    return f"{shared}/{name}"
