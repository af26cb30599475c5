"""Tables that jobs keep in the folder that all machines share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def shared_folder(spark: SparkSession, label: str, unique: bool = True) -> str:
    """A folder name below ``spark.checkpoint.dir``. Only where that is unset and all runs on one machine, as
    in tests, a temporary folder takes its place."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        base = _local.setdefault("dir", "file://" + tempfile.mkdtemp(prefix="paddock-tables-"))
    return f"{base.rstrip('/')}/paddock-tables/{spark.sparkContext.applicationId}/{label}{'-' + uuid.uuid4().hex if unique else ''}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it again, so that what follows reads it as often
    as it likes without computing it again."""
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Files:
    """The few file operations that tables need, on any file system that Spark can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark._jvm, root.rstrip("/")
        self.fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str = "") -> list[str]:
        path = self._path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(path)) if self.fs.exists(path) else []

    def exists(self, name: str) -> bool:
        return self.fs.exists(self._path(name))

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """Write ``name`` at once: under another name first, then renamed. An existing file is an error."""
        part = f".{uuid.uuid4().hex}.part"
        out = self.fs.create(self._path(part), False)
        try:
            self.jvm.org.apache.commons.io.IOUtils.write(text, out, "UTF-8")
        finally:
            out.close()
        if self.exists(name) or not self.fs.rename(self._path(part), self._path(name)):
            self.fs.delete(self._path(part), False)
            raise FileExistsError(f"{self.root}/{name}")

    def remove(self, name: str) -> None:
        self.fs.delete(self._path(name), True)
