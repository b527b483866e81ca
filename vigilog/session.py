"""Session helpers: UTC, and tables written to the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"


def pin_utc(spark: SparkSession) -> SparkSession:
    """Log feeds carry UTC instants; hours and dates that a reader sees are shown in UTC too."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def _one_machine(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_root(spark: SparkSession) -> str:
    """The shared folder that the session or its context names.

    Only plain local mode, where all tasks share one disk, may go without: there a temporary
    one is set. On a cluster a machine's own folder would lose rows, so that is an error.
    """
    named = spark.conf.get(CHECKPOINT_KEY, None)
    if named:
        return named
    context = spark.sparkContext
    if not context.getCheckpointDir():
        if not _one_machine(spark):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="vigilog-"))
    return context.getCheckpointDir()


class Files:
    """The file system of a path, by way of Spark's own client."""

    def __init__(self, spark: SparkSession, path: str):
        if not hasattr(spark, "_jvm"):
            raise RuntimeError("files can only be managed from a classic Spark session")
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()
        self.path = self._path(path)
        self._system = self.path.getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._system.exists(self._path(path))

    def folders(self, path: str) -> list[str]:
        """Names of the folders in a folder; none if it is missing."""
        return [name for name, folder in self.entries(path) if folder]

    def entries(self, path: str) -> list[tuple[str, bool]]:
        """(name, whether it is a folder) of everything in a folder, by name."""
        if not self.exists(path):
            return []
        found = self._system.listStatus(self._path(path))
        return sorted((e.getPath().getName(), e.isDirectory()) for e in found)

    def changed(self, path: str) -> float:
        """When a file or folder was last changed, in seconds since 1970."""
        return self._system.getFileStatus(self._path(path)).getModificationTime() / 1000

    def read(self, path: str) -> str:
        stream = self._system.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Create a file whole or not at all; false if there is one already."""
        target = self._path(path)
        draft = self._path(f"{target.getParent()}/.draft-{uuid.uuid4().hex}")
        stream = self._system.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        hadoop = self._jvm.org.apache.hadoop.fs
        context = hadoop.FileContext.getFileContext(target.toUri(), self._conf)
        try:
            # Without the option to overwrite, a rename onto an existing file fails.
            context.rename(draft, target, self._gateway.new_array(hadoop.Options.Rename, 0))
        except Py4JJavaError:
            if not self.exists(path):
                raise
            return False
        finally:
            self._system.delete(draft, False)
        return True

    def make(self, path: str, delete_on_exit: bool = False) -> None:
        self._system.mkdirs(self._path(path))
        if delete_on_exit:
            self._system.deleteOnExit(self._path(path))

    def delete(self, path: str) -> None:
        self._system.delete(self._path(path), True)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used yet, below the shared folder.

    All of an application's paths lie in one folder, which is deleted when it ends.
    """
    app = f"{shared_root(spark).rstrip('/')}/vigilog/{spark.sparkContext.applicationId}"
    Files(spark, app).make(app, delete_on_exit=True)
    return f"{app}/{name}-{uuid.uuid4().hex}"


_open: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Copies that are made inside the block are deleted at its end, not at the application's.

    Nothing that reads them may be left over then.
    """
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            Files(spark, path).delete(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Used where several branches need one expensive result. The copy is columnar, so
    every branch reads only its own columns, it survives the loss of executors, and
    the planner knows its true size. On a cluster the rows that were written are compared
    with the rows that the driver can read, so a folder that is not shared is an error.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    if _open:
        _open[-1].append(path)
    counted = None if _one_machine(spark) else Observation()
    rows = df if counted is None else df.observe(counted, F.count(F.lit(1)).alias("rows"))
    rows.write.mode("errorifexists").parquet(path)
    copy = spark.read.schema(df.schema).parquet(path)
    if counted is not None and copy.count() != (written := counted.get["rows"]):
        raise RuntimeError(f"{path} does not show all of the {written} rows written to it")
    return copy
