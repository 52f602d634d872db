"""Session settings, the shared folder that cuts lineage, and what a job leaves behind."""

from __future__ import annotations

import tempfile
import threading
import uuid

from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession

_LOCAL = threading.local()


def _scopes() -> list[Scope]:
    """The open scopes of this thread."""
    if not hasattr(_LOCAL, "scopes"):
        _LOCAL.scopes = []
    return _LOCAL.scopes


class Scope:
    """Releases what a job has written down and broadcast on its way, once it is left.

    Results are lazy: they must have been written, to a folder of their own, before.
    Without a scope all of it stays as long as the application.
    """

    def __enter__(self) -> Scope:
        self.folders, self.broadcasts = [], []
        _scopes().append(self)
        return self

    def __exit__(self, *_) -> None:
        _scopes().remove(self)
        for shared in self.broadcasts:
            shared.destroy()
        for spark, folder in self.folders:
            delete_folder(spark, folder)


def leave_folder(spark: SparkSession, folder: str) -> None:
    """Has the current scope delete the folder, if there is a scope."""
    if _scopes():
        _scopes()[-1].folders.append((spark, folder))


def share(spark: SparkSession, value) -> Broadcast:
    """A broadcast that the current scope takes back, if there is a scope."""
    shared = spark.sparkContext.broadcast(value)
    if _scopes():
        _scopes()[-1].broadcasts.append(shared)
    return shared


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def local_session(name: str = "gleanery", cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the bench; clusters bring their own."""
    partitions = "8" if cores == "*" else str(cores)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, reachable by every executor.

    A local session may go without the setting and then gets a temporary folder;
    on a cluster a missing setting is an error, never a machine-local folder.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="gleanery-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a result that is read more than once and go on from the written table.

    Unlike a cache it survives lost executors, and unlike a checkpoint it is
    columnar, so later readers still prune columns.
    """
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    leave_folder(df.sparkSession, path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def input_files(df: DataFrame) -> int:
    """How many files a table is read from; their names stay in the JVM."""
    return len(df._jdf.inputFiles())
