"""Session helpers: where intermediate tables live and how lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "driftlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect; existing settings win on a cluster."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Hash joins only where the measured shuffle partitions are small; anything larger sorts and can spill.
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    running = SparkSession.getActiveSession()
    for key, value in {**defaults, **conf}.items():
        if running is None or running.conf.get(key, None) is None:
            builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local session that names none gets a temporary folder of its own. On a cluster the setting is required: executors
    would otherwise write to disks of their own that the others cannot read.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="driftlens-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/driftlens/{label}-{uuid.uuid4().hex}"


class Folder:
    """Small files and names below a folder of whatever store Spark can reach."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self.root = spark.sparkContext._jvm, path.rstrip("/")
        self._fs = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, name: str = "") -> list[str]:
        """What is in a folder; nothing if there is none."""
        return [entry.getPath().getName() for entry in self._fs.listStatus(self._at(name))] if self._fs.exists(self._at(name)) else []

    def complete(self, name: str) -> bool:
        """Whether Spark has finished writing the table."""
        return self._fs.exists(self._at(f"{name}/_SUCCESS"))

    def text(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """Make a new small file visible at once: written beside its place, then renamed. An existing one is an error."""
        beside = f"{name}.{uuid.uuid4().hex}"
        stream = self._fs.create(self._at(beside))
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        if self._fs.exists(self._at(name)) or not self._fs.rename(self._at(beside), self._at(name)):
            self._fs.delete(self._at(beside), False)
            raise FileExistsError(f"{self.root}/{name}")

    def delete(self, name: str = "") -> None:
        self._fs.delete(self._at(name), True)


_OPEN: list[list[str]] = []


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Owner of intermediate tables: those written inside are deleted at its end, when their readers are done."""
    _OPEN.append([])
    try:
        yield
    finally:
        for path in _OPEN.pop():
            Folder(spark, path).delete()


def durable(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared folder and read it back.

    Cuts lineage, survives the loss of executors, and pins values that would otherwise be computed
    anew by each consumer (slice numbers of a range partitioning above all).
    """
    path = scratch_path(df.sparkSession, label)
    if _OPEN:
        _OPEN[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
