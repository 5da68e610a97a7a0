"""Tables between the steps of an operator, in the folder that all executors share."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Where it is unset, a temporary one is set for a session whose tasks run in the driver (local mode, as in tests); on a cluster that is an error, since executors share no such folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='racelake-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return base


class Scratch:
    """Parquet tables under one new folder: put() writes a frame and reads it back, which cuts its lineage and survives lost executors.

    A finished operator drops its tables by result() or keep(); the few that a lazy result still reads go when Python exits."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/racelake-{name}-{uuid.uuid4().hex}"
        self._made: list[str] = []
        where = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        self._files = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        atexit.register(self._at_exit)

    def _delete(self, path: str) -> None:
        self._files.delete(self.spark._jvm.org.apache.hadoop.fs.Path(path), True)

    def _at_exit(self) -> None:
        with contextlib.suppress(Exception):  # the JVM may be gone already
            self._delete(self.root)

    def put(self, df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
        path = f"{self.root}/{name}-{len(self._made)}"
        self._made.append(path)
        df.write.option("compression", codec).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def result(self, df: DataFrame) -> DataFrame:
        """Write a frame that the caller gets; drop the other tables."""
        out = self.put(df, "result")
        self.keep(1)
        return out

    def keep(self, last: int) -> None:
        """Drop all tables but so many of the last."""
        for path in self._made[: len(self._made) - last]:
            if path:
                self._delete(path)
                self._made[self._made.index(path)] = ""


def free_name(df: DataFrame, name: str) -> str:
    """A column name that df does not have, in whatever case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(spark: SparkSession, docs: DataFrame, gone: DataFrame, few: bool) -> DataFrame:
    """docs without the rows whose id (as text, '-' for null) and text hash are in gone (_id, _h); broadcast if few. All columns stay, whatever their names."""
    k, h = free_name(docs, "_gone_id"), free_name(docs, "_gone_h")
    gone = gone.select(F.col("_id").alias(k), F.col("_h").alias(h))
    same = (F.coalesce(docs["doc_id"].cast("string"), F.lit("-")) == F.col(k)) & (F.xxhash64(docs["text"]) == F.col(h))
    return docs.join(F.broadcast(gone) if few else gone, same, "left_anti")


@contextlib.contextmanager
def settings(spark: SparkSession, **values: object) -> Iterator[None]:
    """Session settings for the eager steps of an operator; names with _ for the dots."""
    names = {k.replace("__", "."): str(v) for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
