"""Where intermediate results live: the folder that the cluster shares.

`spark.checkpoint.dir` names it.  Only when a session has none (tests, a laptop) is a
local folder set up instead.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: Spark deletes a statement's shuffle files when it ends, instead of when the driver next collects garbage
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """URI of the shared folder; checkpoint() writes there too."""
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir")
    if not path:
        path = sc.getCheckpointDir()
        if not path and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not path:
            path = "file://" + tempfile.mkdtemp(prefix="graphvec-")
            sc.setCheckpointDir(path)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/graphvec-{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Statements within leave no shuffle files; a table that is written needs none of them again."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def materialize(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it back: lineage ends there, and
    the loss of an executor costs nothing that was written."""
    path = new_path(df.sparkSession, label)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete what `materialize` wrote for these tables; nothing that is still to be computed
    may read them."""
    for df in tables:
        jvm = df.sparkSession._jvm
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            if not path.getName().startswith("graphvec-"):
                raise ValueError(f"{folder} is no written intermediate")
            path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def remove(spark: SparkSession, root: str, names: list[str]) -> None:
    """Delete the folders of these names under `root`, which nothing points to any more."""
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    for name in names:
        if not name or "/" in name or name.startswith("."):
            raise ValueError(f"{name!r} is no version of this store")
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
        path.getFileSystem(conf).delete(path, True)


def broadcast_if_small(df: DataFrame, max_rows: int):
    """`df` with a broadcast hint if it has at most `max_rows` rows, else `df` as it is, which
    leaves the join to a shuffle.  Counts `df` once."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
