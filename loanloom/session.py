"""Session helpers: shared folder, staged tables, small driver-side lookups."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "loanloom", cores: str = "*", shuffle: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``.  Only a local master, where driver
    and executors are one process, may fall back to a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    own = tempfile.mkdtemp(prefix="loanloom-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    """Delete a table written by this session, on whatever store it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


#: Rows below which a table keeps its partitions, and rows a partition has at most.
FEW_ROWS, MOST_ROWS = 50_000, 5_000_000


def dealt(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of about ``rows`` rows, in equal parts: one a core, more if parts would be large.

    The tail of a join may come in two or three files of unequal size, and every later pass over
    them has no more tasks than that.  A small table stays as it is.
    """
    if rows < FEW_ROWS:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores * -(-rows // (cores * MOST_ROWS)))


_written: list[list[str]] = []


@contextlib.contextmanager
def staged_files(spark: SparkSession) -> Iterator[None]:
    """Delete what :func:`stage` writes inside the block once the block ends.

    Write or collect results inside: DataFrames read the staged files until then.  A result
    written with ``outlive`` belongs to the block around this one, if there is any.
    """
    own: list[str] = []
    _written.append(own)
    try:
        yield
    finally:
        _written[:] = [other for other in _written if other is not own]
        for path in own:
            delete(spark, path)


def stage(df: DataFrame, label: str = "stage", outlive: bool = False) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Multi-pass operators (quantile narrowing, sampling, nearest neighbours, model fits)
    then scan columns of a file instead of repeating the joins behind ``df``.
    """
    path = shared_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    if len(_written) > outlive:
        _written[-1 - outlive].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
