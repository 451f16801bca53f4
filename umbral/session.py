"""Session helpers: cutting lineage, spreading narrow inputs, a local session."""

from __future__ import annotations

import gc
import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    The folder named in ``spark.checkpoint.dir`` wins. Only a local master falls back to a
    temporary folder: on a cluster a machine-local folder is lost with its executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running an "
                               "iterative operator on a cluster")
        configured = tempfile.mkdtemp(prefix="spark-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return configured


def cut(df: DataFrame) -> DataFrame:
    """``df`` written once as a table in the checkpoint folder and read back.

    Like a checkpoint it survives the loss of executors and ends the lineage. Unlike one, later
    readers prune its columns and push filters into it, and its size is known exactly, so small
    intermediate tables are broadcast and large ones never are.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/umbral-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete a table that :func:`cut` has written and that nothing reads any more."""
    spark = table.sparkSession
    for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
        if re.search(r"/umbral-[0-9a-f]{32}$", folder):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Ask for the shuffle files of finished steps to go: Spark drops them when the driver collects its garbage, which it may not do for long."""
    gc.collect()
    spark._jvm.System.gc()


def spread(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` over at least as many partitions as there are cores, for work that is heavy per row.

    With ``rows`` a partition also has about that many rows at most, so that what a task holds does not
    grow with the input; the rows are counted for that, so this is for tables read as they are.

    A table read from few files would otherwise keep most of the cluster idle. Inputs of at least as
    many files are returned as they are, without a shuffle; only the file list is looked at.
    """
    want = df.sparkSession.sparkContext.defaultParallelism
    if rows is not None:
        want = max(want, -(-df.count() // rows))
    return df.repartition(want) if len(df.inputFiles()) < want else df


def gather(df: DataFrame, key: str, rows: int) -> DataFrame:
    """``df`` dealt by ``key`` over partitions of about ``rows`` rows: one narrow shuffle before work by that key.

    Joins and aggregations by the key that follow find its rows together, so they neither shuffle wide
    rows nor hold more than a partition's. A key of more than ``rows`` rows would not fit: such keys are
    found in a sample, which only decides who works where, and dealt over as many partitions as they
    fill (as is a missing key); aggregations then combine their parts.
    """
    total, want = df.count(), df.sparkSession.sparkContext.defaultParallelism
    share = min(1.0, 200 / rows)
    large = {} if total <= rows else {k: -(-int(n / share) // rows) + 1 for k, n in df.select(key).filter(F.col(key).isNotNull())
                                      .sample(share, seed=1).groupBy(key).count().filter(F.col("count") >= rows * share).collect()}
    want = max(want, -(-total // rows))
    if not large:
        return df.repartition(want, key)
    pieces = F.when(F.col(key).isNull(), want)
    for n in sorted(set(large.values())):
        pieces = pieces.when(F.col(key).isin([k for k, m in large.items() if m == n]), n)
    return df.repartition(want, F.col(key), F.pmod(F.xxhash64(*df.columns), F.coalesce(pieces, F.lit(1))))


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers that were started without it on their path."""
    sc = spark.sparkContext
    if getattr(sc, "_umbral_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="umbral-"), "umbral-package.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    z.write(os.path.join(folder, name), os.path.join("umbral", os.path.relpath(os.path.join(folder, name), root)))
    sc.addPyFile(target)
    sc._umbral_shipped = True


def local_session(cpus: int | str = 8, app: str = "umbral") -> SparkSession:
    """A local session for tests and the benchmark."""
    return (SparkSession.builder.master(f"local[{cpus}]").appName(app)
            .config("spark.sql.shuffle.partitions", "8")
            .config("spark.sql.adaptive.enabled", "true")
            .config("spark.sql.session.timeZone", "UTC")
            .config("spark.driver.memory", "12g")
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .getOrCreate())
