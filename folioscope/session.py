"""Session settings and cutting of lineage."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once for each Spark context, so that its functions can be run there.

    Needed where the package is not installed on them; the archive is handed to
    Spark, whose driver serves it.
    """
    sc = spark.sparkContext
    if getattr(sc, "_folioscope_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="folioscope-")) / "folioscope.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(archive))
    sc._folioscope_shipped = True


def tables(spark: SparkSession, folder: str, *names: str) -> list[DataFrame]:
    """The named parquet tables of a folder."""
    ship(spark)
    return [spark.read.parquet(f"{folder}/{n}.parquet") for n in names]


def spread(df: DataFrame) -> DataFrame:
    """``df`` over at least as many partitions as there are cores, for costly maps over scans of files.

    A large table has more splits than that and stays as it is; a small one in
    few files would otherwise keep few cores busy. Only the number of files and
    their size as the plan knows it are looked at; nothing runs.
    """
    spark = df.sparkSession
    n, files = spark.sparkContext.defaultParallelism, len(df.inputFiles())
    if not files or files >= n:
        return df
    size = int(str(df._jdf.queryExecution().analyzed().collectLeaves().apply(0).stats().sizeInBytes()))
    split = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    return df if size >= n * split else df.repartition(n)


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read again.

    The folder is the one the cluster names in ``spark.checkpoint.dir``; only
    where that is unset (a local test) a temporary folder is taken.
    """
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="folioscope-"))
    return df.checkpoint(eager)
