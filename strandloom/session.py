"""Session helpers shared by the operators: table access, checkpoints, bounded rows."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the bench; on a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("strandloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the driver imported it from.

    Where workers find it anyway (its folder is on PYTHONPATH, or is the working directory) nothing happens; otherwise the
    sources go out once with the session, as ``--py-files`` would send them.
    """
    context, root = spark.sparkContext, Path(__file__).resolve().parent
    found = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if getattr(context, "_strandloom_sent", False) or any(p and Path(p).resolve() == root.parent for p in found):
        return
    archive = Path(tempfile.mkdtemp(prefix="strandloom-")) / "strandloom.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._strandloom_sent = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Only where that is unset and the master is a
    single local process is a temporary folder used, since there the machine is the whole cluster; it goes with the process.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise ValueError("spark.checkpoint.dir is unset: name a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="strandloom-checkpoint-")
            atexit.register(shutil.rmtree, folder, True)
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def bounded_rows(df: DataFrame, most: int, what: str) -> list:
    """Rows of a dimension table for use on the driver; refuses a table of more than ``most`` rows."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{what} has more than {most} rows; process it in blocks")
    return rows
