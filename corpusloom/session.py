"""Session helpers: table access and the shared folder for cutting lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per context, so that their Python workers can import it."""
    sc = spark.sparkContext
    if getattr(sc, "_corpusloom_shipped", False):
        return
    package = Path(__file__).resolve().parent
    folder = Path(tempfile.mkdtemp(prefix="corpusloom-"))
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(folder / "corpusloom-package.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted(package.rglob("*.py")):
            z.write(path, path.relative_to(package.parent))
    sc.addPyFile(str(folder / "corpusloom-package.zip"))
    sc._corpusloom_shipped = True


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as the cluster names it.

    Only where ``spark.checkpoint.dir`` is unset and the master is local (as in
    tests) a temporary folder is made; on a cluster without the setting this
    raises, since a machine-local folder would lose data with its machine.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current is None:
        if named is None:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            named = tempfile.mkdtemp(prefix="corpusloom-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        sc.setCheckpointDir(named)
        current = sc.getCheckpointDir()
    return current


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def meet(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """A join that broadcasts neither side.

    The planner takes a checkpointed or Arrow-made frame for as large as what it
    was made from, so that one which grows with the data may pass for small.
    Merging sorted partitions spills, and adaptive execution splits a hot key.
    """
    return left.hint("merge").join(right.hint("merge"), on, how)
