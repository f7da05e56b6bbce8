"""Session helpers: table loading, shared-folder materialisation, sizing."""

from __future__ import annotations

import atexit
import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each Spark context.

    Executors need not have it installed; where they do, it is the same code.
    """
    sc = spark.sparkContext
    if getattr(sc, "_kinmark_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.join("kinmark", os.path.relpath(path, root)))
    home = tempfile.mkdtemp(prefix="kinmark-code-")
    with open(os.path.join(home, "kinmark.zip"), "wb") as f:  # the driver serves it to the executors
        f.write(data.getvalue())
    sc.addPyFile(os.path.join(home, "kinmark.zip"))
    sc._kinmark_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of the data folder."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share.

    The cluster names it in ``spark.checkpoint.dir``; only where that is unset
    (tests, a single machine) a temporary folder is made, once for each context.
    """
    base = named_shared_dir(spark)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="kinmark-")
        spark.sparkContext._kinmark_shared = base
    return base


def named_shared_dir(spark: SparkSession) -> str | None:
    """The shared folder that is named in the session, or was made before."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return named or getattr(spark.sparkContext, "_kinmark_shared", None)


def materialize(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back.

    Cuts the lineage and lets several consumers read one result with column
    pruning; survives the loss of an executor, unlike a cached block.  The
    folder is removed when the driver's Python ends.
    """
    spark = df.sparkSession
    ship(spark)
    path = f"{shared_dir(spark)}/kinmark/{label}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, label: str, **conditions: Column) -> tuple[DataFrame, Observation]:
    """``df`` with run counters that its next action fills: the number of rows, and of those that meet each condition.

    No extra pass; read them with ``observation.get`` after the action.
    """
    seen = Observation(label)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in conditions.items()]), seen


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the JVM may be gone already
        pass
