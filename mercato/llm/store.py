"""Tables written to the shared folder, to cut lineage between steps.

Everything goes to the folder that the cluster names in
``spark.checkpoint.dir``, which driver and executors share, so a lost
executor costs a re-read and not a recompute.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors, once for each application:
    functions that run there are found by the package's name."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="mercato-code-")) / "mercato.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(str(path))
    _shipped.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The session's shared folder.

    Where ``spark.checkpoint.dir`` is unset, a scratch folder is made, but
    only for a local master (tests); on a cluster that is an error, since
    executors would write to their own disks.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="mercato-llm-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, removed when the session ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return path


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have, also with a suffix and in
    another case."""
    name = f"_{stem}"
    while any(c.lower().startswith(name) for c in df.columns):
        name = f"_{name}"
    return name


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back."""
    spark = df.sparkSession
    ship(spark)
    path = new_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
