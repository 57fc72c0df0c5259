"""Tables, and the shared folder in which lineage is cut.

Lineage is cut only by files that every executor can read: a Parquet table below the folder named by
``spark.checkpoint.dir``. Where the session names none (tests, a laptop), a local folder is set once.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data folder (one file or a folder of parts)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder for tables that cut lineage; set here only where the session has none."""
    found = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY, None)
    if not found:
        current = spark.sparkContext.getCheckpointDir()
        if current is None:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError(f"{CHECKPOINT_KEY} must name a folder that all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="codexloom-"))
            current = spark.sparkContext.getCheckpointDir()
        found = current
    return found.rstrip("/")


#: Scratch folders of each application that are not deleted yet.
_made: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, deleted by :func:`clear_scratch`."""
    path = f"{shared_dir(spark)}/codexloom-{label}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders of this application once no table made of them is read any more; how many there were."""
    paths = _made.pop(spark.sparkContext.applicationId, [])
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(hadoop).delete(folder, True)
    return len(paths)


def cut(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back, so that a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_mark(spark: SparkSession) -> int:
    """How many scratch folders there are; for :func:`drop_made`."""
    return len(_made.get(spark.sparkContext.applicationId, []))


def drop_made(spark: SparkSession, since: int, keep: tuple[DataFrame, ...]) -> None:
    """Delete the scratch folders made after the mark ``since``, but those of the tables ``keep``, made by :func:`cut`."""
    paths = _made.get(spark.sparkContext.applicationId, [])
    held = {file.rsplit("/", 2)[-2] for df in keep for file in df.inputFiles()}
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for path in [p for p in paths[since:] if p.rsplit("/", 1)[-1] not in held]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(hadoop).delete(folder, True)
        paths.remove(path)


def drop_scratch(df: DataFrame) -> None:
    """Delete the files behind a table made by :func:`cut` once nothing reads it any more."""
    spark = df.sparkSession
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for file in df.inputFiles():
        parent = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        if parent.getName().startswith("codexloom-"):
            parent.getFileSystem(hadoop).delete(parent, True)
            return
