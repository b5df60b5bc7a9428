"""Session settings and the shared scratch folder."""

from __future__ import annotations

import io
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


#: Applications whose Python workers have this package.
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that the few Python functions that
    run in tasks can be imported there."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root, content = Path(__file__).parent, io.BytesIO()
    with zipfile.ZipFile(content, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, f"{root.name}/{file.relative_to(root)}")
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{_application_dir(spark)}/{root.name}.zip")
    out = target.getFileSystem(context._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(content.getvalue()))
    out.close()
    context.addPyFile(target.toString())
    _shipped.add(context.applicationId)


def prepare_session(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings the results depend on (calendar months are UTC months)."""
    ship_package(spark)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir``, else the session's warehouse.

    Both are named by the cluster and seen by every executor; the rule is the same in every mode.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (named or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def _application_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/moodtide/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for this application below the shared folder; no run reads another's files."""
    return f"{_application_dir(spark)}/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame, schema: StructType | None = None) -> DataFrame:
    """Write ``df`` once below the shared folder and go on from that table.

    Cuts the lineage, so a lost executor costs a re-read instead of a recomputation, and computes
    the plan once. As Parquet, later steps still read only the columns they need. ``schema`` gives the
    written columns other types of the same form, such as a vector type.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df``, written, with the rows numbered from 0 without gaps in the order of its partitions and rows, so
    in its sort order if it is sorted. Rows are counted within their task; only the tasks' counts meet."""
    rows = durable(df.withColumn("_n", F.monotonically_increasing_id()))
    task = F.shiftright("_n", 33)  # what monotonically_increasing_id puts above the row's own number
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = rows.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("n")).select(
        "_task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first")
    )
    place = F.col("_first") + F.col("_n").bitwiseAND((1 << 33) - 1)
    return rows.join(tasks, task == F.col("_task")).select(*df.columns, place.alias(name))


def remove_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; call it once the results are written."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_application_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme: one without a scheme belongs to the cluster's default file system."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(hadoop).toString()


#: Setting: the number of tasks over which ``spread`` deals out a scan. Unset, it leaves scans as they are.
SCAN_PARTITIONS = "spark.moodtide.scanPartitions"


def spread(df: DataFrame) -> DataFrame:
    """The rows of a scan dealt out over as many tasks as ``SCAN_PARTITIONS`` says, as scanned if it is unset.

    For text work over files known to have fewer splits than the cluster has cores, such as one compressed
    file or one row group; it moves the rows once. It does not look at the data or the cluster.
    """
    partitions = df.sparkSession.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(partitions)) if partitions else df
