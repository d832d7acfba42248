"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "tablewright", **conf) -> SparkSession:
    """A session with adaptive execution on; keyword names use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="tablewright-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_uri(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/tablewright/{name}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers of the session's executors, once per application."""
    context = spark.sparkContext
    if getattr(context, "_shipped_tablewright", None) == context.applicationId:
        return
    package = Path(__file__).resolve().parent
    sources = sorted(package.rglob("*.py"))
    # Executors refuse another file of the same name, so the name follows the content.
    digest = hashlib.sha256(b"\0".join(s.read_bytes() for s in sources)).hexdigest()[:12]
    target = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}-{digest}.zip"
    with zipfile.ZipFile(target, "w") as file:
        for source in sources:
            file.write(source, source.relative_to(package.parent))
    context.addPyFile(str(target))  # Spark takes it from the driver to the executors
    context._shipped_tablewright = context.applicationId


def _stages(spark: SparkSession) -> list[str]:
    """Where this application has frozen stages, in order."""
    context = spark.sparkContext
    if getattr(context, "_tablewright_stages", (None,))[0] != context.applicationId:
        context._tablewright_stages = (context.applicationId, [])
    return context._tablewright_stages[1]


def stage_count(spark: SparkSession) -> int:
    return len(_stages(spark))


def drop_stages(spark: SparkSession, since: int = 0) -> int:
    """Delete the frozen stages after the first ``since``; frames that read them can no longer be used."""
    stages = _stages(spark)
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for uri in stages[since:]:
        path = spark._jvm.org.apache.hadoop.fs.Path(uri)
        path.getFileSystem(hadoop).delete(path, True)
    dropped = len(stages) - since
    del stages[since:]
    return dropped


def freeze(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts lineage and survives executor loss; being columnar, later passes still
    read only the columns they use.
    """
    uri = scratch_uri(df.sparkSession, name)
    _stages(df.sparkSession).append(uri)
    df.write.parquet(uri)
    return df.sparkSession.read.schema(df.schema).parquet(uri)
