"""Session settings. Everything else in the package takes the session it is given."""

from __future__ import annotations

import atexit
import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings the jobs rely on at scale. AQE converts joins to broadcast from measured
# sizes, splits skewed join partitions and coalesces small ones. How many partitions a shuffle
# starts with (spark.sql.shuffle.partitions) is the caller's choice: some eight per core.
# HotSpot never compiles methods over 8000 bytes, so a wide query whose generated method
# exceeds that must fall back to one method per operator instead of being interpreted.
CLUSTER_CONF = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def object_store_catalog_conf(
    catalog: str,
    uri: str,
    warehouse: str,
    endpoint: str,
    ref: str = "main",
) -> dict[str, str]:
    """Session keys of an Iceberg catalog served by Nessie over S3-compatible storage.

    Credentials belong in the cluster's own secret configuration, not here. The
    matching jars have to be on the classpath.
    """
    prefix = f"spark.sql.catalog.{catalog}"
    return {
        "spark.sql.extensions": ",".join(
            [
                "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions",
                "org.projectnessie.spark.extensions.NessieSparkSessionExtensions",
            ]
        ),
        prefix: "org.apache.iceberg.spark.SparkCatalog",
        f"{prefix}.catalog-impl": "org.apache.iceberg.nessie.NessieCatalog",
        f"{prefix}.io-impl": "org.apache.iceberg.aws.s3.S3FileIO",
        f"{prefix}.uri": uri,
        f"{prefix}.ref": ref,
        f"{prefix}.authentication.type": "NONE",
        f"{prefix}.warehouse": warehouse,
        f"{prefix}.s3.endpoint": endpoint,
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": "true",
    }


def local_session(
    cpus: int = 8, app: str = "tripspark", conf: dict[str, str] | None = None
) -> SparkSession:
    """A local session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cpus))
    )
    for key, value in {**CLUSTER_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: the one named in spark.checkpoint.dir.

    Only a session whose driver is its one machine, as in tests, gets a folder of its own. It goes
    when the process ends.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    folder = tempfile.TemporaryDirectory(prefix="tripspark-")
    atexit.register(folder.cleanup)
    context.setCheckpointDir(folder.name)
    return context.getCheckpointDir().rstrip("/")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the session's Python workers this package, as spark-submit --py-files does.

    Done once per application; workers then find it whatever folder or path they start with.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.TemporaryDirectory(prefix="tripspark-")
    atexit.register(folder.cleanup)
    path = os.path.join(folder.name, "tripspark.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for top, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(top, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)
