"""Session helpers.

On a cluster the session comes from the platform; ``get_session`` only fills in
settings that are unset, so cluster-level values (shuffle partitions, the shared
checkpoint folder) always win.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings this library relies on; applied only where the session leaves them unset.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "inkwell") -> SparkSession:
    """Return the active session, or build a local one for tests and benchmarks."""
    active = SparkSession.getActiveSession()
    if active is not None:
        for k, v in DEFAULT_CONF.items():
            if active.conf.get(k, None) is None:
                active.conf.set(k, v)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (builder.config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", os.environ.get("INKWELL_DRIVER_MEMORY", "16g")))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names it; only a local session without one (tests) gets a fresh
    scratch folder here.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if conf_dir:
        if current is None:
            sc.setCheckpointDir(conf_dir)
        return conf_dir
    if current is not None:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    local_dir = tempfile.mkdtemp(prefix="inkwell-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local_dir)
    sc.setCheckpointDir(local_dir)
    return local_dir


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Used for tables read by several later branches (deduplicated messages, chat
    samples, per-sample features): the upstream work runs once, the lineage is
    cut (a lost executor costs a re-read, not a recomputation), and re-reads keep
    column pruning and filter pushdown.
    """
    import uuid

    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/inkwell-tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    delete_on_exit(spark, path)
    return spark.read.parquet(path)


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Have the application remove an intermediate table when it ends (a returned DataFrame may still read it
    until then)."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(p)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable by the Python workers, from whatever folder the job was started.

    The package goes as one zip through the shared folder, once per Spark context.
    """
    import io
    import uuid
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_inkwell_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for folder, _, files in os.walk(top):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join("inkwell", os.path.relpath(full, top)))
    target = f"{ensure_checkpoint_dir(spark).rstrip('/')}/inkwell-{uuid.uuid4().hex}.zip"
    path = sc._jvm.org.apache.hadoop.fs.Path(target)
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path, True)
    try:
        out.write(bytearray(buffer.getvalue()))
    finally:
        out.close()
    sc.addPyFile(target)
    sc._inkwell_shipped = True
