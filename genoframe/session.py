"""Session helpers: a local session for tests and bench, and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "genoframe") -> SparkSession:
    """A local session configured like the cluster one (AQE on, UI off)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("GENOFRAME_DRIVER_MEMORY", "4g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator to shared storage and is used
    as is.  Only a local master (one machine, so its disk is shared by all
    tasks) may go without: a scratch folder is created there.  Any other
    master raises, since executors do not see a folder of the driver.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="genoframe-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new folder name under this application's part of the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/genoframe-{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, tag: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as parquet under :func:`scratch_path` and read it back.

    Like a checkpoint it cuts the lineage and survives lost executors; unlike
    an RDD checkpoint the reader keeps column pruning and statistics."""
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Delete everything this application stored under the shared folder.
    For the end of a job: frames that read stored tables are invalid after."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "x")).getParent()
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: cuts the
    lineage (a lost executor re-reads files instead of recomputing the whole
    upstream plan) and lets several consumers share one computation."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``genoframe`` importable by the Python workers (pandas UDF steps).

    The package is zipped once per application into the shared checkpoint
    folder and registered with ``addPyFile``, so executors on any node fetch
    it; nothing depends on the driver's working directory."""
    import hashlib
    import io
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, _dirs, files in sorted(os.walk(root)):
            for name in sorted(files):
                if name.endswith(".py"):
                    full = os.path.join(dirpath, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(root)))
    data = buf.getvalue()
    digest = hashlib.sha256(data).hexdigest()[:16]
    folder = checkpoint_dir(spark)
    local = folder[len("file:"):] if folder.startswith("file:") else folder
    target = f"{folder.rstrip('/')}/genoframe-pkg/{digest}/genoframe.zip"
    if "://" not in folder or folder.startswith("file:"):
        os.makedirs(os.path.dirname(f"{local.rstrip('/')}/genoframe-pkg/{digest}/genoframe.zip"), exist_ok=True)
        with open(f"{local.rstrip('/')}/genoframe-pkg/{digest}/genoframe.zip", "wb") as fh:
            fh.write(data)
    else:  # shared file system: write through Hadoop
        jvm = spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(target)
        fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
        out = fs.create(path, True)
        out.write(bytearray(data))
        out.close()
    sc.addPyFile(target)
    _SHIPPED.add(app)
