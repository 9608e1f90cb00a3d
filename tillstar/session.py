"""Session helpers: building a session for local runs, and the shared scratch folder.

On a cluster the session is built by the launcher; nothing here overrides what it set.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a job of this package wants. They are defaults: any value already set on the
# session (spark-defaults, launcher) wins.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "tillstar",
                  extra: dict | None = None) -> SparkSession:
    """Session for tests, bench and local runs."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_root(spark)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Staging tables, swaps and lineage cuts go here, never to a machine-local folder. Only
    when the session has no checkpoint folder at all (a bare test session) do we pick one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext            # absent on Spark Connect sessions
    except Exception:  # noqa: BLE001
        sc = None
    if not root and sc is not None:
        root = sc.getConf().get("spark.checkpoint.dir", None)
        if not root and sc.getCheckpointDir():
            root = sc.getCheckpointDir().rsplit("/", 1)[0]
    if not root:
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tillstar-ckpt-")
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def new_scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder below the scratch root (one per run)."""
    path = f"{scratch_root(spark)}/tillstar/{label}-{uuid.uuid4().hex[:12]}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    return path


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared storage, if it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def list_folders(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """(name, seconds since 1970 of its last change) of the folders directly below ``path``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    return [(s.getPath().getName(), s.getModificationTime() / 1000) for s in fs.listStatus(folder) if s.isDirectory()]


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly below ``path``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(folder) if s.isFile()] if fs.exists(folder) else []


def write_small_file(spark: SparkSession, path: str, text: str) -> None:
    """A new file of driver metadata: written beside its name and renamed, so it is there whole or not at all."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    final, part = hadoop.Path(path), hadoop.Path(f"{path}.{uuid.uuid4().hex[:8]}.part")
    fs = final.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(part, False)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(final) or not fs.rename(part, final):
        raise FileExistsError(path)


def read_small_file(spark: SparkSession, path: str) -> str:
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = file.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = fs.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def reliable_checkpoint(df):
    """``df.checkpoint()`` into the shared checkpoint folder (set from the session first):
    materialised once, survives executor loss, and cuts the lineage. Never ``localCheckpoint``."""
    scratch_root(df.sparkSession)
    return df.checkpoint()
