"""Session helpers: time zone pinning and the shared scratch folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "voltstream") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Log times carry no zone; pin the session zone so parse and render agree. The setting stays on the session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def _master(spark: SparkSession) -> str:
    """The session's master; a session without SparkContext access counts as a cluster."""
    try:
        return spark.sparkContext.master
    except Exception:  # noqa: BLE001 - remote session
        return "remote"


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a shared file system path); an unset value
    raises there, since executors would not see a driver-local folder. Only a
    ``local`` / ``local[n]`` master without the setting gets a private folder,
    registered so that ``DataFrame.checkpoint()`` and our written tables use it.
    """
    base = None
    try:
        base = spark.conf.get(_CKPT_KEY, None)
    except Exception:  # noqa: BLE001 - key unknown to this session
        base = None
    if not base:
        try:
            base = spark.sparkContext.getConf().get(_CKPT_KEY, None)
        except Exception:  # noqa: BLE001 - no SparkContext access (remote session)
            base = None
    if not base:
        master = _master(spark)
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"{_CKPT_KEY} must name a shared folder on master {master!r}")
        base = tempfile.mkdtemp(prefix="voltstream-ckpt-")
        try:
            spark.conf.set(_CKPT_KEY, base)
        except Exception:  # noqa: BLE001 - not settable at runtime; the folder is still used
            pass
    try:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(base)
    except Exception:  # noqa: BLE001 - remote session: DataFrame.checkpoint uses the server's setting
        pass
    return base.rstrip("/")


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared folder for one run."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


#: for steps that write much: shuffle files go as soon as the write that made them has ended (else when the driver happens
#: to collect garbage), tables are packed tighter than with the default codec, and a task that writes the parts of a
#: partitioned table side by side needn't sort (and spill) its whole rows first
FRUGAL = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.maxConcurrentOutputFileWriters": "32",
}


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Settings of the session for the writes inside; what they were is set again afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    apply_settings(spark, values)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def scale_settings(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Session settings sized for a run over ``input_bytes`` of bronze on ``total_cores`` cores.

    * scans: ``maxPartitionBytes`` of 256 MB keeps a split (and its decoded
      rows) well inside a task's memory share;
    * shuffles: the initial partition count covers the largest shuffle (about
      the size of the input: requests + results, parsed) at
      ``target_partition_bytes`` each, never below 2 × cores; AQE then
      coalesces to the advisory size and splits skewed partitions;
    * broadcasts: the log pipeline forces none, so the automatic threshold is
      left at its default.
    """
    shuffle_parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle_parts),
        "spark.sql.shuffle.partitions": str(shuffle_parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }


def apply_settings(spark: SparkSession, settings: dict[str, str]) -> None:
    """Set runtime SQL settings on a session (static ones belong in the launch config)."""
    for k, v in settings.items():
        spark.conf.set(k, v)
