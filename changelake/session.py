"""Session construction and the shared scratch location.

On a cluster the session already names a shared folder in ``spark.checkpoint.dir``;
every lineage cut and every intermediate table goes below it. Only when it is unset
(local tests) do we create one.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import SparkSession

# Settings every job here relies on. AQE re-plans joins from measured shuffle sizes
# (so a broadcast is only chosen for a side whose runtime size is known to be small),
# coalesces small partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


MAX_SHUFFLE_PARTITIONS = 200_000


def cluster_conf(input_bytes: int, executor_cores_total: int,
                 input_bytes_per_partition: int = 1 << 30) -> dict[str, str]:
    """Settings sized for a large cluster run over ``input_bytes`` of input.

    The initial shuffle width gives each shuffle partition about 1 GiB of *input*: our
    shuffles carry far less than the input (projection, partial aggregation and the
    map-side group limit run first), so this lands near the 128 MB advisory size. It is
    at least two partitions per core and at most 200,000 (map-output tracking grows with
    mappers x reducers). AQE then coalesces small partitions and splits skewed ones.
    """
    parts = min(MAX_SHUFFLE_PARTITIONS,
                max(2 * executor_cores_total, input_bytes // input_bytes_per_partition))
    return {
        **DEFAULT_CONF,
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        # Static broadcast only from plan estimates of small scans; AQE may still switch a
        # join to broadcast once the measured shuffle output of a side is below this.
        "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }


def build_session(master: str | None = None, app: str = "changelake",
                  conf: dict[str, str] | None = None, **overrides: str) -> SparkSession:
    """A session with ``DEFAULT_CONF`` (or ``conf``, e.g. from ``cluster_conf``), plus
    keyword overrides written with ``__`` for dots (``spark__sql__shuffle__partitions``)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(conf if conf is not None else DEFAULT_CONF)
    settings.update({k.replace("__", "."): v for k, v in overrides.items()})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """A query keeps the settings it was started with; the session gets its own back."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def tidy(query: Callable) -> Callable:
    """A query ``(spark, ...)`` whose jobs remove their shuffle files when they end. Else these lie on
    the executors' disks until the driver happens to collect its garbage, many rewrites' worth."""

    @wraps(query)
    def run(spark: SparkSession, *args, **options):
        with settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
            return query(spark, *args, **options)

    return run


def session_like(spark: SparkSession, values: Mapping[str, str]) -> SparkSession:
    """A session with the settings of ``spark`` and ``values``, for what asks its session later on."""
    own = spark.newSession()
    for k, v in {**spark.conf.getAll, **values}.items():
        if own.conf.isModifiable(k):
            own.conf.set(k, v)
    return own


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def scratch_dir(spark: SparkSession, *parts: str, fresh: bool = False) -> str:
    """A folder under the session's shared checkpoint location.

    ``fresh=True`` appends a unique suffix so that every run writes somewhere new.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if root:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
    else:
        root = sc.getCheckpointDir()
        if not root:
            if not _is_local(spark):
                raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
            # Tests only: the setting is unset, so take a fresh local folder.
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="changelake-"))
            root = sc.getCheckpointDir()
    if root.startswith("file:"):
        root = root[len("file:"):]
    path = os.path.join(root, *parts) if parts else root
    if fresh:
        path = f"{path}-{uuid.uuid4().hex[:12]}"
    return path
