"""Session construction and the shared folder for intermediate results."""

from __future__ import annotations

import os
import pathlib
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators rely on. Shuffle partition counts are left to AQE and
# to the cluster's own configuration.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app_name: str, conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's settings.

    The master, memory and shuffle settings come from spark-submit; anything in
    ``conf`` wins over the defaults above.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SESSION_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Taken from ``spark.checkpoint.dir`` (or a checkpoint folder already set on
    the context). Only a local master gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="ledgerline-")
    context.setCheckpointDir(folder)
    return folder


def fresh_dir(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that no other call has used."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable without replacing a configured folder."""
    folder = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """Session for stateful streams.

    State partitions are fixed when a query first starts. They follow
    ``spark.sql.shuffle.partitions`` as the caller set it, unless given. The
    sibling session shares the context and leaves the caller's settings alone.
    """
    sibling = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.streaming.stateStore.providerClass"):
        sibling.conf.set(key, spark.conf.get(key))
    partitions = state_partitions or spark.conf.get("spark.sql.shuffle.partitions")
    sibling.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return sibling


_SHIPPED = "spark.ledgerline.shipped"


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    context = spark.sparkContext
    if context.getLocalProperty(_SHIPPED) == context.applicationId:
        return
    root = pathlib.Path(__file__).resolve().parents[1]
    base = os.path.join(tempfile.mkdtemp(prefix="ledgerline-"), "ledgerline_tasks")
    context.addPyFile(shutil.make_archive(base, "zip", root, "ledgerline"))
    context.setLocalProperty(_SHIPPED, context.applicationId)
