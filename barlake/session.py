"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the data model depends on. They are runtime SQL settings, so they can be
# applied to a session somebody else built.
REQUIRED = {
    # Offset-less timestamps on the wire and in files mean UTC.
    "spark.sql.session.timeZone": "UTC",
    # Window state and the duplicate-id store outgrow the heap on a busy stream.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # The JVM does not compile methods above 8000 bytes of code. Wide rows of checks
    # exceed that when fused into one method; below the limit Spark splits them.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "barlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with AQE and the settings above; ``master`` only for local runs."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder name that every executor can reach.

    It lies under ``spark.checkpoint.dir``. Without that setting only a local master
    may fall back to a temporary folder; a cluster must name a shared one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="barlake-")
    return f"{root.rstrip('/')}/barlake/{label}-{uuid.uuid4().hex}"
