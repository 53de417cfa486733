"""Session helpers: a local session for tests/bench and the shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.python.unix.domain.socket.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "logpulse", extra: dict | None = None) -> SparkSession:
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("LOGPULSE_DRIVER_MEMORY", "8g")))
    for k, v in {**LOCAL_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A folder under the cluster's shared checkpoint location.

    Uses ``spark.checkpoint.dir`` from the session. Where it is unset, a local
    session gets a temporary folder, registered as its checkpoint folder; on a
    cluster that would be another folder on every machine, so it raises.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir()
    if not base:
        conf = sc.getConf().get("spark.checkpoint.dir")
        if not conf:
            try:
                conf = spark.conf.get("spark.checkpoint.dir")
            except Exception:  # noqa: BLE001 - unset
                conf = None
        if not conf and not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not conf:
            conf = tempfile.mkdtemp(prefix="logpulse-ckpt-")
        sc.setCheckpointDir(conf)
        base = sc.getCheckpointDir()
    path = "/".join([base.rstrip("/"), *parts])
    if unique:
        path = f"{path}-{uuid.uuid4().hex[:12]}"
    return path
