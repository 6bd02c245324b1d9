"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# The JVM never compiles a method over 8,000 bytes of byte code. A projection of fifty
# cleaned columns can generate one; past the limit Spark then evaluates it in split
# functions instead, which is several times faster than an uncompiled method.
SESSION_DEFAULTS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def get_session(app_name: str = "rowferry", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def compile_in_parts(spark: SparkSession) -> None:
    """The same method limit in a session that others made: it is read when a plan runs."""
    name = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(name)) > int(SESSION_DEFAULTS[name]):
        spark.conf.set(name, SESSION_DEFAULTS[name])


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: a cluster run needs a shared folder")
    folder = tempfile.mkdtemp(prefix="rowferry-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, never used twice."""
    return f"{shared_dir(spark)}/rowferry/{name}-{uuid.uuid4().hex}"
