"""Session settings the library relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings that keep the plans good at any size. Partition counts are left to AQE:
# it starts from `initialPartitionNum` and merges down to about 128 MB each.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # A side whose files (or, at run time, whose rows) are larger than this is never broadcast.
    "spark.sql.autoBroadcastJoinThreshold": "64m",
}

_local_dirs: dict[str, str] = {}


def build_session(app_name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with :data:`RECOMMENDED_CONF`; keyword settings win over it."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_settings(spark: SparkSession) -> None:
    """Stamps are parsed through a session-zone timestamp and then lose their zone, so a zone with
    daylight saving would move the hours that do not exist in it. Bad numbers fail a load only
    under ANSI casts."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in {"UTC", "Etc/UTC", "Z", "GMT", "+00:00"}:
        raise ValueError(f"spark.sql.session.timeZone must be UTC to parse stamps; it is {zone!r}.")
    if spark.conf.get("spark.sql.ansi.enabled").lower() != "true":
        raise ValueError("spark.sql.ansi.enabled must be true, or bad numbers would become NULL.")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local master may run without it; it then gets a temporary folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if path:
        return path.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("Set spark.checkpoint.dir to a folder that all executors can reach.")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="tidemark-")
    return _local_dirs[context.applicationId]
