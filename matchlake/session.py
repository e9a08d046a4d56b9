"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
# Settings the plans are written for; any of them may be overridden per cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rebalanced writes and coalesced shuffles aim at this size, so it also sets
    # the size of the published files.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.compression.codec": "zstd",
    # HotSpot does not compile methods beyond this size; wider generated stages run faster
    # as separate operators than interpreted.
    METHOD_LIMIT: "8000",
    # Where files are cut must not depend on the cores a scan finds: see the CSV scan.
    "spark.sql.files.minPartitionNum": "64",
    "spark.ui.enabled": "false",
}
_LOCAL_SCRATCH: dict[str, str] = {}


def build_session(app: str, master: str | None = None, **overrides: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def compiled_methods(spark: SparkSession) -> None:
    """Let Spark split what HotSpot would not compile, in sessions that are not made here.

    Spark's own limit lets generated methods of up to 65,535 bytes through, which then run
    interpreted. A limit that was set stays.
    """
    if spark.conf.get(METHOD_LIMIT, None) is None:
        spark.conf.set(METHOD_LIMIT, SETTINGS[METHOD_LIMIT])


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused folder name under the cluster's shared checkpoint folder.

    Only a local session without that setting falls back to a machine-local folder.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if context.applicationId not in _LOCAL_SCRATCH:
            _LOCAL_SCRATCH[context.applicationId] = tempfile.mkdtemp(prefix="matchlake-")
        base = _LOCAL_SCRATCH[context.applicationId]
    return f"{base.rstrip('/')}/matchlake/{label}-{uuid.uuid4().hex}"
