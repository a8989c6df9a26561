"""Session settings that suit these jobs. Cluster size is left to the deployment."""

from collections.abc import Mapping

from pyspark.sql import SparkSession

SETTINGS = {
    # Re-plan at run time; above all, merge small shuffle partitions.
    "spark.sql.adaptive.enabled": "true",
    # The JVM does not compile methods beyond this size; run such plans unfused.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Snapshots and products of a stream's batch share the cores.
    "spark.scheduler.mode": "FAIR",
    # Load times are shown in UTC. Times in the data are zone-free text.
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str, extra: Mapping[str, str] | None = None) -> SparkSession:
    """A session with `SETTINGS`, which `extra` may override."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in (SETTINGS | dict(extra or {})).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
