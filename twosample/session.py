"""Session helpers: configuration the operators are designed around, and the
shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the plans rely on: AQE re-plans joins against per-key tables at
# runtime (broadcast when the measured side is small, skew-split otherwise)
# and coalesces the many small shuffle partitions of one-row-per-key tables.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "twosample", extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (UI off)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g")
         .config("spark.ui.showConsoleProgress", "false"))
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str | None:
    """The shared folder named by ``spark.checkpoint.dir``; ``fallback`` is
    applied only when the session has none (tests)."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d and fallback:
        spark.conf.set("spark.checkpoint.dir", fallback)
        spark.sparkContext.setCheckpointDir(fallback)
        d = fallback
    elif d:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for tables a query writes and reads back: under the
    shared ``spark.checkpoint.dir``, or the warehouse, which is shared too."""
    import uuid
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/twosample/{name}-{uuid.uuid4().hex}"
