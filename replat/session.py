"""Session settings a full run relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution picks join sides by measured size and splits hot join partitions. Forcing the split
# matters for the chain of joins on the parcel key: by default Spark keeps a hot partition whole when a
# later join could reuse its layout.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings; sizes (memory, partitions, thresholds) stay the deployment's."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark
