"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# UTC keeps zone-less timestamps and session time identical. The rest states Spark's own
# adaptive defaults, which the skew handling of the joins relies on.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def local_session(cores="8", app="chatterscope", memory="8g", partitions=None) -> SparkSession:
    """A session for tests and the bench. Clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    session = (
        builder.config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions or cores))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder the cluster sets in spark.checkpoint.dir.

    Only where that is unset (local tests) a folder of this machine is used.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="chatterscope-")
    return f"{root.rstrip('/')}/chatterscope/{name}-{uuid.uuid4().hex}"
