"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# windowGroupLimitThreshold: largest top-n for which tasks trim a ranked window before
# the shuffle; the newest-10,000 report needs more than the default of 1,000 if its
# cut-off hour alone holds very many rows.
# hugeMethodLimit: the JVM never compiles methods beyond 8,000 bytes of code, so a wide
# projection (cleaning 15 columns) is faster when Spark splits it up instead.
RUNTIME_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.optimizer.windowGroupLimitThreshold": "20000",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

_SHUFFLE_BYTES_PER_PARTITION = 256 * 1024 * 1024


def tune(spark: SparkSession, shuffle_bytes: int | None = None) -> SparkSession:
    """Set the SQL settings this package counts on, keeping any the user chose.

    ``shuffle_bytes`` is the expected size of the largest shuffle. Adaptive
    execution merges small partitions but never splits evenly large ones, so the
    starting number has to fit the data.
    """
    chosen = spark.conf.getAll
    for key, value in RUNTIME_DEFAULTS.items():
        if key not in chosen:
            spark.conf.set(key, value)
    if shuffle_bytes:
        wanted = max(8, -(-shuffle_bytes // _SHUFFLE_BYTES_PER_PARTITION))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wanted))
    return spark


def build_session(
    app_name: str = "perennial",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name).config("spark.sql.session.timeZone", "UTC")
    if master:
        builder = builder.master(master)
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the shared folder that ``spark.checkpoint.dir`` names.

    Only a local session may fall back to a temporary folder: on a cluster the
    other machines would not see it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="perennial-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame, sized_like: DataFrame | None = None) -> DataFrame:
    """Deal rows out over all cores if the input has fewer partitions than there are.

    For work that is heavy per row, such as parsing: a file with one row group is read
    by one task, and everything up to the first shuffle stays in it. Large tables have
    more partitions than cores and pass unchanged. A stream is ``sized_like`` the table
    it reads.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    sized = df if sized_like is None else sized_like
    return df if sized.rdd.getNumPartitions() >= cores else df.repartition(cores)
