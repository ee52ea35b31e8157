"""Session settings and the shared working folder."""

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that results depend on (time zone) or that the plans rely on (adaptive execution).
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key's rows also where a later step could have used their partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Where every partition of one side turns out this small, hash it instead of sorting both sides.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A key repeated in a JSON answer: the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def build_session(app_name="postsift", master=None, settings=None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session that somebody else started."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for ``name`` below the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir``. Only a local session may go without it; a
    cluster session (``local-cluster`` too) without it is refused, since a machine-local folder is lost
    with its machine. Name a folder that all executors reach.
    """
    context = spark.sparkContext
    base = spark.conf.get(CHECKPOINT_SETTING, None) or context.getCheckpointDir()
    if not base:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="postsift-")
        context.setCheckpointDir(base)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    for made in _OPEN:
        made.append(path)
    return path


_OPEN: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession):
    """Remove the shared folders made inside, once the block is left.

    For whoever writes a final result: whatever was staged on the way to it goes with the block. A
    folder that must stay is named (``shared_dir``) before the block.
    """
    made: list[str] = []
    _OPEN.append(made)
    try:
        yield
    finally:
        _OPEN.pop()
        for path in made:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store; one that isn't there is no error."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Used where a costly step (keyword scan, scorer) feeds several results: each later read then
    loads only its own columns, and a lost executor never makes the step run again.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
