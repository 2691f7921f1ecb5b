"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Names the folder in a session whose cluster sets none, as in tests.
OWN_DIR = "spark.granary.scratch.dir"
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # The JVM does not compile methods above 8000 bytes of code.  A projection that cleans dozens of
    # cells gets larger as one fused loop, and is faster as separate methods that are compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
_staged: list[list[str]] = []


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, warehouse: str | None = None) -> SparkSession:
    """A session for tests and benches; on a cluster the submitted session is used as it is."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config(map={"spark.sql.warehouse.dir": warehouse} if warehouse else {})
        .appName("granary")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config(map=SETTINGS)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return use_own_scratch(spark)


def use_own_scratch(spark: SparkSession) -> SparkSession:
    """Give a local session a scratch folder of its own if none is set."""
    local = spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"
    if local and not (spark.conf.get(CHECKPOINT_DIR, None) or spark.conf.get(OWN_DIR, None)):
        spark.conf.set(OWN_DIR, tempfile.mkdtemp(prefix="granary-"))
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared folder that the session names; an error if it names none."""
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.conf.get(OWN_DIR, None)
    if not root:
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    return f"{root.rstrip('/')}/granary/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    The written files cut the lineage, so what follows survives lost executors and never
    re-reads the raw input; several consumers share one computation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    if _staged:
        _staged[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staged_folders(spark: SparkSession) -> Iterator[None]:
    """Delete what is staged inside the block when it ends, also by an error.

    For jobs whose results are written tables or driver rows; frames that read staged folders must not
    leave the block.
    """
    _staged.append([])
    try:
        yield
    finally:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for path in _staged.pop():
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)


def cleans_staged(job: Callable) -> Callable:
    """A job whose first argument is the session, run inside :func:`staged_folders`."""

    @wraps(job)
    def run(spark: SparkSession, *args, **options):
        with staged_folders(spark):
            return job(spark, *args, **options)

    return run
