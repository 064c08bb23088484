"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def local_session(app: str = "ratewell", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and single-machine runs; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


@lru_cache(maxsize=1)
def _local_root() -> str:
    root = tempfile.mkdtemp(prefix="ratewell-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session names it.

    Only a local session that names none falls back to a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_root()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def drop_dir(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def side_by_side(jobs: Sequence[Callable], most: int = 4) -> list:
    """Results of independent pieces of work whose Spark jobs run at the same time."""
    spark = SparkSession.active()
    with ThreadPoolExecutor(most) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]]
