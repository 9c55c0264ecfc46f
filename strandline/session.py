"""What the library needs of a session."""

from __future__ import annotations

import os
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers find this package where it lies beside the driver's copy.

    On a cluster the package is installed, or sent with ``--py-files``; the added path is then of no effect.
    """
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    return spark


#: Bytes of shuffled data that a task is given at most when partitions are joined to larger ones.  Packed rows unfold to 10 to 20 times that
#: in the hash tables of an aggregation or a sort.
ADVISED = "8m"
#: Bytes of stored tables that a task reads at most.  A sending task holds all of its rows where an exchange has more than 200 partitions, or their
#: groups where it adds them up; stored columns unfold to about 6 times that.
READ = "32m"
#: What opening a file counts for in these: as in the defaults, a 32nd.  Four times that left 8 small files to a task.
OPEN = "1m"


def small_tasks(spark: SparkSession) -> SparkSession:
    """Let a task's memory not grow to what the defaults of 64 MB shuffled or 128 MB read unfold to; a size that the session names itself stays."""
    known = spark.conf.getAll
    for key, most in (("spark.sql.adaptive.advisoryPartitionSizeInBytes", ADVISED), ("spark.sql.files.maxPartitionBytes", READ), ("spark.sql.files.openCostInBytes", OPEN)):
        if key not in known:
            spark.conf.set(key, most)
    return spark


#: Bytes of stored input for which exchanges start with one more partition: queries send up to about twice their input through one exchange.
INPUT_A_PART = 4 << 20
#: Partitions that an exchange starts with at most (80 GB of input); beyond, tasks grow with the input and spill.
MOST_PARTS = 20_000


def stored_bytes(spark: SparkSession, path: str) -> int:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()


def enough_parts(spark: SparkSession, size: int) -> SparkSession:
    """Let exchanges start with as many partitions as an input of size bytes needs, so that none is larger than what small_tasks allows.

    Adaptive execution only joins partitions: where their number is fixed, each grows with the input.  There are never fewer than the session's
    shuffle partitions, and a number of initial partitions that the session names itself stays.
    """
    key, own = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.strandline.initialPartitionNum"
    known = spark.conf.getAll
    if known.get(key) == known.get(own):  # none yet, or that of an earlier query
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(-(-size // INPUT_A_PART), MOST_PARTS))
        spark.conf.set(key, str(parts))
        spark.conf.set(own, str(parts))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Only where they are one process (``local``) may the session name none: a temporary folder is then taken, one for a session.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or getattr(spark, "_strandline_folder", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":  # local-cluster has executors of its own
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = spark._strandline_folder = tempfile.mkdtemp(prefix="strandline-")
    return base.rstrip("/")
