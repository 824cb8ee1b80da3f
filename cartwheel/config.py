"""Session settings and the shared scratch folder.

All settings here are public Spark configuration keys.  The ones that change
results are the UTC session time zone (timestamps are parsed and printed in
UTC) and, for the trending stream only, the per-operator watermark rule set in
``cartwheel.streaming.trending``.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of this library wants.  AQE re-plans joins at run
# time from the measured size of each shuffle: that measurement is the size
# check behind every broadcast (static planning would trust compressed file
# sizes, which under-state the in-memory size).  Above the threshold the join
# stays a sort-merge join, and AQE splits skewed partitions of it.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def sizing_conf(
    input_bytes: int,
    total_cores: int,
    shuffle_share: float = 0.3,
    target_partition_bytes: int = 200 << 20,
) -> dict[str, str]:
    """Partition sizing for an input of ``input_bytes`` on ``total_cores``.

    The largest shuffle (the de-duplication of the projected events) carries
    about ``shuffle_share`` of the raw JSON; shuffle partitions are sized so
    each holds about 200 MB of it, at least two per core.  AQE then coalesces the partitions of the smaller
    shuffles.  Scan splits of 256 MB suit the JSON landing folder; small
    rolled files are packed together by a raised open cost.
    """
    shuffle_bytes = int(input_bytes * shuffle_share)
    partitions = max(2 * total_cores, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.files.openCostInBytes": str(8 << 20),
    }


def build_session(
    master: str | None = None,
    app_name: str = "cartwheel",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    input_bytes: int | None = None,
    total_cores: int | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    ``master`` is only set when given: on a cluster the submitter decides.
    With ``input_bytes`` and ``total_cores`` the partition sizing comes from
    ``sizing_conf``; ``shuffle_partitions`` and ``extra`` override it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if input_bytes and total_cores:
        conf.update(sizing_conf(input_bytes, total_cores))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by whoever runs the job (a folder every
    executor and the driver can see); without it a run on a cluster is an
    error, because a local folder differs from machine to machine.  Only with
    a ``local`` master a private folder is created and registered, so that
    ``DataFrame.checkpoint()`` and this library's scratch tables work.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="cartwheel-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def shared_dir(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared checkpoint folder (never a node-local temp dir).

    ``unique=True`` appends a fresh random component, so a run never reuses a
    previous run's files.
    """
    pieces = [checkpoint_root(spark), "cartwheel", *parts]
    if unique:
        pieces.append(uuid.uuid4().hex[:12])
    # writers create missing folders themselves, on any file system
    return "/".join(p.strip("/") if i else p for i, p in enumerate(pieces))


def job_dir(spark: SparkSession, job: str) -> str:
    """A scratch path of one run's own for its intermediate tables.  Runs with
    the same input and output may overlap: neither reads the other's files."""
    return shared_dir(spark, job, unique=True)


def remove_dir(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder made by ``shared_dir`` once nothing reads it."""
    if not path.startswith(shared_dir(spark) + "/"):
        raise ValueError(f"not a scratch folder of this library: {path}")
    delete_path(spark, path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder on whatever file system it is; a missing one is
    no error."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
