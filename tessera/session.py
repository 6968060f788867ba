"""Session helpers: building a local session for tests/bench, per-query
settings, and the shared work folder used to cut lineage.

On a cluster the session is built by the platform; we only *read* its
settings.  ``work_dir`` follows the rule: use the shared folder named by
``spark.checkpoint.dir``; only a local master may do without.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "tessera", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (the UI stays off)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.default.parallelism", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
        .config("spark.sql.cteRecursionLevelLimit", "1000")
        .config("spark.sql.cteRecursionRowLimit", "-1")
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings every query relies on (idempotent, runtime-settable only).

    * UTC session zone: naive timestamps are read as UTC, like the reference.
    * Recursive CTE limits lifted so deep trees (120+ levels) can be walked.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.cteRecursionLevelLimit", "1000")
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    return spark


_OWN: list[str] = []


def _local_folder(spark: SparkSession) -> str:
    """A folder of this machine, for local runs and tests only; removed at exit."""
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="tessera-work-"))
        atexit.register(shutil.rmtree, _OWN[0], ignore_errors=True)
    return _OWN[0]


def work_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh sub-folder of the shared checkpoint folder.

    The folder is the session's ``spark.checkpoint.dir``, or the one the
    context was given.  Without either, a local master gets a temporary
    folder, which is removed at exit; on a cluster that is an error, because
    executors would write to disks of their own."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or _local_folder(spark)
    return f"{base.rstrip('/')}/{name or 'work'}-{uuid.uuid4().hex[:12]}"


def spread(df, min_partitions: int | None = None):
    """Spread CPU-heavy per-row work over the cluster's cores.

    Only when a scan-only input has fewer partitions than the default
    parallelism (a small table in one file / row group) is it round-robin
    repartitioned; a large input, already split into many partitions, and
    any input that comes out of a shuffle are left untouched — no extra
    shuffle at scale, and no stage is executed just to count partitions."""
    spark = df.sparkSession
    target = min_partitions or spark.sparkContext.defaultParallelism
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
        if "Exchange" in plan or "Subquery" in plan:
            # partitioned by a shuffle already (sized by the shuffle settings);
            # asking the RDD for its partition count would make adaptive
            # execution run those shuffle stages once more, only to count
            return df
        n = df.rdd.getNumPartitions()          # scan-only plan: file splits, no job
    except Exception:  # noqa: BLE001 — e.g. Spark Connect: leave as is
        return df
    return df.repartition(target) if n < target else df


def broadcast_if_small(df, max_rows: int = 1_000_000, max_bytes: int = 32 * 1024 * 1024):
    """Broadcast hint only behind a checked bound: one job over at most
    ``max_rows + 1`` rows of ``df`` (a small key set such as run ids) counts
    them and sums their size (JSON text of each row, a close upper bound of
    the broadcast payload).  A side over either bound is returned unchanged
    and the planner / AQE decide."""
    from pyspark.sql import functions as F

    probe = df.limit(max_rows + 1).agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*df.columns)))), F.lit(0)).alias("b"))
    row = probe.first()
    return F.broadcast(df) if row["n"] <= max_rows and row["b"] <= max_bytes else df


def materialize(df, name: str = "stage"):
    """Write ``df`` once to the shared work folder and read it back.

    Cuts the lineage: later readers (several routes of one result, retries
    after a lost executor) read the files instead of recomputing — which
    matters when the upstream calls an external model.  Unlike ``cache`` it
    survives executor loss; ``localCheckpoint`` is never used."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def scale_settings(input_bytes: int, total_cores: int, partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Settings for a cluster run, derived from the input size.

    Shuffle partitions so that one partition is about ``partition_bytes``
    before AQE coalesces small ones; scan splits of the same size; skew-join
    splitting on; Arrow batches bounded for the Python stages (memory per
    batch, not per partition).  Apply them when building the cluster session."""
    parts = max(2 * total_cores, int(input_bytes // partition_bytes) + 1)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
        "spark.python.worker.reuse": "true",
        "spark.sql.session.timeZone": "UTC",
    }


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tessera`` importable in the executors' Python workers.

    The Python stages (``mapInPandas`` and friends) refer to this package's
    functions by module name.  A cluster normally ships it with
    ``--py-files``; when it was not shipped, the package is zipped once per
    application and added with ``addPyFile`` (Spark distributes the file).
    Nothing happens when the workers can already import it from their
    working directory (tests, the bench)."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 — Spark Connect: code is shipped as artifacts by the client
        return
    app = sc.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    if os.path.abspath(os.getcwd()) == root:
        return
    import zipfile

    # a code artifact built on the driver and handed to Spark's file server
    # (not data: nothing is read back from this folder by any task)
    zpath = os.path.join(tempfile.mkdtemp(prefix="tessera-code-"), "tessera.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
