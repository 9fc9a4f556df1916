"""Session helpers: configuration suited to the operators of this package.

On a cluster the session is created by the platform; :func:`tune` only
sets what is still unset.  Local runs (tests, bench) use
:func:`local_session`.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every plan in this package relies on.  AQE re-plans joins at
# run time from real sizes (broadcast only what is measured small, split
# skewed partitions); UTC pins DATE/TIMESTAMP conversions.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply package defaults where the session has no explicit value."""
    conf = spark.conf
    for key, value in _DEFAULTS.items():
        try:
            current = conf.get(key, None)
        except Exception:  # pragma: no cover - conf access can be restricted
            current = None
        if current is None:
            conf.set(key, value)
    # Time zone must be UTC for first-of-month keys to match file dates.
    conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "mensura") -> SparkSession:
    """A local session for tests and benchmarks (no UI, UTC, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("MENSURA_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="mensura-wh-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local session (tests, bench) may leave it unset: it then gets a
    scratch folder.  On a cluster an unset folder is an error, because files
    on one machine's disk cannot be read by the others.
    """
    global _LOCAL_CKPT
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        _LOCAL_CKPT = _LOCAL_CKPT or tempfile.mkdtemp(prefix="mensura-ckpt-")
        current = _LOCAL_CKPT
    sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


_LOCAL_CKPT = None


_MATERIALIZED: dict = {}
_PLAN_CACHES: list = []


def per_session(fn):
    """Memoise a ``(spark, sf_dir) -> DataFrame`` plan builder per session.

    Building a plan is driver-side work (every Column is a JVM call); plans
    are immutable, so gold queries that share an intermediate (an enriched
    fact, a summary) reuse one logical plan instead of rebuilding it.
    Calls with DataFrame arguments are not memoised.
    """
    import functools

    cache: dict = {}
    _PLAN_CACHES.append(cache)

    @functools.wraps(fn)
    def wrapper(spark, d, *args, **kwargs):
        if any(hasattr(a, "sparkSession") for a in list(args) + list(kwargs.values())):
            return fn(spark, d, *args, **kwargs)  # DataFrame arguments: build afresh
        try:
            key = (_RUN[0], spark.sparkContext.applicationId, d, args, tuple(sorted(kwargs.items())))
            hash(key)
        except TypeError:
            return fn(spark, d, *args, **kwargs)
        if key not in cache:
            cache[key] = fn(spark, d, *args, **kwargs)
        return cache[key]

    wrapper.uncached = fn
    return wrapper


_RUN = [""]


class separate_run:
    """Context in which plans and staged tables are rebuilt from the base
    tables instead of reused (an independent run B for the A/B check)."""

    def __init__(self, tag: str):
        self.tag, self.prev = tag, None

    def __enter__(self):
        self.prev, _RUN[0] = _RUN[0], self.tag
        return self

    def __exit__(self, *exc):
        _RUN[0] = self.prev
        return False


_FOLDERS: dict[str, list[str]] = {}


def remember(spark: SparkSession, path: str) -> str:
    """Note a folder that :func:`release` is to delete; returns the path."""
    _FOLDERS.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def keep(spark: SparkSession, path: str) -> None:
    """Take back :func:`remember`: the folder outlives the run."""
    own = _FOLDERS.get(spark.sparkContext.applicationId, [])
    if path in own:
        own.remove(path)


def release(spark: SparkSession) -> None:
    """Forget plans and delete staged tables of this application: call it when
    input files were rewritten, or when a run is over.  Published versions
    stay."""
    app = spark.sparkContext.applicationId
    for path in _FOLDERS.pop(app, []):
        delete_folder(spark, path)
    for cache in _PLAN_CACHES:
        for key in [k for k in cache if k[1] == app]:
            del cache[key]
    for key in [k for k in _MATERIALIZED if k[1] == app]:
        for _, _, path in _MATERIALIZED.pop(key):
            delete_folder(spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store Spark finds it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df):
    """Cut lineage of a small shared intermediate with a reliable checkpoint.

    Used where one derived (refined-layer) table, e.g. a monthly aggregate,
    feeds several branches of a plan: the expensive scan/join runs once, the
    files land in the shared ``spark.checkpoint.dir`` and survive executor
    loss.  Within a session a semantically identical plan is checkpointed
    only once (like a refined table written once per run and read by every
    gold query).
    """
    spark = df.sparkSession
    base = checkpoint_dir(spark)
    key = (_RUN[0], spark.sparkContext.applicationId, df.semanticHash())
    for plan, done, _ in _MATERIALIZED.get(key, []):
        if plan.sameSemantics(df):
            return done
    # A parquet table in the shared checkpoint folder: computed once (an RDD
    # checkpoint would compute the plan twice), columnar, pruned on re-read.
    import uuid

    path = f"{base.rstrip('/')}/mensura-tables/{uuid.uuid4().hex}"
    # The intermediates are aggregates: AQE already coalesces their final
    # shuffle to advisory-size partitions, so no extra rebalance shuffle.
    df.write.mode("overwrite").parquet(path)
    done = spark.read.parquet(path)
    _MATERIALIZED.setdefault(key, []).append((df, done, path))
    return done
