"""Session helpers.

Library functions never create a session; they take DataFrames. ``get_session`` is for scripts,
tests and the benchmark. Lineage is cut with tables written into the folder named by
``spark.checkpoint.dir``, which all executors share; a private folder is only made for a local master that
names none.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Settings a cluster job of this library expects. AQE re-plans joins at run time from the real
# size of each shuffle stage (broadcast below the threshold, sort-merge beyond it) and splits
# skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "feedmart", shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a private one only when none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if sc.master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="feedmart-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder beside the checkpoints (shared storage on a cluster) for staged tables."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/feedmart-scratch/{name}-{uuid.uuid4().hex[:12]}"


# The innermost scope of the running thread; a thread started with a copy of the context (contextvars.copy_context) shares it.
_scope: ContextVar[list[str] | None] = ContextVar("feedmart-scratch-scope", default=None)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the scratch folder and read it back: lineage is cut, later uses see the same
    rows, and the planner knows the real size. Inside ``scratch_scope`` the table goes at its end."""
    path = scratch_path(df.sparkSession, name)
    scope = _scope.get()
    if scope is not None:
        scope.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``materialise``, and the number of rows, counted while they are written."""
    seen = Observation()
    rows = materialise(df.observe(seen, F.count(F.lit(1)).alias("n")), name)
    return rows, seen.get["n"]


@contextmanager
def scratch_scope(spark: SparkSession):
    """Tables that ``materialise`` writes inside the block, by this thread, are deleted when it ends. Scopes of other threads stay apart."""
    paths: list[str] = []
    token = _scope.set(paths)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in paths:
            delete_path(spark, path)


_classes: dict[int, tuple] = {}  # of one JVM: finding a class by its name takes several calls


def _hadoop(spark: SparkSession) -> tuple:
    """Hadoop's Path, FileUtil and FileContext, a function that joins an array's elements by line feeds, and the configuration."""
    gateway = spark.sparkContext._gateway
    if id(gateway) not in _classes:
        jvm = spark._jvm
        fs, wrap = jvm.org.apache.hadoop.fs, jvm.scala.Predef.genericWrapArray
        _classes.clear()
        _classes[id(gateway)] = (fs.Path, fs.FileUtil, fs.FileContext, lambda array: wrap(array).mkString("\n"), jvm.org.apache.hadoop.fs.Options.Rename)
    return *_classes[id(gateway)], spark._jsc.hadoopConfiguration()


def _fs(spark: SparkSession, path: str):
    hadoop = _hadoop(spark)
    p = hadoop[0](path)
    return p.getFileSystem(hadoop[-1]), p


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder (none if it doesn't exist)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    _, util, _, joined, *_ = _hadoop(spark)
    found = joined(util.stat2Paths(fs.listStatus(p)))  # one call for all names
    return sorted(x.rsplit("/", 1)[-1] for x in found.split("\n")) if found else []


def create_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file that must not exist yet: under another name first, then renamed, so it is never seen in part."""
    fs, p = _fs(spark, path)
    path_class, _, context, _, options, conf = _hadoop(spark)
    part = path_class(f"{path}.{uuid.uuid4().hex[:8]}.part")
    out = fs.create(part, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    try:
        files = context.getFileContext(fs.getUri(), conf)
        none = spark.sparkContext._gateway.new_array(options, 0)
        files.rename(part, p, none)  # refuses a name that is taken
    except Exception:
        fs.delete(part, False)
        raise


def read_files(spark: SparkSession, paths: list[str]) -> list[str]:
    """Texts of small files."""
    texts = []
    for path in paths:
        fs, p = _fs(spark, path)
        stream = fs.open(p)
        try:
            texts.append(bytes(stream.readAllBytes()).decode("utf-8"))
        finally:
            stream.close()
    return texts


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


__all__ = ["DEFAULT_CONF", "child_names", "create_file", "delete_path", "ensure_checkpoint_dir", "get_session", "materialise", "materialise_counted",
           "path_exists", "read_files", "scratch_path", "scratch_scope", "shuffle_partitions"]
