"""Session helpers: one place for the SQL settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

# Settings every plan in this package assumes.  All are runtime SQL confs, so
# they can be applied to a session somebody else built.
SESSION_CONF = {
    # Timestamps are UTC end to end (the reference mixed zones, SURVEY D3).
    "spark.sql.session.timeZone": "UTC",
    # Parquet timestamps written without a zone are read as TIMESTAMP (not
    # TIMESTAMP_NTZ) so filters on them still reach the scan.
    "spark.sql.parquet.inferTimestampNTZ.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A generated method over 8,000 bytes is never compiled by the JVM; beyond that Spark's
    # split projections are faster (entities of forty fields: more than twice).
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`SESSION_CONF` to an existing session (idempotent)."""
    for key, value in SESSION_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, app_name: str = "dealwise",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; locally the
    UI stays off and the shuffle width follows the core count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false") \
                     .config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SESSION_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


_LOCAL_CKPT: str | None = None


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster has to name a shared folder there; only a local session without the setting,
    as in tests, gets one of its own under the local temp dir.
    """
    global _LOCAL_CKPT
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        if _LOCAL_CKPT is None:
            _LOCAL_CKPT = tempfile.mkdtemp(prefix="dealwise-ckpt-")
        path = _LOCAL_CKPT
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    return os.path.join(checkpoint_dir(spark), name)


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``dealwise`` importable in Python workers (data sources, pandas UDFs).

    The package is zipped once per driver process and added with
    ``addPyFile``, Spark's standard way to ship Python code to executors.
    """
    import zipfile
    sc = spark.sparkContext
    if id(sc) in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    fd, zpath = tempfile.mkstemp(prefix="dealwise-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(zpath, "w") as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(zpath)
    _SHIPPED.add(id(sc))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on the cluster file system (any Hadoop scheme).

    Asking the file system avoids provoking a failed query just to learn that
    a table is not there yet.
    """
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """Write one small text file (table metadata) on the cluster file system."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_small(spark: SparkSession, path: str) -> str | None:
    """The text written by :func:`write_small`, or None."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def stored(df, name: str):
    """Write ``df`` once to the shared checkpoint folder and read it back: cuts the lineage
    in a way that survives lost executors.  The files stay until that folder is cleared."""
    path = scratch_path(df.sparkSession, f"stored/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def one_row(spark: SparkSession, values, schema: str):
    """A frame of one row in one partition, made by Spark from literals (run logs, watermarks)."""
    from pyspark.sql import functions as F
    fields = StructType.fromDDL(schema).fields
    return spark.range(0, 1, 1, 1).select(*[F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(fields, values, strict=True)])


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that this package wrote (staged batches)."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; empty if there is no such folder."""
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path``."""
    fs, p = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength())


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file unless ``target`` exists; whether it was renamed.

    The rename of Hadoop's FileContext refuses an existing name, as the commit of
    Spark's own streaming logs needs it.
    """
    from py4j.protocol import Py4JJavaError
    sc = spark.sparkContext
    fs, src = _fs(spark, source)
    src, dst = fs.makeQualified(src), fs.makeQualified(_fs(spark, target)[1])
    kind = getattr(sc._jvm.org.apache.hadoop.fs, "Options$Rename")
    no_options = sc._gateway.new_array(kind, 0)
    context = sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(dst.toUri(), sc._jsc.hadoopConfiguration())
    try:
        context.rename(src, dst, no_options)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True
