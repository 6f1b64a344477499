"""Written intermediate tables, in the shared folder that the cluster names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from topicspark.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage: what is lost with an executor is read again from the
    shared folder, not computed again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def set_aside(docs: DataFrame, used: tuple[str, ...]) -> DataFrame:
    """``docs`` with every column but those ``used`` under a name given by its place.

    An operator's own columns then clash with none of the input. Taking the
    places in order and ``toDF(*docs.columns)`` gives the first names back.
    """
    return docs.toDF(*[c if c in used else f"extra{at}" for at, c in enumerate(docs.columns)])


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _release() -> None:
    """Give the memory that Arrow and numpy keep for later use back to the system, where the C library can."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def releasing(run):
    """``run`` over a task's batches, then what it took is given back: a Python worker lives on into later stages."""
    def batches(*args):
        yield from run(*args)
        _release()
    return batches


def releasing_group(run):
    """The same for a function of one group."""
    def group(rows):
        out = run(rows)
        _release()
        return out
    return group


def releasing_pair(run):
    """The same for a function of a pair of groups."""
    def pair(left, right):
        out = run(left, right)
        _release()
        return out
    return pair


_SHIPPED: set[str] = set()
#: Bounds of an Arrow batch: whole texts go through Python workers, so a batch holds few.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20


def ship(spark: SparkSession) -> None:
    """Give the executors this package, where it is not installed there (once per application)."""
    import os
    import tempfile
    import zipfile

    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000") == "10000":  # Spark's own default
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="llm-package-"), "llm_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for package in ("llm", "topicspark"):
            for folder, _, names in os.walk(os.path.join(root, package)):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, root))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)
