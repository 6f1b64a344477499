"""One log of reserved ids per table, for batch loads and streams alike (W2, S8, ST1).

Beside a table lies a folder of versions ``v-0000000001``, ... Each version
holds every topic's reserved maximum before and after one load (one row per
topic) and, in ``_load``, whose load it is. A load writes the next version
into a folder of its own and renames it into place. The rename is atomic and
fails where another load was first, which then starts again from the other's
version; a version is never changed. Ids are reserved before rows are
written, so a failure in between leaves ids unused or, where the load has a
name, for its next try: a named load that comes again gets the ids that it had.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "topic string, base long, max_id long"


def is_absent(error: AnalysisException) -> bool:
    """Whether a read failed because nothing was written there yet; any other
    failure (storage, permissions) must reach the caller."""
    return error.getCondition() == "PATH_NOT_FOUND"


def log_path(table: str) -> str:
    return table.rstrip("/") + "_ids"


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _name(version: int) -> str:
    return f"v-{version:010d}"


def last_version(spark: SparkSession, table: str) -> int:
    """The newest version, 0 where there is none."""
    files, folder = _file_system(spark, log_path(table))
    if not files.exists(folder):
        return 0
    names = [x.getPath().getName() for x in files.listStatus(folder)]
    return max((int(n[2:]) for n in names if n.startswith("v-")), default=0)


def _load_of(spark: SparkSession, table: str, version: int) -> dict:
    if version == 0:
        return {"named": {}}
    files, path = _file_system(spark, f"{log_path(table)}/{_name(version)}/_load")
    stream = files.open(path)
    try:
        text = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    return json.loads(text)


def _version(spark: SparkSession, table: str, version: int) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(f"{log_path(table)}/{_name(version)}")


def reserved(spark: SparkSession, table: str) -> DataFrame | None:
    """(topic, max_id) of the newest version, or None where no load has reserved yet."""
    last = last_version(spark, table)
    return _version(spark, table, last).select("topic", "max_id") if last else None


def named_loads(spark: SparkSession, table: str) -> dict[str, list[int]]:
    """For each name: the number of its newest load, and the version of that."""
    return _load_of(spark, table, last_version(spark, table))["named"]


def _committed(spark: SparkSession, source: str, target: str) -> bool:
    """Rename ``source`` to ``target``, unless that is there."""
    files, src = _file_system(spark, source)
    _, dst = _file_system(spark, target)
    src, dst = files.makeQualified(src), files.makeQualified(dst)
    jvm = spark._jvm
    none = spark._sc._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(src.toUri(), spark._jsc.hadoopConfiguration()).rename(src, dst, none)
    except Exception as e:  # noqa: BLE001  told apart by what the file system says
        if "FileAlreadyExistsException" in str(e) or files.exists(dst):
            return False
        raise
    return True


def reserve(spark: SparkSession, table: str, counts: DataFrame, seed, name: str | None = None, number: int = 0) -> DataFrame:
    """Reserve ``counts`` (topic, n) ids; returns (topic, max_id) as before them.

    ``seed`` gives (topic, max_id) of a table without a log (called only
    then). ``name`` and ``number`` make the load repeatable: the newest number
    of a name gets its ids again, an older one is refused."""
    while True:
        last = last_version(spark, table)
        named = _load_of(spark, table, last)["named"]
        if name in named:
            newest, version = named[name]
            if number == newest:
                return _version(spark, table, version).filter("base IS NOT NULL").select("topic", F.col("base").alias("max_id"))
            if number < newest:
                raise ValueError(f"load {number} of {name} is older than its load {newest}, whose ids are reserved")
        base = _version(spark, table, last).select("topic", "max_id") if last else seed()
        new = (base.select("topic", F.col("max_id").alias("base")).join(counts.select("topic", "n"), "topic", "full_outer")
                   .select("topic", "base", (F.coalesce("base", F.lit(0)) + F.coalesce("n", F.lit(0))).cast("long").alias("max_id")))
        folder = f"{log_path(table)}/_new-{uuid.uuid4().hex}"
        new.write.parquet(folder)
        if name is not None:
            named[name] = [number, last + 1]
        files, path = _file_system(spark, folder + "/_load")
        out = files.create(path, False)
        try:
            out.write(bytearray(json.dumps({"named": named}).encode()))
        finally:
            out.close()
        if _committed(spark, folder, f"{log_path(table)}/{_name(last + 1)}"):
            return _version(spark, table, last + 1).filter("base IS NOT NULL").select("topic", F.col("base").alias("max_id"))
