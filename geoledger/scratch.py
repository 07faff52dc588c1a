"""Tables written on the way: they cut lineage and survive the loss of executors.

They go to the shared folder that the cluster names in ``spark.checkpoint.dir``. Only where that is unset and all runs
on one machine, as in tests, is a temporary folder made.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_tables: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="spark-geoledger-")
    return _own[app]


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete a written table; a missing one is no error."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _drop_at_exit(spark: SparkSession, path: str) -> None:
    try:
        drop_table(spark, path)
    except Exception:  # noqa: BLE001 - the session may be gone by then, and its folder with it
        return


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and return a DataFrame that reads it.

    The table's path is kept in the attribute ``written_to``, so that loops can drop old tables; the rest go when
    the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    _tables.append(path)
    atexit.register(_drop_at_exit, spark, path)
    return out


def drop_written(df: DataFrame) -> None:
    """Delete the table behind a DataFrame made by :func:`written`, when nothing lazy needs it any more."""
    path = getattr(df, "written_to", None)
    if path:
        drop_table(df.sparkSession, path)


def tables_so_far() -> int:
    """A mark for :func:`drop_written_since`."""
    return len(_tables)


def drop_written_since(mark: int, kept: DataFrame) -> None:
    """Delete the tables written since the mark, save the one behind ``kept``, when nothing lazy needs them any more."""
    for path in [p for p in _tables[mark:] if p != kept.written_to]:
        drop_table(kept.sparkSession, path)
        _tables.remove(path)
