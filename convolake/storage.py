"""Where lineage is cut: a table written to the folder that all executors share."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Temporary folders by application, for local sessions that name no shared one; applications whose tables go at the end.
_OWN: dict[str, str] = {}
_KEPT: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir; a temporary folder only where none is named on a local master (tests, one machine)."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _OWN:
            _OWN[app] = tempfile.mkdtemp(prefix="convolake-")
            atexit.register(shutil.rmtree, _OWN[app], ignore_errors=True)
        named = f"file://{_OWN[app]}"
    return named.rstrip("/")


def _delete(jvm, conf, path: str) -> None:
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(conf).delete(place, True)


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a path, if it is there."""
    _delete(spark._jvm, spark._jsc.hadoopConfiguration(), path)


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _leave(jvm, conf, folder: str) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone
        _delete(jvm, conf, folder)


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the application's own folder, which goes when the driver's Python ends: results that are read later need it."""
    folder = f"{shared_dir(spark)}/convolake-{spark.sparkContext.applicationId}"
    if folder not in _KEPT:
        _KEPT.add(folder)
        atexit.register(_leave, spark._jvm, spark._jsc.hadoopConfiguration(), folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "t") -> DataFrame:
    """df, written and read again: later steps start from files, also after executors are lost."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def drop_stored(df: DataFrame) -> None:
    """Deletes what stored() wrote for df."""
    delete(df.sparkSession, df.stored_path)


def bucketed(df: DataFrame, keys: list[str], buckets: int | None = None, name: str = "t") -> DataFrame:
    """df, written as a table that is bucketed and sorted by keys: joins on exactly these keys read it where it lies, without a shuffle.

    As many buckets as the session's shuffles have partitions, unless given: then the other side of a join is dealt to them.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table, path = f"{name}_{uuid.uuid4().hex}", new_path(spark, name)
    # Dealt out as buckets are, so each bucket is one file.
    df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    out = spark.table(table)
    out.stored_path, out.stored_table = path, table
    return out


def drop_bucketed(df: DataFrame) -> None:
    """Deletes what bucketed() wrote for df."""
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {df.stored_table}")
    drop_stored(df)
