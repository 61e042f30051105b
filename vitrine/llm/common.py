"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Number of words of a text as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(text, UPPER, LOWER)


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus


def doc_key(doc_id: Column, text: Column) -> Column:
    """128 bits of id and text, by which an operator finds a row again."""
    return F.unhex(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("\0"), F.coalesce(text, F.lit("")))))


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from spark.checkpoint.dir; a temporary one only in local mode."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="vitrine-")
    atexit.register(shutil.rmtree, path, True)
    spark.conf.set("spark.checkpoint.dir", path)
    return path


#: While a table is written: shuffle files go when it is done, and Python gets texts and sets in small batches.
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}
_left: dict[str, SparkSession] = {}


def materialize(df: DataFrame, tag: str, compression: str = "zstd") -> DataFrame:
    """Writes df to the shared folder and reads it back: later steps survive lost executors without computing it again.

    The shuffle files of the write go when it is done. The table goes with discard, or else when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/vitrine/{tag}-{uuid.uuid4().hex}"
    before = {k: spark.conf.get(k, None) for k in WRITING}
    try:
        for k, v in WRITING.items():
            spark.conf.set(k, v)
        df.write.option("compression", compression).parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    _left[path] = spark
    out = spark.read.schema(df.schema).parquet(path)
    out.vitrine_path = path
    return out


def _delete(path: str) -> None:
    spark = _left.pop(path)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jvm.org.apache.hadoop.conf.Configuration()).delete(where, True)


def discard(*tables: DataFrame) -> None:
    """Deletes tables made by materialize that no later step reads."""
    for t in tables:
        if getattr(t, "vitrine_path", None) in _left:
            _delete(t.vitrine_path)


@atexit.register
def _discard_all() -> None:
    for path in list(_left):
        with contextlib.suppress(Exception):  # the JVM may be gone
            _delete(path)


def drop_clashing(df: DataFrame, *names: str) -> DataFrame:
    """df without those of its own columns that an operator is about to add."""
    return df.drop(*[n for n in names if n in df.columns])
