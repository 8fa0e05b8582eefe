"""Helpers that several training-data operators share."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Runs of anything but space, tab, LF, VT, FF and CR are words.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of the data folder, through Spark's own reader (any file system)."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, named in ``spark.checkpoint.dir``.

    Where that is unset, a session that runs on this machine alone gets a temporary folder; on a cluster it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        jsc = spark.sparkContext._jsc.sc()
        if jsc.getCheckpointDir().isEmpty():
            if not re.match(r"local(\[|$)", spark.sparkContext.master):
                raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="changeloom-"))
        named = jsc.getCheckpointDir().get()
    return named.rstrip("/")


#: Rows of narrow tables that one task and one file hold, about, where the number of rows is known.
FILE_ROWS = 100_000


def gathered(df: DataFrame, rows: int | None) -> DataFrame:
    """``df`` (narrow, with at most ``rows`` rows) in no more partitions than these fill."""
    return df if rows is None else df.coalesce(max(1, -(-rows // FILE_ROWS)))


def checkpointed(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` cut from its lineage by a reliable checkpoint in the shared folder; ``rows`` is a known bound of its rows."""
    shared_dir(df.sparkSession)
    return gathered(df, rows).checkpoint(eager=True)


def stored(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` written to the shared folder as Parquet and read again (columns can then be pruned)."""
    path = f"{shared_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    gathered(df, rows).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def identified(docs: DataFrame, key: str = "doc_id") -> tuple[DataFrame, int | None]:
    """``docs`` with ``row_id``, unique by row, and the largest key (null: ``row_id`` is the key in every row).

    Rows without a key, or whose key stands in other rows too, get a number of their own above all keys.
    """
    per = docs.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    top, none, most = per.agg(F.max(key), F.max(F.col(key).isNull()), F.max(F.when(F.col(key).isNotNull(), F.col("_n")))).first()
    if not none and (most or 0) <= 1:
        return docs.withColumn("row_id", F.col(key)), None
    top = -1 if top is None else top
    again = small_side(checkpointed(per.where(F.col(key).isNotNull() & (F.col("_n") > 1)).select(key)))
    odd = docs.where(F.col(key).isNull()).unionByName(docs.join(again, key, "left_semi"))
    numbered = stored(odd.withColumn("row_id", F.monotonically_increasing_id() + F.lit(top + 1)))
    return docs.where(F.col(key).isNotNull()).join(again, key, "left_anti").withColumn("row_id", F.col(key)).unionByName(numbered), top


def crc32_of(col: str | Column) -> Column:
    """crc32 of a value written as text (null: of the empty text)."""
    col = F.col(col) if isinstance(col, str) else col
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary"))


def unit_hash(*parts: Column) -> Column:
    """A reproducible number in (0, 1) made from the 52 leading bits of an MD5; SQL engines agree on it."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def word_count(col: str | Column) -> Column:
    """Number of words of a text (null: 0), without Python."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


_forget = None


def alone(forget) -> None:
    """Makes an operator the only one that remembers something in this worker; ``forget`` (or None) drops what it remembers.

    Workers outlive a stage: without this the caches of all stages of a pipeline add up in each of them.
    """
    global _forget
    if forget != _forget:
        last, _forget = _forget, forget
        if last is not None:
            last()
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc keeps freed memory otherwise
                trim(0)


#: Rows with all their columns leave a worker in batches of about so many bytes.
PART_BYTES = 1 << 20


def kept_by(docs: DataFrame, column: str, maker) -> DataFrame:
    """The rows of ``docs``, with all their columns, for whose ``column`` a test is true; ``maker()`` makes the test in each task.

    A batch is answered in parts, so that neither the worker nor the JVM holds a second whole one.
    """
    at = docs.columns.index(column)

    def run(batches):
        test = maker()
        for batch in batches:
            rows = max(1, batch.num_rows * PART_BYTES // max(1, batch.nbytes))
            for k in range(0, batch.num_rows, rows):
                part = batch.slice(k, rows)
                yield part.filter(pa.array([test(v.as_py()) for v in part.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


#: Rows up to which a narrow table (some numbers and a name a row) may be broadcast.
BROADCAST_ROWS = 50_000


def small_side(df: DataFrame) -> DataFrame:
    """``df`` (narrow, already materialized) marked for broadcast if it is small; beyond that joins shuffle and AQE splits skew."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df
