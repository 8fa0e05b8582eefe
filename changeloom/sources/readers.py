"""Where change events come from and go to: files, JDBC, JSON streams; sinks for batches and streams."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changeloom.operators import materialize as M
from changeloom.sources.buckets import BucketTable


def table(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None, **options) -> DataFrame:
    """A table in any format that Spark reads (parquet, orc, json, csv)."""
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


def with_row_id(rows: DataFrame, size: int = 1024) -> DataFrame:
    """A Parquet table without a key, by physical row: ``row_file`` and ``row_index`` order it, ``row_chunk`` numbers a file's chunks.

    They are the scan's own metadata, so nothing is shuffled, and ``after_key(["row_file", "row_index"], last)`` reads on.
    """
    row = F.col("_metadata.row_index")
    return rows.select("*", F.col("_metadata.file_path").alias("row_file"), row.alias("row_index"), F.floor(row / size).alias("row_chunk"))


def jdbc(spark: SparkSession, url: str, dbtable: str, predicates: list[str] | None = None, **properties) -> DataFrame:
    """A database table; ``predicates`` (chunk bounds) make one partition each."""
    return spark.read.jdbc(url, dbtable, predicates=predicates, properties=properties) if predicates else spark.read.jdbc(url, dbtable, properties=properties)


def chunk_predicates(key: str, bounds: list, most) -> list[str]:
    """``[lower, upper)`` ranges for parallel reads; the last one includes the largest key."""
    v = sql_literal
    if not bounds:
        return [f"{key} <= {v(most)}"]
    inner = [f"{key} >= {v(a)} AND {key} < {v(b)}" for a, b in zip(bounds, bounds[1:])]
    return [f"{key} < {v(bounds[0])}", *inner, f"{key} >= {v(bounds[-1])} AND {key} <= {v(most)}"]


def sql_literal(value) -> str:
    """A value as standard SQL."""
    if value is None or isinstance(value, bool):
        return {None: "NULL", True: "TRUE", False: "FALSE"}[value]
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, (bytes, bytearray)):
        return f"X'{bytes(value).hex()}'"
    return str(value) if isinstance(value, (int, float, Decimal)) else "'" + str(value).replace("'", "''") + "'"


def stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    """A folder of change files as a stream; ``max_files`` a trigger is the back-pressure."""
    reader = spark.readStream.format(fmt).schema(schema)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).load(path)


def upsert_sink(path: str, keys: list[str], spark: SparkSession, delete_enabled: bool = True, buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that keeps a table folder current: only the buckets that a batch touches are rewritten, and a replay changes nothing."""
    return BucketTable(spark, path, keys, buckets).sink(delete_enabled)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Batches after which a table folder can be read."""
    return BucketTable(spark, path, []).batches()


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """A table folder after its newest batch."""
    return BucketTable(spark, path, []).read()


def document_sink(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes each batch's last documents by key as JSON; deletes are marked."""

    def write(batch: DataFrame, number: int) -> None:
        last = M.last_change(batch, ["key"])
        last.select("key", (F.col("op") == "d").alias("deleted"), F.to_json("after").alias("document")).write.mode("overwrite").json(f"{path}/batch={number}")

    return write


@dataclass
class Engine:
    """A capture run put together step by step: source, transforms, consumer.

    ``Engine(spark).source(df).transform(f).notifying(consumer).run()`` gives the batch; a streaming source
    gives a query whose checkpoint holds the offsets.
    """

    spark: SparkSession
    df: DataFrame | None = None
    steps: list[Callable[[DataFrame], DataFrame]] = field(default_factory=list)
    consumer: Callable[[DataFrame, int], None] | None = None

    def source(self, df: DataFrame) -> Engine:
        self.df = df
        return self

    def transform(self, f: Callable[..., DataFrame], *args, when: str | None = None, **kw) -> Engine:
        """Adds a transform; ``when`` gates it by a SQL condition (other rows pass unchanged)."""
        if when is None:
            self.steps.append(lambda d: f(d, *args, **kw))
        else:
            test = f"coalesce({when}, false)"
            self.steps.append(lambda d: f(d.where(test), *args, **kw).unionByName(d.where(f"not {test}"), allowMissingColumns=True))
        return self

    def notifying(self, consumer: Callable[[DataFrame, int], None]) -> Engine:
        self.consumer = consumer
        return self

    def build(self) -> DataFrame:
        out = self.df
        for f in self.steps:
            out = out.transform(f)
        return out

    def run(self, checkpoint: str | None = None) -> DataFrame | StreamingQuery:
        out = self.build()
        if out.isStreaming:
            return out.writeStream.foreachBatch(self.consumer).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        if self.consumer:
            self.consumer(out, 0)
        return out
