"""A table kept in hash buckets: a batch of changes rewrites the buckets that it touches, and nothing else.

    <table>/data/<batch>-<attempt>/b=<bucket>/*.parquet     what one attempt at one batch wrote
    <table>/manifest/<batch>.json                           for each bucket the folder that holds it, and the columns

A manifest appears by one rename, so readers see the table before or after a batch.  A batch whose manifest is there is not applied
again; one that failed before it leaves a folder that no manifest names, which the next batches collect.  Column types follow
the first batch, and columns that come later are null in buckets that were written before.

The driver holds one short entry for each bucket (their number is a parameter of the table), never rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.operators import materialize as M
from changeloom.sources.shared import checkpointed, shared_folder

#: Manifests that stay readable behind the newest one.
KEEP = 2


class Folder:
    """A folder on whatever file system its path names."""

    def __init__(self, spark: SparkSession, path: str):
        self.hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self.path = path.rstrip("/")
        self.fs = self.hadoop.Path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self.hadoop.Path(f"{self.path}/{name}")

    def names(self, name: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.at(name))) if self.fs.exists(self.at(name)) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> bool:
        """Writes a file under another name and renames it; false if the name was taken."""
        draft = f"{name}.{uuid.uuid4().hex}"
        stream = self.fs.create(self.at(draft))
        stream.write(bytearray(text.encode()))
        stream.close()
        done = not self.fs.exists(self.at(name)) and self.fs.rename(self.at(draft), self.at(name))
        if not done:
            self.drop(draft)
        return done

    def drop(self, name: str) -> None:
        self.fs.delete(self.at(name), True)


class BucketTable:
    """A table by key in ``buckets`` buckets, at ``path``."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = 1024):
        self.spark, self.folder, self.keys, self.buckets = spark, Folder(spark, path), keys, buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def batches(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.folder.names("manifest") if n.endswith(".json"))

    def manifest(self, batch: int | None = None) -> dict:
        """``batch, buckets (number -> folder), schema`` of the newest batch, or of a given one."""
        done = self.batches()
        if not done:
            return {"batch": -1, "buckets": {}, "schema": None}
        return json.loads(self.folder.read(f"manifest/{done[-1] if batch is None else batch}.json"))

    def _read(self, manifest: dict, buckets: list[int] | None = None) -> DataFrame | None:
        if manifest["schema"] is None:
            return None
        schema = T.StructType.fromJson(manifest["schema"])
        named = manifest["buckets"] if buckets is None else {str(b): manifest["buckets"][str(b)] for b in buckets if str(b) in manifest["buckets"]}
        if not named:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.folder.path}/data/{where}/b={b}" for b, where in sorted(named.items())])

    def read(self, batch: int | None = None) -> DataFrame | None:
        """The table after the newest batch, or after one of the last ``KEEP``; None before the first."""
        return self._read(self.manifest(batch))

    def read_keys(self, wanted: DataFrame) -> DataFrame | None:
        """The rows whose key is among ``wanted``, from their buckets alone."""
        hit = [r[0] for r in wanted.select(self.bucket()).distinct().collect()]
        table = self._read(self.manifest(), hit)
        return None if table is None else table.join(wanted.select(*self.keys), self.keys, "left_semi")

    def apply(self, batch: DataFrame, number: int, delete_enabled: bool = True) -> bool:
        """Applies the last change of each key; false if the batch (or a later one) is in the table already."""
        old = self.manifest()
        if number <= old["batch"]:
            return False
        changes = M.last_change(batch if delete_enabled else batch.where("op <> 'd'"), self.keys).withColumn("_b", self.bucket()).persist()  # read for the buckets and again for the rows
        where = f"{number}-{uuid.uuid4().hex}"
        # at most one number a bucket
        touched = sorted(r[0] for r in changes.select("_b").distinct().collect())
        base = self._read(old, touched)
        fields = batch.schema["after"].dataType
        have = {} if base is None else {f.name.lower(): f for f in base.schema}
        new = [f for f in fields if f.name.lower() not in have]
        columns = ([] if base is None else base.schema.fields) + new
        after = {f.name.lower(): F.col(f"after.{f.name}") for f in fields}
        value = lambda f: (after.get(f.name.lower(), F.lit(None)).cast(f.dataType)).alias(f.name)
        fresh = changes.where("op <> 'd'").select("_b", *[value(f) for f in columns])
        if base is None:
            out = fresh
        else:
            kept = base.withColumn("_b", self.bucket()).join(changes.select("_b", *self.keys), ["_b", *self.keys], "left_anti")
            out = fresh.unionByName(kept, allowMissingColumns=True)
        # small buckets share a task and a large one is split by AQE, which a repartition by "b" would forbid
        out.withColumnRenamed("_b", "b").hint("rebalance", "b").write.partitionBy("b").parquet(f"{self.folder.path}/data/{where}")
        changes.unpersist()
        written = {int(n[2:]) for n in self.folder.names(f"data/{where}") if n.startswith("b=")}
        buckets = {b: w for b, w in old["buckets"].items() if int(b) not in touched} | {str(b): where for b in sorted(written)}
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in columns])
        self.folder.fs.mkdirs(self.folder.at("manifest"))
        done = self.folder.publish(f"manifest/{number}.json", json.dumps({"batch": number, "buckets": buckets, "schema": schema.jsonValue()}))
        self.collect()
        return done

    def collect(self) -> list[str]:
        """Removes manifests beyond the last ``KEEP``, and folders of finished batches that no manifest names."""
        done = self.batches()
        for n in done[: -KEEP or None]:
            self.folder.drop(f"manifest/{n}.json")
        kept = done[-KEEP:]
        used = {w for n in kept for w in self.manifest(n)["buckets"].values()}
        # a folder of a later batch may belong to an attempt that is at work
        gone = [w for w in self.folder.names("data") if w not in used and kept and int(w.split("-")[0]) <= kept[-1]]
        for w in gone:
            self.folder.drop(f"data/{w}")
        return gone

    def sink(self, delete_enabled: bool = True) -> Callable[[DataFrame, int], None]:
        """A ``foreachBatch`` function."""
        return lambda batch, number: None if self.apply(batch, number, delete_enabled) else None
