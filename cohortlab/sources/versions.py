"""Tables whose updates are whole versions (S7, W8), and appends that may be
repeated (S6). Plain parquet folders that Spark reads and writes.

A versioned table is cut into buckets by its key. An update rewrites the buckets
that its keys fall in, as new folders, and then publishes the list of folders as
the next version by renaming one folder into place. Readers see a version or the
one before, never a part; untouched buckets keep their files. If another writer
has published that version meanwhile, the update is worked out again on it, so
of two writers that want the same row one finds it taken.

A batch of an append is one folder under its own name, renamed into place when
it is whole: the same batch again finds its folder and changes nothing, and a
batch that was cut off left nothing that readers look at.

Old versions' files stay until ``drop_versions``, for readers that still use them.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_path
from .tables import hadoop_path, path_exists

BUCKETS = 64
ATTEMPTS = 20


class Conflict(RuntimeError):
    """Other writers published first in every attempt."""


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, target = hadoop_path(spark, path)
    out = fs.create(target, False)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def _read_text(spark: SparkSession, path: str) -> str:
    fs, target = hadoop_path(spark, path)
    size = fs.getFileStatus(target).getLen()
    f = fs.open(target)
    try:
        return bytes(f.readNBytes(int(size))).decode("utf-8")
    finally:
        f.close()


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, target = hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def _put(spark: SparkSession, written: str, path: str) -> None:
    """Rename a folder to ``path``. On a path that is taken, stores either refuse
    or move the folder below it; the caller looks whose content is there."""
    fs, source = hadoop_path(spark, written)
    _, target = hadoop_path(spark, path)
    fs.mkdirs(target.getParent())
    if not fs.exists(target):
        fs.rename(source, target)


class VersionedTable:
    """A table at ``path``: ``versions/v<n>`` lists the folders of each bucket."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @classmethod
    def create(cls, df: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> VersionedTable:
        table = cls(df.sparkSession, path)
        folders = table._written(df, key, buckets)
        if not table._publish(0, {"key": key, "buckets": buckets, "schema": df.schema.jsonValue(), "folders": folders}):
            raise Conflict(f"{path} is a versioned table already")
        return table

    def latest(self) -> int:
        found = [int(m[1]) for m in (re.fullmatch(r"v(\d+)", n) for n in _names(self.spark, f"{self.path}/versions")) if m]
        if not found:
            raise FileNotFoundError(f"no versioned table at {self.path}")
        return max(found)

    def _state(self, version: int) -> dict:
        return json.loads(_read_text(self.spark, f"{self.path}/versions/v{version}/state.json"))

    def read(self, version: int | None = None) -> DataFrame:
        return self._rows(self._state(self.latest() if version is None else version))

    def _rows(self, state: dict, buckets: list[int] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(state["schema"])
        folders = [f for b, f in state["folders"].items() if buckets is None or int(b) in buckets]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def _written(self, df: DataFrame, key: str, buckets: int) -> dict[str, str]:
        """Write rows by bucket; the folder of each bucket that has some."""
        name = f"data/{uuid.uuid4().hex}"
        # a bucket's rows may come from several tasks, so that a hot key does not hold one up
        df.withColumn("__bucket", _bucket(key, buckets)).write.partitionBy("__bucket").parquet(f"{self.path}/{name}")
        return {n.split("=")[1]: f"{name}/{n}" for n in _names(self.spark, f"{self.path}/{name}") if n.startswith("__bucket=")}

    def _publish(self, version: int, state: dict) -> bool:
        """Whether this state has become the version."""
        token = uuid.uuid4().hex
        written = f"{self.path}/versions/.{token}"
        _write_text(self.spark, f"{written}/state.json", json.dumps(state | {"token": token}))
        place = f"{self.path}/versions/v{version}"
        _put(self.spark, written, place)
        return self._state(version)["token"] == token

    def update(self, keys: DataFrame, change: Callable[[DataFrame], DataFrame], attempts: int = ATTEMPTS) -> int:
        """Publish the table with the buckets of ``keys`` (a column named as the
        table's key) replaced by ``change(their rows)``, which must keep the
        columns and the keys. Returns the version. ``change`` is called again
        on newer rows if another writer was first."""
        for _ in range(attempts):
            version = self.latest()
            state = self._state(version)
            key, buckets = state["key"], state["buckets"]
            touched = sorted(r[0] for r in keys.select(_bucket(key, buckets)).distinct().collect())  # as many as buckets
            rows = change(self._rows(state, touched)).select(*T.StructType.fromJson(state["schema"]).names)
            folders = self._written(rows, key, buckets)
            if not set(map(int, folders)) <= set(touched):
                raise ValueError("an update must keep its rows' keys")
            kept = {b: f for b, f in state["folders"].items() if int(b) not in touched}
            if self._publish(version + 1, {k: state[k] for k in ("key", "buckets", "schema")} | {"folders": kept | folders}):
                return version + 1
        raise Conflict(f"{self.path}: {attempts} attempts were overtaken")

    def drop_versions(self, keep_from: int) -> None:
        """Remove versions before ``keep_from`` and the files that no later one uses."""
        versions = [v for v in range(self.latest() + 1) if path_exists(self.spark, f"{self.path}/versions/v{v}")]
        used = {f for v in versions if v >= keep_from for f in self._state(v)["folders"].values()}
        for v in versions:
            if v < keep_from:
                for f in set(self._state(v)["folders"].values()) - used:
                    drop_path(self.spark, f"{self.path}/{f}")
                drop_path(self.spark, f"{self.path}/versions/v{v}")


def _bucket(key: str, buckets: int):
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


# ------------------------------------------------------------------ appends

def append_batch(df: DataFrame, path: str, batch: str) -> bool:
    """Append a batch of rows once, however often it is tried; whether this call added it."""
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch):
        raise ValueError("a batch's name has letters, digits, '_', '.' and '-'")
    spark, place = df.sparkSession, f"{path.rstrip('/')}/batch={batch}"
    if path_exists(spark, place):
        return False
    written = f"{path.rstrip('/')}/.{uuid.uuid4().hex}"
    df.write.parquet(f"{written}/rows")
    token = uuid.uuid4().hex
    _write_text(spark, f"{written}/_token", token)
    _put(spark, written, place)
    return _read_text(spark, f"{place}/_token") == token


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all whole batches, with their batch's name as ``batch``."""
    names = [n for n in _names(spark, path) if n.startswith("batch=")]
    if not names:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("batch", T.StringType())]))
    rows = spark.read.schema(schema).parquet(*[f"{path.rstrip('/')}/{n}/rows" for n in names])
    return rows.withColumn("batch", F.regexp_extract(F.input_file_name(), r"/batch=([^/]+)/rows/", 1))
