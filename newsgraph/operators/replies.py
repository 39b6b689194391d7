"""Store of model replies that tasks write as they go.

A store is a folder in the shared file system.  Prompts are keyed by a hash;
a task handles one range of key prefixes (a *part* of ``n``) and adds small
Parquet files, named by the part, whenever a number of replies has come or
some seconds have passed.  A file appears under its name only when it is
complete, so a killed task leaves whole files behind: its next attempt reads
them and sends only the prompts that are not there.  A repeated key (two
attempts of one task at the same time) is read once."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REPLY = "prompt_key string, reply string, error string"
FLUSH_REPLIES, FLUSH_SECONDS = 50, 20.0
_SCHEMA = pa.schema([("prompt_key", pa.string()), ("reply", pa.string()), ("error", pa.string())])


@dataclass(frozen=True)
class ReplyStore:
    uri: str


def store_uri(spark: SparkSession, path: str) -> str:
    """``path`` as Spark's own file system names it, so that tasks write
    where Spark reads."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()).makeQualified(p).toString()


def key_part(key: str, parts: int) -> int:
    """The part of a key: an equal share of the range of its first 32 bits."""
    return int(key[:8], 16) * parts >> 32


def key_part_column(key: str, parts: int) -> Column:
    return F.shiftright(F.conv(F.substring(key, 1, 8), 16, 10).cast("long") * F.lit(parts), 32).cast("int")


def stored_replies(spark: SparkSession, store: ReplyStore) -> DataFrame:
    """(prompt_key, reply, error) of all stored replies, each key once."""
    try:
        found = spark.read.schema(REPLY).parquet(store.uri)
    except AnalysisException as ex:
        if ex.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], REPLY)
    return found.dropDuplicates(["prompt_key"])


class ReplyPart:
    """One part of a store, in the task that handles it."""

    def __init__(self, store: ReplyStore, part: int, parts: int):
        from pyarrow import fs

        self.fs, root = fs.FileSystem.from_uri(store.uri)
        self.folder, self.name = root.rstrip("/"), f"part-{part}-of-{parts}-"
        self.fs.create_dir(self.folder, recursive=True)
        self.known: dict[str, str | None] = {}
        for f in self.fs.get_file_info(fs.FileSelector(self.folder)):
            if f.base_name.startswith(self.name):
                t = pq.read_table(f.path, filesystem=self.fs, partitioning=None, columns=["prompt_key", "reply"])
                self.known.update(zip(t.column(0).to_pylist(), t.column(1).to_pylist()))
        self.held: list[tuple[str, str | None]] = []
        self.at = time.monotonic()

    def add(self, key: str, reply: str | None) -> None:
        self.held.append((key, reply))
        if len(self.held) >= FLUSH_REPLIES or time.monotonic() - self.at >= FLUSH_SECONDS:
            self.flush()

    def flush(self) -> None:
        if self.held:
            keys, replies = zip(*self.held)
            name = f"{self.name}{uuid.uuid4().hex}.parquet"
            pq.write_table(pa.table([keys, replies, [None] * len(keys)], schema=_SCHEMA), f"{self.folder}/_{name}", filesystem=self.fs)
            self.fs.move(f"{self.folder}/_{name}", f"{self.folder}/{name}")
        self.held, self.at = [], time.monotonic()
