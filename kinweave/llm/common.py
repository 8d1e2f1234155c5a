"""Helpers shared by the training-data operators."""
from __future__ import annotations

import ctypes
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but ASCII white space.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORD_SQL = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


KINDS = {"long": pa.int64(), "int": pa.int32(), "short": pa.int16(), "string": pa.string(), "boolean": pa.bool_(), "double": pa.float64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64())}


def arrow_schema(schema: str) -> pa.Schema:
    return pa.schema([(n, KINDS[t]) for n, t in (c.split() for c in schema.split(", "))])


def as_batch(columns, schema: pa.Schema) -> pa.RecordBatch:
    """A batch of columns in the order of schema; Arrow columns are taken as they are, so that no id becomes a float."""
    arrays = []
    for c, f in zip(columns, schema):
        c = c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
        arrays.append((c if c.type == f.type else c.cast(f.type)) if isinstance(c, pa.Array) else pa.array(c, type=f.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


_KEPT: dict = {}


def kept(key, make: Callable):
    """What make gives, remembered by this worker for later tasks with the same key; a worker remembers one thing."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def trim() -> None:
    """Give memory that is free in this worker back to the machine; the C library and Arrow keep it otherwise."""
    pa.default_memory_pool().release_unused()
    if f := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc's
        f(0)


def release() -> None:
    """Free what the worker remembers, where a task needs the memory for its own."""
    _KEPT.clear()
    trim()


#: Bytes of rows that Spark hands a worker at once; by its default only their number is bounded, however long their texts.
BATCH_BYTES = 4 << 20


def map_batches(df: DataFrame, f: Callable, schema) -> DataFrame:
    """mapInArrow over batches of about BATCH_BYTES at most, as worker and executor hold them whole.

    The bound is set for the session, and stays; one that it has already is kept.
    """
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(key, None) is None:
        conf.set(key, str(BATCH_BYTES))
    return df.mapInArrow(f, schema)


def slices(batches, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many rows, so that lists of long texts do not fill a worker's memory."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
        trim()


def per_batch(df: DataFrame, f: Callable, schema: str, rows: int = 256) -> DataFrame:
    """The columns that f gives for each slice of rows; f takes a record batch."""
    def run(batches):
        release()
        kinds = arrow_schema(schema)
        for b in slices(batches, rows):
            yield as_batch(f(b), kinds)

    return map_batches(df, run, schema)


def hash_words(words: list[str]) -> np.ndarray:
    """Deterministic 64-bit hashes of words."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    return pd.util.hash_array(np.array(words, dtype=object), categorize=False)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every bit depends on all others."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """One hash for each run of n word hashes, dependent on order."""
    if len(h) < n:
        return np.zeros(0, dtype=np.uint64)
    m = len(h) - n + 1
    out = np.zeros(m, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i:i + m])
    return out


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that spark.checkpoint.dir names; without one, only a local master may use its own disk."""
    base = spark.sparkContext._jsc.sc().getCheckpointDir()
    path = base.get() if base.isDefined() else spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = "/tmp/kinweave-checkpoints"  # one machine, as in tests
    return f"{path.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, held: list | None = None) -> DataFrame:
    """Cut lineage: write to the shared folder and read again; `held` gets the path, for `drop`."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    if held is not None:
        held.append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, paths: list) -> None:
    """Delete tables that nothing reads any more."""
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    paths.clear()


def clean_words(col):
    """Lower-cased runs of letters and digits, as an array column."""
    return F.regexp_extract_all(F.lower(F.coalesce(col, F.lit(""))), F.lit(r"[\p{L}\p{M}\p{N}]+"), F.lit(0))
