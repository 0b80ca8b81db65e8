"""Shared plumbing of the training-data operators."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SHIPPED: dict[int, str] = {}


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package (the same as ``--py-files``), once a session."""
    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="newsfunnel-py-"), "newsfunnel_llm.zip")
    with zipfile.ZipFile(path, "w") as z:
        for d, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(d, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED[key] = path


def give_back() -> None:
    """Return freed memory to the system: workers are reused, and what one stage has freed counts against the next."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


_HELD: dict[str, dict] = {}


def held(owner: str) -> dict:
    """What an operator keeps in a worker between tasks."""
    return _HELD.setdefault(owner, {})


def forget_others(owner: str) -> None:
    """Workers serve all operators of a session: tables of others go when a task of another begins."""
    for other in [o for o in _HELD if o != owner]:
        del _HELD[other]


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | Iterator[pa.RecordBatch]],
                schema: T.StructType | str, owner: str = "") -> DataFrame:
    """``fn`` over Arrow batches; ``fn`` may also be a generator of batches.

    ``owner`` names the tables (``held``) that stay in the worker between tasks.
    """
    ship(df.sparkSession)

    def run(batches):
        forget_others(owner)
        give_back()
        for b in batches:
            out = fn(b)
            if isinstance(out, pa.RecordBatch):
                yield out
            else:
                yield from out
            del b, out
            give_back()

    return df.mapInArrow(run, schema)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have yet (case is ignored, as in Spark)."""
    have = {c.lower() for c in df.columns}
    name, k = base, 0
    while name.lower() in have:
        k += 1
        name = f"{base}_{k}"
    return name


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns that an operator is about to add (case is ignored):
    its result replaces them, as ``withColumn`` would."""
    drop = {n.lower() for n in names if n}
    clash = [c for c in df.columns if c.lower() in drop]
    return df.drop(*clash) if clash else df


def text_arrays(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets (from 0) of a string column; a null counts as ''."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    data = np.frombuffer(col.buffers()[2], np.uint8) if len(col) and col.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def text_offsets(col: pa.Array) -> np.ndarray:
    """Byte offsets of a string column; the text is not copied."""
    wide = pa.types.is_large_string(col.type)
    if not wide and not pa.types.is_string(col.type):
        return text_arrays(col)[1]
    return np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1]


def int_lists(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A list column from flat values and the length of each list."""
    offs = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offs[1:])
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(flat))


def documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    return df.select(*cols) if cols else df


def sha256_ints(ids) -> F.Column:
    """Lower-case hex SHA-256 of an int list written with one space between the numbers."""
    return F.sha2(F.concat_ws(" ", ids.cast("array<string>")).cast("binary"), 256)


def slices(batch: pa.RecordBatch, col: str, max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Row slices of a batch whose text takes about ``max_bytes`` at most (a longer text is alone)."""
    n = batch.num_rows
    if not n:
        return
    offs = text_offsets(batch.column(batch.schema.get_field_index(col)))
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offs, offs[at] + max_bytes, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def literal_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A short table of numbers and letters written into the plan itself: no Python worker makes its rows."""
    names = [f.split()[0] for f in schema.split(",")]
    types = [f.split()[1] for f in schema.split(",")]
    said = ", ".join("(" + ", ".join(f"cast('{v}' as {t})" for v, t in zip(r, types)) + ")" for r in rows)
    return spark.sql(f"select * from values {said} as t({', '.join(names)})")


def bit_marks(bits: DataFrame, size: int) -> np.ndarray:
    """Bitmap (bytes, low bit first) of ``size`` bits with those of column ``bit`` set.

    Folded on the executors; size / 64 numbers reach the driver at most, however
    many rows there are.
    """
    words = (bits.select(F.shiftright("bit", 6).alias("w"), F.expr("shiftleft(1L, cast(bit & 63 as int))").alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow())
    out = np.zeros(size // 64, np.uint64)
    if words.num_rows:
        out[words.column("w").to_numpy()] = words.column("b").to_numpy().view(np.uint64)
    return out.view(np.uint8)


def marked(marks: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which bits are set."""
    return (marks[bits >> 3] >> (bits & 7) & 1).astype(bool)
