"""Helpers shared by the operators: shared-folder tables, checked joins, streamed groups.

Nothing here holds data of the corpus on the driver: the driver sees paths, counts and
tables whose size is bounded by a parameter.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsignal.session import ensure_checkpoint_dir
from shopsignal.sources.tables import table_path

#: Rows a side may have to be broadcast; above it a join is shuffled.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


#: Rows and bytes handed to Python at a time: whole texts are long, and a task holds a few such batches.
ARROW_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
               "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def ship_package(spark: SparkSession) -> None:
    """Prepare a session for Python over whole texts: bounded Arrow batches, and this package on the executors.

    Batch sizes named at launch are kept. The package is sent unless the workers' module path
    already has it, as submitting it with --py-files would: the driver packs the sources once
    per context and Spark distributes the archive.
    """
    import shopsignal

    launch = spark.sparkContext.getConf()
    for k, v in ARROW_BATCH.items():
        if not launch.contains(k):
            spark.conf.set(k, v)
    sc, root = spark.sparkContext, os.path.dirname(os.path.dirname(os.path.abspath(shopsignal.__file__)))
    if getattr(sc, "_shopsignal_sent", False) or root in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    place = tempfile.mkdtemp(prefix="shopsignal-src-")
    sc.addPyFile(shutil.make_archive(os.path.join(place, "shopsignal"), "zip", root, "shopsignal"))
    sc._shopsignal_sent = True


def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, with memory that earlier ones have freed given back to the system.

    A Python worker outlives its task, and allocators keep what whole texts have needed: without
    this, idle workers and the next stage share an executor's memory with it.
    """
    import ctypes

    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    for b in batches:
        yield b
        del b
        pa.default_memory_pool().release_unused()
        if trim is not None:
            trim(0)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: every reader sees the same rows, and a lost executor re-reads files
    instead of recomputing (or renumbering) them.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_text(col: str = "text") -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def text_blocks(text: str | bytes, size: int, run) -> list[tuple[int, int]]:
    """Cut a text into spans of about ``size`` characters; each is extended over what the compiled
    pattern ``run`` matches at its end, so that no run is cut. An empty text is one empty span."""
    spans, at = [], 0
    while at < len(text) or not spans:
        end = run.match(text, min(len(text), at + size)).end()
        spans.append((at, end))
        at = end
    return spans


def record(df: DataFrame, name: str = "rec") -> Column:
    """All columns of ``df`` as one struct: the caller's columns cannot clash with an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)


def unpack(df: DataFrame, columns: list[str], name: str = "rec") -> DataFrame:
    return df.select(*[F.col(f"{name}.`{c}`").alias(c) for c in columns])


def join_checked(big: DataFrame, small: DataFrame, keys: list[str], how: str = "inner",
                 bound: int = BROADCAST_ROWS) -> DataFrame:
    """Join a written ``small`` side: broadcast if it has at most ``bound`` rows, else shuffled."""
    return big.join(F.broadcast(small) if small.count() <= bound else small, keys, how)


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str) -> DataFrame:
    """Inner join of written ``rows`` with one row per group, where a group may hold most rows.

    ``size`` is the column of ``groups`` with the group's number of rows. At most 1,000 groups
    can hold a thousandth of all rows or more; these are broadcast, so that no task gets a hot
    group. All other groups are shuffled by key and hold less than a thousandth each.
    """
    cut = max(1000, rows.count() // 1000)
    hot, cold = groups.where(F.col(size) >= cut), groups.where(F.col(size) < cut)
    if not hot.take(1):
        return rows.join(cold, keys)
    warm = rows.join(F.broadcast(hot), keys)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys)
    return warm.unionByName(rest)


def whole_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Cut a partition that is sorted by ``keys`` into tables of whole groups.

    Yields (table, starts): ``starts`` are the row numbers at which groups begin, followed by
    the number of rows. Only the group that crosses a batch is carried over, so memory holds
    one batch and one group; callers bound the size of their groups.
    """
    carry: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        starts = _starts(batch, keys)
        if carry and not _same(carry[-1], batch, keys):
            yield _table(carry, keys)
            carry = []
        if len(starts) == 1:
            carry.append(batch)
            continue
        yield _table([*carry, batch.slice(0, starts[-1])], keys)
        carry = [batch.slice(starts[-1])]
    if carry:
        yield _table(carry, keys)


def _table(batches: list[pa.RecordBatch], keys: list[str]) -> tuple[pa.Table, np.ndarray]:
    t = pa.Table.from_batches(batches).combine_chunks()
    return t, np.append(_starts(t, keys), t.num_rows)


def _starts(t, keys: list[str]) -> np.ndarray:
    change = np.zeros(t.num_rows, bool)
    change[0] = True
    for k in keys:
        v = t.column(k).to_numpy(zero_copy_only=False) if isinstance(t, pa.RecordBatch) else t.column(k).to_numpy()
        change[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(change)


def _same(a: pa.RecordBatch, b: pa.RecordBatch, keys: list[str]) -> bool:
    return all(a.column(k)[a.num_rows - 1].as_py() == b.column(k)[0].as_py() for k in keys)
