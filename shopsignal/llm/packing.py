"""Best-fit-decreasing packing of token sequences.

Documents are encoded, given an end id and, where longer than a sequence, cut into pieces of
full length (the last may be shorter). Best fit decreasing takes the pieces by falling length and puts
each into the open sequence that it fills best; only lengths matter to it, so the driver plans
from the histogram of lengths, which has at most ``capacity`` entries whatever the input. A
segment tree over the remaining capacities finds the tightest open sequence in logarithmic
time; sequences with equal room and pieces of equal length are handled as runs, as the rule
would do one after the other (a sequence that was the tightest stays so while the next piece
of that length still fits). The plan is a list of runs, whose number depends on the
capacity alone. Executors turn a piece's rank among those of its length into its place.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopsignal.llm.common import lean, whole_text, written
from shopsignal.llm.encode import encoder

CAPACITY = 4096
END_ID = 1


class RoomTree:
    """Segment tree over remaining capacities: is any sequence open with that much room?"""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.size)
        self.runs: dict[int, list[tuple[int, int]]] = {}  # room -> runs of sequences (first, number)

    def add(self, room: int, first: int, number: int) -> None:
        self.runs.setdefault(room, []).append((first, number))
        self._mark(room, True)

    def _mark(self, room: int, value: bool) -> None:
        i = room + self.size
        self.any[i] = value
        while i > 1:
            i //= 2
            self.any[i] = self.any[2 * i] or self.any[2 * i + 1]

    def tightest(self, length: int) -> int | None:
        """The smallest room of at least ``length`` with an open sequence."""
        i = length + self.size
        while not self.any[i]:
            while i & 1:  # right child: go up to where a right neighbour exists
                i //= 2
            if i == 0:
                return None
            i += 1
        while i < self.size:
            i = 2 * i if self.any[2 * i] else 2 * i + 1
        return i - self.size

    def take(self, room: int) -> tuple[int, int]:
        run = self.runs[room].pop()
        if not self.runs[room]:
            self._mark(room, False)
        return run


def plan(lengths: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit decreasing over {length: number}; rows (length, rank, number, sequence, each, offset).

    ``number`` pieces from ``rank`` on go to the sequences from ``sequence`` on, ``each`` in
    every one, from ``offset`` on.
    """
    tree, out, opened = RoomTree(capacity), [], 0
    for length in sorted(lengths, reverse=True):
        rank, left = 0, lengths[length]
        while left:
            room = tree.tightest(length)
            first, number = (opened, -(-left // (capacity // length))) if room is None else tree.take(room)
            if room is None:
                room, opened = capacity, opened + number
            each = room // length
            full = min(number, left // each)
            if full:
                out.append((length, rank, full * each, first, each, capacity - room))
                rank, left = rank + full * each, left - full * each
                if room - each * length:
                    tree.add(room - each * length, first, full)
                first, number = first + full, number - full
            if number and left:  # fewer than ``each`` are left: they go to one sequence
                out.append((length, rank, left, first, each, capacity - room))
                tree.add(room - left * length, first, 1)
                rank, left, first, number = rank + left, 0, first + 1, number - 1
            if number:
                tree.add(room, first, number)
    return out


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
           with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encoded pieces: doc_id, piece, start, length, ids_crc32, (ids,) task, rank within the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, task, seen = encoder(tokenizer), TaskContext.get().partitionId(), {}
        for b in lean(batches):
            rows = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "task", "rank")}
            kept, docs_of, at = [], b.column(0).to_pylist(), 0
            for group in enc.batches(b.column(1).to_pylist()):
                for doc, ids in zip(docs_of[at:], group):
                    ids = np.append(ids, np.uint32(end_id))
                    for i, start in enumerate(range(0, len(ids), capacity)):
                        cut = ids[start:start + capacity]
                        n = len(cut)
                        seen[n] = seen.get(n, -1) + 1
                        for k, v in zip(rows, (doc, i, start, n, zlib.crc32(cut), task, seen[n])):
                            rows[k].append(v)
                        if with_ids:
                            kept.append(cut.astype(np.int32))
                at += len(group)
            types = dict.fromkeys(rows, pa.int64()) | {"piece": pa.int32(), "task": pa.int32()}
            columns = {k: pa.array(v, types[k]) for k, v in rows.items()}
            if with_ids:
                columns["ids"] = pa.array(kept, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, task int, rank long"
                           + ", ids array<int>" * with_ids)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
         with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    One row per piece: doc_id, piece, start (tokens of the document before it), length,
    ids_crc32, sequence_id, offset in the sequence (gapless from 0), and with ``with_ids`` the
    ids themselves. Null and empty texts are one piece, the end id. Rows with equal or null ids
    are packed each by itself. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    # numbered once and written: ranks must not change when a lost task is run again
    p = written(pieces(docs, tokenizer, capacity, end_id, with_ids, id_col, text_col), "pieces")
    held = written(p.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "lengths")
    total = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = held.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    steps = spark.createDataFrame(
        plan(total, capacity), "length long, first long, number long, sequence long, each long, at long")
    # the plan as one sorted array per length: at most ``capacity`` rows
    steps = steps.groupBy("length").agg(F.sort_array(F.collect_list(
        F.struct("first", "number", "sequence", "each", "at"))).alias("steps"))
    ranked = (p.join(F.broadcast(base) if held.count() <= 500_000 else base, ["length", "task"])
              .withColumn("nth", F.col("rank") + F.col("base")))
    placed = ranked.join(F.broadcast(steps), "length").withColumn("s", F.expr(
        "filter(steps, s -> s.first <= nth and nth < s.first + s.number)[0]"))
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.expr("s.sequence + (nth - s.first) div s.each").alias("sequence_id"),
        F.expr("s.at + (nth - s.first) % s.each * length").alias("offset"),
        *(["ids"] if with_ids else []))


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves (``pack(..., with_ids=True)``): sequence_id, ids.

    A sequence has at most ``capacity`` tokens, so each group is small.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
