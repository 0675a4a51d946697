"""Token-id files: one concatenated id array per block, document boundaries in Elias-Fano code.

A block holds whole documents in ascending id order, about ``block_tokens`` ids together:

    shard, block   place in the order of the file
    n_docs, n_tokens
    doc_ids        array<long>, one per document
    width          bytes of an id (2 if the vocabulary fits, else 4)
    ids            the ids of all documents, little-endian, one after the other
    low_bits, low, high, ranks
                   Elias-Fano code of the documents' end offsets within the block

For n ends below u, each end's lowest floor(log2(u / n)) bits are stored as they are and the
rest in unary, n * (2 + log2(u / n)) bits in all, where 64-bit offsets would take 64 n. ``ranks``
counts the ones before every 512 bits of ``high`` (32-bit numbers), which lets ``select`` find
any document's end without decoding those before it.

The blocks are rows of a Spark table, so that any store that Spark writes will do, lost
executors leave no half file, and no task writes to a folder of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopsignal.llm.common import lean, whole_text
from shopsignal.llm.encode import encoder

BLOCK_TOKENS = 1 << 20
_SPAN = 512  # bits of ``high`` per entry of ``ranks``

BLOCK_SCHEMA = ("shard int, block int, n_docs int, n_tokens long, doc_ids array<long>, width int, ids binary, "
                "low_bits int, low binary, high binary, ranks binary")


class EliasFano:
    """Non-decreasing numbers in near-minimal space, with random access by ``select``."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, ranks: bytes):
        self.n, self.low_bits = n, low_bits
        self.low = np.frombuffer(low, np.uint8)
        self.high = np.frombuffer(high, np.uint8)
        self.ranks = np.frombuffer(ranks, "<u4")

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        bits = (values[:, None] >> np.arange(low_bits)) & 1
        high = np.zeros(-(-(n + (top >> low_bits) + 1) // _SPAN) * _SPAN, np.uint8)
        high[(values >> low_bits) + np.arange(n)] = 1
        ones = high.reshape(-1, _SPAN).sum(1, dtype=np.int64)
        ranks = (np.cumsum(ones) - ones).astype("<u4")
        return cls(n, low_bits, np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes(),
                   np.packbits(high, bitorder="little").tobytes(), ranks.tobytes())

    def select(self, index) -> np.ndarray:
        """The values at the given places."""
        i = np.atleast_1d(np.asarray(index, np.int64))
        out = np.empty(len(i), np.int64)
        for a in range(0, len(i), 4096):  # bounds the unpacked bits
            j = i[a:a + 4096]
            span = np.searchsorted(self.ranks, j, side="right") - 1
            bits = np.unpackbits(self.high.reshape(-1, _SPAN // 8)[span], axis=1, bitorder="little")
            within = j - self.ranks[span] + 1
            place = np.argmax(np.cumsum(bits, axis=1, dtype=np.uint16) == within[:, None], axis=1)
            v = (span * _SPAN + place - j) << self.low_bits
            for b in range(self.low_bits):
                at = j * self.low_bits + b
                v |= ((self.low[at >> 3] >> (at & 7)) & 1).astype(np.int64) << b
            out[a:a + 4096] = v
        return out


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id",
                      text_col: str = "text", block_tokens: int = BLOCK_TOKENS) -> None:
    """Encode every whole text, append ``end_id``, write ids in ascending ``id_col`` order below ``path``.

    Null and empty texts are written as the end id alone; null ids come first; rows with equal
    ids are ordered by text; an empty table gives an empty file table. Other columns are not read.
    Texts are range-partitioned by (id, hash of text), so a repeated id does not fill one task.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, shard, block = encoder(tokenizer), TaskContext.get().partitionId(), 0
        width = 2 if max(enc.tokenizer.get_vocab_size(with_added_tokens=True) - 1, end_id) < 1 << 16 else 4
        doc_ids, parts, size = [], [], 0

        def flush():
            ids = np.concatenate(parts)
            ends = EliasFano.encode(np.cumsum([len(p) for p in parts]))
            row = (shard, block, len(parts), len(ids), doc_ids, width, ids.astype(f"<u{width}").tobytes(),
                   ends.low_bits, ends.low.tobytes(), ends.high.tobytes(), ends.ranks.tobytes())
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

        schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("n_docs", pa.int32()),
                            ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("width", pa.int32()),
                            ("ids", pa.binary()), ("low_bits", pa.int32()), ("low", pa.binary()),
                            ("high", pa.binary()), ("ranks", pa.binary())])
        for b in lean(batches):
            docs_of, i = b.column(0).to_pylist(), 0
            for group in enc.batches(b.column(1).to_pylist()):
                for ids in group:
                    if parts and size + len(ids) + 1 > block_tokens:
                        yield flush()
                        doc_ids, parts, size, block = [], [], 0, block + 1
                    doc_ids.append(docs_of[i])
                    parts.append(np.append(ids, np.uint32(end_id)))
                    size += len(ids) + 1
                    i += 1
        if parts:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    # one partition per about 16 MB of shuffled text under the session's own setting
    ranged = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    ranged.mapInArrow(run, BLOCK_SCHEMA).write.parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files at ``path``: doc_id, start, n_tokens, ids_crc32.

    Offsets within a block come from ``select`` on its Elias-Fano code; the ids before a block
    from sums per shard, a table as long as the file has shards, then per block.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                code = EliasFano(r["n_docs"], r["low_bits"], r["low"], r["high"], r["ranks"])
                ends = code.select(np.arange(code.n))
                starts = np.append(0, ends[:-1])
                ids = np.frombuffer(r["ids"], f"<u{r['width']}").astype("<u4")
                crc = [zlib.crc32(ids[s:e]) for s, e in zip(starts.tolist(), ends.tolist())]
                yield pa.record_batch(
                    [pa.array([r["shard"]] * code.n, pa.int32()), pa.array([r["block"]] * code.n, pa.int32()),
                     pa.array(r["doc_ids"], pa.int64()), pa.array(starts), pa.array(ends - starts),
                     pa.array(crc, pa.int64())], ["shard", "block", "doc_id", "within", "n_tokens", "ids_crc32"])

    files = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    docs = files.mapInArrow(run, "shard int, block int, doc_id long, within long, n_tokens long, ids_crc32 long")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    shards = files.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    shards = shards.select("shard", F.coalesce(F.sum("n").over(before.orderBy("shard")), F.lit(0)).alias("base"))
    blocks = files.select("shard", "block", (F.coalesce(F.sum("n_tokens").over(
        before.partitionBy("shard").orderBy("block")), F.lit(0))).alias("prior"))
    place = blocks.join(shards, "shard").select("shard", "block", (F.col("base") + F.col("prior")).alias("first"))
    return docs.join(place, ["shard", "block"]).select(
        "doc_id", (F.col("first") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")
