"""Ranked lexical search by NRA (no random access) over impact-sorted lists.

The documents are cut into shards of bounded size. A shard is written once, as one row: its
documents' ids and lengths, and for every term of the queries the documents that hold it with
their frequencies. Sums over the shards give the number of documents, the mean length and the
document frequencies; with these a posting's impact (its part of a score) is an integer.

A task then reads its shards one after the other. Within a shard each term's list is in order of
falling impact, and for every query the lists are read from the top, in blocks, side by side.
Every document has a score interval: the sum of the impacts read for it, and that sum plus the
last impact read from each list in which it has not yet appeared. Reading continues until no
document outside the best ``top`` can still reach them, ties included, and the scores of these
are final (both ends meet). The best scores of earlier shards are the bar for later ones, so a
task returns at most ``top`` rows a query, whatever it reads.

Nothing is shuffled but one row per shard and term for the frequencies (combined before) and the
best rows of every task.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopsignal.llm.common import lean, text_blocks, whole_text, written

TOP = 50
#: Documents and postings of a shard at most (places are 16-bit numbers).
SHARD_DOCS, SHARD_POSTINGS = 16_384, 2_000_000
#: (query, term) pairs handled in one pass over the documents; more are handled in blocks.
QUERY_TERMS = 200_000
#: Entries read from each list in the first round; doubled every round.
FIRST_READ = 256
#: Bytes of a text split at a time.
BLOCK_BYTES = 1_000_000

#: What is not a term character, and the case that is folded. Bytes of other scripts are above 0x7F.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
_TERM_REST = re.compile(rb"[^ ]*")
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_INDEX = ("shard long, docs int, postings int, doc_ids array<long>, lengths array<long>, terms array<int>, "
          "counts array<int>, places binary, freqs binary")
_HITS = "query int, doc_id long, row long, score long"


def terms_of(text: str) -> Iterator[list[bytes]]:
    """The terms of a text in order, a bounded part at a time."""
    data = text.encode().translate(_FOLD)
    for a, b in text_blocks(data, BLOCK_BYTES, _TERM_REST):
        yield data[a:b].split()


def query_terms(queries: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (item_id, term); rows with the same id are one query."""
    folded = F.translate(whole_text(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return queries.select(F.col(id_col).cast("long").alias("item_id"),
                          F.explode(F.regexp_extract_all(folded, F.lit(_TERM), 0)).alias("term")).distinct()


def build_index(docs: DataFrame, vocabulary: list[bytes], id_col: str = "doc_id", text_col: str = "text",
                shard_docs: int = SHARD_DOCS, shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """The written shards: one row each, with the postings of the vocabulary's terms."""
    number = {t: i for i, t in enumerate(vocabulary)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, ids, lengths, where, what, often, held = TaskContext.get().partitionId() << 24, [], [], [], [], [], 0

        def close() -> pa.RecordBatch:
            term, place, freq = (np.concatenate([np.array(x, t) for x in v]) if v else np.zeros(0, t)
                                 for v, t in ((what, np.int32), (where, np.uint16), (often, np.uint32)))
            order = np.argsort(term, kind="stable")
            terms, counts = np.unique(term, return_counts=True)
            return pa.record_batch([
                pa.array([shard], pa.int64()), pa.array([len(ids)], pa.int32()), pa.array([len(term)], pa.int32()),
                pa.array([ids], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64())),
                pa.array([terms], pa.list_(pa.int32())), pa.array([counts.astype(np.int32)], pa.list_(pa.int32())),
                pa.array([place[order].tobytes()], pa.binary()), pa.array([freq[order].tobytes()], pa.binary())],
                [c.split()[0] for c in _INDEX.split(", ")])

        for b in lean(batches):
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                count, n = Counter(), 0
                for part in terms_of(text.as_py()):
                    n += len(part)
                    count.update(filter(number.__contains__, part))
                what.append([number[t] for t in count])
                often.append(list(count.values()))
                where.append([len(ids)] * len(count))
                ids.append(doc_id)
                lengths.append(n)
                held += len(count)
                if len(ids) >= shard_docs or held >= shard_postings:
                    yield close()
                    shard, ids, lengths, where, what, often, held = shard + 1, [], [], [], [], [], 0
        if ids:
            yield close()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    return written(rows.mapInArrow(run, _INDEX), "lexical")


def impacts(weight: int, freq: np.ndarray, m: np.ndarray) -> np.ndarray:
    """A term's part of the scores of documents with these frequencies and length values (64-bit integers)."""
    return weight * (1_000_000_000 * freq // (1000 * freq + 20 * m))


def nra(lists: list[tuple[np.ndarray, np.ndarray]], docs: int, top: int, bar: int = 0,
        first_read: int = FIRST_READ) -> tuple[np.ndarray, np.ndarray, int]:
    """(places, scores, entries read) of the documents that belong to the best ``top``.

    ``lists``: (places, impacts), falling impacts, each place once a list. Only scores above 0
    and not below ``bar`` count. All documents tied with the last one are returned.
    """
    low, unseen = np.zeros(docs, np.int64), np.ones((len(lists), docs), bool)
    head = np.array([x[0] if len(x) else 0 for _, x in lists], np.int64)  # no unread entry is larger
    at, step, read, open_ = [0] * len(lists), first_read, 0, np.arange(docs)
    while True:
        for i, (place, impact) in enumerate(lists):
            if at[i] < len(place):
                part = slice(at[i], at[i] + step)
                low[place[part]] += impact[part]
                unseen[i, place[part]] = False
                read += len(place[part])
                at[i] += step
                head[i] = impact[at[i] - 1] if at[i] < len(place) else 0
        step *= 2
        best = low[open_]
        if len(best) > top:
            bar = max(bar, int(np.partition(best, len(best) - top)[len(best) - top]))
        high = best + sum(h * unseen[i, open_] for i, h in enumerate(head.tolist()) if h)
        keep = (high >= bar) & (high > 0)
        open_, best, high = open_[keep], best[keep], high[keep]
        if not head.any() or (best == high).all():
            return open_, best, read


def search(docs: DataFrame, queries: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           query_id: str = "item_id", query_text: str = "text", terms_at_once: int = QUERY_TERMS, **shards: int) -> DataFrame:
    """The best ``top`` documents of every query: item_id, rank (from 1), doc_id, score.

    Every row of ``docs`` is a document, also where ids are null or repeated; only scores above 0
    count; equal scores are in ascending order of doc_id (null last, then in the order read).
    Null and empty texts have no term; a query without terms, or whose terms no document holds,
    gives no row. Query rows with the same id (null is one) are one query with the terms of all.
    Empty tables give no rows; other columns are not read. Long texts are split in parts.

    The driver and every task hold the (query, term) pairs of one block, about ``terms_at_once``;
    a larger query set is handled in blocks, each against all documents.
    """
    spark = docs.sparkSession
    pairs = written(query_terms(queries, query_id, query_text), "query-terms")
    blocks = max(1, math.ceil(pairs.count() / terms_at_once))
    hits = None
    for k in range(blocks):
        of_block = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k) if blocks > 1 else pairs
        got = _search_block(docs, of_block, top, id_col, text_col, shards)
        hits = got if hits is None else hits.unionByName(got)
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def _search_block(docs: DataFrame, pairs: DataFrame, top: int, id_col: str, text_col: str, shards: dict) -> DataFrame:
    spark = docs.sparkSession
    rows = sorted(((r["item_id"], r["term"].encode()) for r in pairs.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    vocabulary = sorted({t for _, t in rows})
    number = {t: i for i, t in enumerate(vocabulary)}
    items = list(dict.fromkeys(i for i, _ in rows))
    wanted: list[list[int]] = [[] for _ in items]
    place = {x: i for i, x in enumerate(items)}
    for item, term in rows:
        wanted[place[item]].append(number[term])
    index = build_index(docs, vocabulary, id_col, text_col, **shards)
    total = index.agg(F.sum(F.size(F.filter("lengths", lambda n: n > 0))), F.sum(F.aggregate(
        "lengths", F.lit(0).cast("long"), lambda a, n: a + n))).first()
    n_docs, n_terms = (int(x or 0) for x in total)
    df = np.zeros(len(vocabulary), np.int64)  # one number per term of the block
    entry = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("e"))
    for r in entry.groupBy(F.col("e.terms").alias("term")).agg(F.sum("e.counts").alias("df")).collect():
        df[r["term"]] = r["df"]
    # a term's weight, in doubles; 0 for terms that nothing holds
    weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) if d else 0 for d in df.tolist()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in wanted]
        for b in lean(batches):
            for i in range(b.num_rows):
                _rank_shard({c: b.column(c)[i] for c in b.schema.names}, best)
        got = [(q, d, r, -s) for q, hits in enumerate(best) for s, _, d, r in hits]
        names = ["query", "doc_id", "row", "score"]
        types = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.record_batch([pa.array(v, t) for v, t in zip(zip(*got) if got else [[]] * 4, types)], names)

    def _rank_shard(shard: dict, best: list[list[tuple]]) -> None:
        size, first = shard["docs"].as_py(), shard["shard"].as_py() * 65_536
        ids, lengths = shard["doc_ids"].values, shard["lengths"].values.to_numpy()
        null, number = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
        if 50 * n_docs * int(lengths.max()) >= 1 << 63:
            lengths = lengths.astype(object)
        m = (100 - 50 + 50 * lengths * n_docs // max(1, n_terms)).astype(np.int64)
        places, freqs = (np.frombuffer(shard[c].as_py(), t) for c, t in (("places", np.uint16), ("freqs", np.uint32)))
        lists, at = {}, 0
        for term, count in zip(shard["terms"].values.to_pylist(), shard["counts"].values.to_pylist()):
            if weight[term] > 0:
                p = places[at:at + count].astype(np.int64)
                x = impacts(weight[term], freqs[at:at + count].astype(np.int64), m[p])
                order = np.argsort(-x, kind="stable")
                lists[term] = p[order], x[order]
            at += count
        for q, terms in enumerate(wanted):
            own = [lists[t] for t in terms if t in lists]
            if not own:
                continue
            bar = -best[q][-1][0] if len(best[q]) == top else 0
            found, score, _ = nra(own, size, top, bar)
            # falling scores, then ascending ids
            order = np.lexsort((found, number[found], null[found], -score))[:top]
            hits = [(-int(s), bool(null[p]), None if null[p] else int(number[p]), first + int(p))
                    for p, s in zip(found[order], score[order])]
            best[q] = sorted([*best[q], *hits], key=lambda h: (h[0], h[1], h[2] or 0, h[3]))[:top]

    item = spark.createDataFrame([(k, i) for k, i in enumerate(items)], "query int, item_id long")
    got = index.mapInArrow(run, _HITS)
    return got.join(F.broadcast(item), "query").select("item_id", "doc_id", "row", "score")
