"""Exact de-duplication with an extendible-hash index on shared files.

Keys are 64-bit hashes of the texts. A directory of hash prefixes points to buckets; while a
bucket holds more rows than its capacity, it is split by one more bit, and where its depth has
reached that of the directory, the directory doubles. A bucket that still overflows at the
largest depth (a hot key, or more keys than the directory may address) overflows into more rows.

The index is Parquet below the shared folder, one row per bucket and key, range-partitioned and
sorted by both, so that a file is owned by one task and holds a range of buckets. A row's chain
lists the different texts that share the key, told apart by their bytes: equal texts are combined
within every input task first, so a text that makes up a third of all rows arrives once from each,
and each combined text is then compared byte by byte. Every document gets its group from the index
alone: the directory names the bucket of its key, the entry of (bucket, key) its chain, and the
chain is walked to the document's text.

All steps are DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsignal.llm.common import join_groups, whole_text, written

BUCKET_ROWS = 4096
FIRST_DEPTH = 4
#: The directory has at most 2 ** MAX_DEPTH entries of 16 bytes (1 MB), so it may be broadcast.
MAX_DEPTH = 16


def _slot(depth: int, key: str = "key") -> Column:
    return F.shiftrightunsigned(F.col(key), 64 - depth)


def build_directory(keys: DataFrame, bucket_rows: int = BUCKET_ROWS, first_depth: int = FIRST_DEPTH,
                    max_depth: int = MAX_DEPTH) -> tuple[DataFrame, int]:
    """Split overfull buckets of the column ``key``, doubling the directory; (directory, its depth).

    The directory has one row per slot: slot, bucket (its first slot), depth (of the bucket).
    Every round reads only the sums per prefix of the largest depth, at most 2 ** max_depth rows.
    """
    spark = keys.sparkSession
    cells = written(keys.groupBy(_slot(max_depth).alias("cell")).agg(F.count(F.lit(1)).alias("n")), "cells")
    depth = first_depth
    directory = written(spark.range(1 << depth).select(F.col("id").alias("slot"), F.col("id").alias("bucket"),
                                                       F.lit(depth).alias("depth")), "directory")
    while depth < max_depth:
        fill = cells.groupBy(F.shiftright("cell", max_depth - depth).alias("slot")).agg(F.sum("n").alias("n"))
        over = (directory.join(F.broadcast(fill), "slot").groupBy("bucket").agg(F.sum("n").alias("n"))
                .where(F.col("n") > bucket_rows))
        if not over.take(1):
            break
        # doubling: each slot becomes two; halves of an overfull bucket get entries of their own
        split = directory.join(F.broadcast(over.select("bucket", F.lit(1).alias("split"))), "bucket", "left")
        half = F.explode(F.array(F.lit(0), F.lit(1))).alias("half")
        twice = split.select("slot", "bucket", "depth", "split", half)
        depth += 1
        # only a bucket as deep as the directory can be overfull here: shallower ones had fitted
        directory = written(twice.select(
            (2 * F.col("slot") + F.col("half")).alias("slot"),
            F.when(F.col("split").isNotNull(), 2 * F.col("slot") + F.col("half"))
            .otherwise(2 * F.col("bucket")).alias("bucket"),
            (F.col("depth") + F.coalesce("split", F.lit(0))).alias("depth")), "directory")
    return directory, depth


def _keyed(docs: DataFrame, *columns: Column, text_col: str = "text") -> DataFrame:
    text = whole_text(text_col)
    return docs.select(*columns, text.alias("text"), F.xxhash64(text).alias("key"))


def _addressed(keyed: DataFrame, directory: DataFrame, depth: int) -> DataFrame:
    """Look up each key's bucket; the directory's size is bounded by 2 ** max_depth."""
    return keyed.withColumn("slot", _slot(depth)).join(F.broadcast(directory.select("slot", "bucket")), "slot")


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                **sizes: int) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """(rows, index, directory, its depth).

    rows: row, doc_id, key, text_sha256 of every document. index: bucket, key, rows (documents that
    share the key), chain: one element per different text with n_bytes, text_sha256, group_size,
    keep_id, keep_row.
    """
    row = F.monotonically_increasing_id().alias("row")
    doc = F.col(id_col).cast("long").alias("doc_id")
    rows = written(_keyed(docs, row, doc, text_col=text_col).select(
        "row", "doc_id", "key", F.sha2(F.col("text"), 256).alias("text_sha256")), "rows")
    directory, depth = build_directory(rows.select("key"), **sizes)
    owned = _addressed(_keyed(docs, doc, text_col=text_col), directory, depth)
    texts = owned.groupBy("bucket", "key", "text").agg(
        F.count(F.lit(1)).alias("group_size"), F.max("doc_id").alias("keep_id"))
    entries = texts.select("bucket", "key", F.octet_length("text").cast("long").alias("n_bytes"),
                           F.sha2(F.col("text"), 256).alias("text_sha256"), "group_size", "keep_id")
    # of repeated rows (same id, same text) the first read stays
    stays = rows.groupBy("key", "text_sha256").agg(
        F.max(F.struct(F.col("doc_id").isNotNull(), "doc_id", -F.col("row"))).getField("col3").alias("last"))
    link = F.struct("n_bytes", "text_sha256", "group_size", "keep_id", (-F.col("last")).alias("keep_row"))
    chains = entries.join(stays, ["key", "text_sha256"]).groupBy("bucket", "key").agg(
        F.sum("group_size").alias("rows"), F.sort_array(F.collect_list(link)).alias("chain"))
    index = chains.repartitionByRange("bucket", "key").sortWithinPartitions("bucket", "key")
    return rows, written(index, "index"), directory, depth


def look_up(rows: DataFrame, index: DataFrame, directory: DataFrame, depth: int) -> DataFrame:
    """Each row with ``link``, the element of its chain: by slot, bucket and key, then along the chain.

    A row that the index does not lead to its text, or to two texts with one SHA-256, stops the job.
    """
    found = join_groups(_addressed(rows, directory, depth), index, ["bucket", "key"], "rows")
    same = F.filter("chain", lambda e: e["text_sha256"] == F.col("text_sha256"))
    lost = F.raise_error(F.lit("the index names no text, or two, for a row"))
    return found.withColumn("same", same).withColumn("link", F.when(F.size("same") == 1, F.col("same")[0]).otherwise(lost)).drop(
        "same", "chain")


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **sizes: int) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if their bytes are; null counts as empty. Of equal texts the row with the
    largest id stays (null ids are smaller than all others; of rows with that same id one
    stays). Very long texts are keys of the shuffle like others. An empty table gives no rows;
    columns other than id and text are not read.
    """
    found = look_up(*build_index(docs, id_col, text_col, **sizes))
    return found.select("doc_id", F.col("link.keep_id").alias("keep_id"), F.col("link.group_size").alias("group_size"),
                        (F.col("row") == F.col("link.keep_row")).alias("kept"), "text_sha256")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **sizes: int) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns (see ``decide``).

    Owner tasks return, for every different text of their buckets, the other columns of the row
    that stays: a text is shuffled once, as the key it is compared by, after equal ones have been
    combined. Null and empty texts are one text, and the row that stays keeps its own; null ids are
    smaller than all others; repeated rows give one; an empty table gives no rows; columns may have
    any names.
    """
    directory, depth = build_directory(_keyed(docs, text_col=text_col).select("key"), **sizes)
    others = [c for c in docs.columns if c != text_col]
    rest = F.struct(F.col(f"`{text_col}`").isNull().alias("was_null"),
                    F.struct(*[F.col(f"`{c}`") for c in others]).alias("rec")).alias("rest")
    keyed = _keyed(docs, rest, F.col(id_col).cast("long").alias("doc_id"), text_col=text_col)
    stays = _addressed(keyed, directory, depth).groupBy("bucket", "key", "text").agg(
        F.max_by("rest", F.struct(F.col("doc_id").isNotNull(), "doc_id")).alias("rest"))
    text = F.when(~F.col("rest.was_null"), F.col("text")).cast(docs.schema[text_col].dataType).alias(text_col)
    return stays.select(*[text if c == text_col else F.col(f"rest.rec.`{c}`").alias(c) for c in docs.columns])
