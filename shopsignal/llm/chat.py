"""Chat formatting by prefix-target expansion.

A turn is rendered as

    <turn ROLE>TEXT</turn>

followed by a line feed. In a text, ``\\`` is written ``\\0`` and the ``<`` of a control string
(``<turn``, ``</turn``) is written ``\\1``; in a role, ``~`` is ``~0`` and ``>`` is ``~1``. Both are
reversible, and no text can end its turn or begin another.

Every assistant turn is an example of its own: the rendered turns before it and its own opening
are context, its text alone is trainable. The context of an example is a prefix of the rendered
conversation, so the stored form keeps each rendered turn once, with its place (``segments``), and
one row per example (``examples``): where its context ends, which span is trainable and where it
ends. Written out, n turns would take n * n / 2; ``expand`` does so. The loss mask is what the
examples say, nothing else.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ROLE_TRAINED = "assistant"
OPEN, CLOSE = "<turn ", "</turn>\n"

_SEGMENTS = "conv_id long, part int, nth long, segment string, start long, chars long, head int"
_EXAMPLES = "conv_id long, part int, nth long, target_from long, target_to long, example_chars long"


def escape(text: str) -> str:
    return text.replace("\\", "\\0").replace("<turn", "\\1turn").replace("</turn", "\\1/turn")


def unescape(text: str) -> str:
    return text.replace("\\1", "<").replace("\\0", "\\")


def render(role: str, text: str) -> tuple[str, int]:
    """(rendered turn, where its text begins)."""
    head = OPEN + role.replace("~", "~0").replace(">", "~1") + ">"
    return head + escape(text) + CLOSE, len(head)


def parse(segment: str) -> tuple[str, str]:
    """(role, text) of a rendered turn."""
    end = segment.index(">")
    role = segment[len(OPEN):end].replace("~1", ">").replace("~0", "~")
    return role, unescape(segment[end + 1:len(segment) - len(CLOSE)])


def write_formatted(conversations: DataFrame, path: str) -> None:
    """Render all conversations (conv_id, turn, role, text) below ``path``.

    ``segments`` holds one row per turn: conv_id, part, nth (from 0), segment, start, chars and head
    (length of its opening). ``examples`` holds one row per assistant turn: conv_id, part, nth, the
    trainable span target_from, target_to, and example_chars, where the example ends. Places are
    counted within the part of the conversation that one task has written. ``carry`` holds what parts
    before it add, for parts that continue a conversation: at most one row per task.

    Rows are ordered by turn (null last), then role and text. Null roles and texts count as
    empty; null conv_ids are one conversation; repeated rows are turns of their own; an empty
    table gives empty files. Other columns are not read. Rows are range-partitioned by all
    ordering columns, so a conversation that holds most rows is rendered by many tasks.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # no expression over the text: range bounds are sampled from these columns
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_last(), F.col("role"), F.col("text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, now, nth, at, begun = TaskContext.get().partitionId(), None, 0, 0, False
        for b in batches:
            out = {k: [] for k in ("nth", "segment", "start", "chars", "head")}
            for conv, role, text in zip(*(b.column(i).to_pylist() for i in (0, 2, 3))):
                if not begun or conv != now:
                    now, nth, at, begun = conv, 0, 0, True
                segment, head = render(role, text)
                for k, v in zip(out, (nth, segment, at, len(segment), head)):
                    out[k].append(v)
                nth, at = nth + 1, at + len(segment)
            types = dict.fromkeys(out, pa.int64()) | {"segment": pa.string(), "head": pa.int32()}
            yield pa.record_batch([b.column(0), pa.array([part] * b.num_rows, pa.int32()),
                                   *(pa.array(v, types[k]) for k, v in out.items())], ["conv_id", "part", *out])

    rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, _SEGMENTS).write.parquet(
        f"{path}/segments")
    segments = rows.sparkSession.read.schema(_SEGMENTS).parquet(f"{path}/segments")
    # every trained turn becomes an example of its own: all before it and its opening are context
    trained = segments.where(F.col("segment").startswith(f"{OPEN}{ROLE_TRAINED}>"))
    end = F.col("start") + F.col("chars")
    trained.select("conv_id", "part", "nth", (F.col("start") + F.col("head")).alias("target_from"),
                   (end - len(CLOSE)).alias("target_to"), end.alias("example_chars")).write.parquet(f"{path}/examples")
    sums = segments.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("turns"), F.sum("chars").alias("chars"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = sums.select("conv_id", "part", F.sum("turns").over(before).alias("add_turns"),
                        F.sum("chars").over(before).alias("add_chars")).where("add_turns > 0")
    carry.write.parquet(f"{path}/carry")


def _whole(spark: SparkSession, path: str, name: str, schema: str, places: list[str]) -> DataFrame:
    """A written table with its places counted over whole conversations."""
    rows = spark.read.schema(schema).parquet(f"{path}/{name}")
    carry = spark.read.schema("conv_id long, part int, add_turns long, add_chars long").parquet(f"{path}/carry")
    carry = carry.select("part", F.col("conv_id").alias("_c"), "add_turns", "add_chars")
    # one row per task that wrote the file, at most
    both = rows.join(F.broadcast(carry), (rows.part == carry.part) & rows.conv_id.eqNullSafe(F.col("_c")), "left")
    turns, chars = F.coalesce("add_turns", F.lit(0)), F.coalesce("add_chars", F.lit(0))
    moved = {"nth": F.col("nth") + turns, **{c: F.col(c) + chars for c in places}}
    return both.select(*[moved.get(c, rows[c]).alias(c) for c in rows.columns if c != "part"])


def read_formatted(spark: SparkSession, path: str) -> DataFrame:
    """conv_id, nth, segment, start, chars, head of every turn, counted over whole conversations.

    Null conv_ids are one conversation; repeated turns have a row each; no conversations, no rows.
    """
    return _whole(spark, path, "segments", _SEGMENTS, ["start"])


def read_examples(spark: SparkSession, path: str) -> DataFrame:
    """One row per assistant turn: conv_id, nth (the number of context turns), and in characters of the rendered
    conversation, whose beginning the example is: target_from, target_to, example_chars. Empty replies are examples too."""
    return _whole(spark, path, "examples", _EXAMPLES, ["target_from", "target_to", "example_chars"])


def _ordered(formatted: DataFrame, examples: DataFrame) -> DataFrame:
    """Turns of a conversation in order, each followed by the example it is the target of."""
    marks = ("target_from", "target_to", "example_chars")
    none = F.lit(None).cast("long")
    turns = formatted.select("conv_id", "nth", F.lit(0).alias("kind"), "segment", "start", "chars", *[none.alias(c) for c in marks])
    masks = examples.select("conv_id", "nth", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("segment"),
                            none.alias("start"), none.alias("chars"), *marks)
    return turns.unionByName(masks).repartition("conv_id").sortWithinPartitions("conv_id", "nth", "kind")


def expand(formatted: DataFrame, examples: DataFrame) -> DataFrame:
    """Whole examples: conv_id, nth, text, target_from, target_to.

    A task reads its conversations turn by turn and holds the text of one; conversations with a null
    id are one, repeated turns give an example each, no examples no rows. The output grows with the
    square of a conversation's turns; the stored spans do not.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, text = object(), ""
        for b in batches:
            for r in b.to_pylist():
                if r["conv_id"] != now:
                    now, text = r["conv_id"], ""
                if r["kind"] == 0:
                    text += r["segment"]
                    continue
                yield pa.record_batch(
                    [pa.array([v], t) for v, t in ((r["conv_id"], pa.int64()), (r["nth"], pa.int64()), (text, pa.string()),
                                                   (r["target_from"], pa.int64()), (r["target_to"], pa.int64()))],
                    ["conv_id", "nth", "text", "target_from", "target_to"])

    return _ordered(formatted, examples).mapInArrow(
        run, "conv_id long, nth long, text string, target_from long, target_to long")


def digest(formatted: DataFrame, examples: DataFrame) -> DataFrame:
    """One row per conversation, parsed back from its rendered turns and the spans of its examples.

    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars (characters of the
    rendered conversation), n_examples, example_chars (of all examples, contexts included).
    A digest is one pass over a conversation by its definition; a task holds one turn of it.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_examples",
                 "example_chars"]
        now, state, done, turn, start = None, None, [], "", 0

        def close():
            turns, loss, n, chars, size, count, total = state
            done.append((now, n, turns.hexdigest(), chars, loss.hexdigest(), size, count, total))

        def rows():
            types = [pa.string() if n.endswith("sha256") else pa.int64() for n in names]
            return pa.record_batch([pa.array(v, t) for v, t in zip(zip(*done), types)], names)

        for b in batches:
            for r in b.to_pylist():
                if state is None or r["conv_id"] != now:
                    if state is not None:
                        close()
                    now, state = r["conv_id"], [hashlib.sha256(), hashlib.sha256(), 0, 0, 0, 0, 0]
                if r["kind"] == 0:
                    turn, start = r["segment"], r["start"]
                    role, text = parse(turn)
                    state[0].update(f"{role}\n{text}\n".encode())
                    state[2] += 1
                    state[4] = start + r["chars"]
                else:  # the turn before it is its target
                    reply = unescape(turn[r["target_from"] - start:r["target_to"] - start])
                    state[1].update(reply.encode())
                    state[3] += len(reply)
                    state[5] += 1
                    state[6] += r["example_chars"]
            if done:
                yield rows()
                done.clear()
        if state is not None:
            close()
            yield rows()

    return _ordered(formatted, examples).mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
             "formatted_chars long, n_examples long, example_chars long")
