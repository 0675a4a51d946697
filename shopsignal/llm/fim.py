"""Fill-in-the-middle transformation by repeated-capture matching.

A text is ``(unit)*`` with the unit ``[A-Za-z]+|[^A-Za-z]``. One fullmatch of the regex library
keeps the end of every repetition, so ``match.ends(1)`` gives the number of units and the offsets
of both cuts without a loop over units. The match needs some 60 bytes per unit, so texts of more
than ``BLOCK_CHARS`` characters are matched in blocks that end between units: counts add up, and
the block that holds a cut gives its offset.

The output's markers cannot occur in a transformed text and no marker can arise where pieces
meet, so splitting the output at its markers gives the pieces back (``restore``, plain SQL).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsignal.llm.common import lean, text_blocks, whole_text

#: Fixed values of the format.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Characters matched at a time.
BLOCK_CHARS = 1_000_000

_UNITS = regex.compile(r"([A-Za-z]+|[^A-Za-z])*")
_LETTERS = regex.compile(r"[A-Za-z]*")
_OUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def unit_cuts(text: str, choose, block_chars: int = BLOCK_CHARS) -> tuple[int, list[int]]:
    """(number of units n, offsets behind the units that ``choose(n)`` names, ascending)."""
    at = text_blocks(text, block_chars, _LETTERS)
    ends = [_UNITS.fullmatch(text, a, b).ends(1) for a, b in at[:1]]
    counts = [len(e) for e in ends] + [len(_UNITS.fullmatch(text, a, b).ends(1)) for a, b in at[1:]]
    n, out = sum(counts), []
    for unit in choose(n):
        k = 0
        while unit > counts[k]:
            unit -= counts[k]
            k += 1
        if not unit:
            out.append(at[k][0])
        else:
            out.append((ends[0] if k == 0 else _UNITS.fullmatch(text, *at[k]).ends(1))[unit - 1])
    return n, out


def arrange(doc_id: int | None, text: str, seed: int = 1, plain_from: int = 90, spm_below: int = 20,
            block_chars: int = BLOCK_CHARS) -> tuple[int, str, int | None, int | None, str]:
    """(n, form, prefix characters, middle characters, output) of one document."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in range(0, 32, 8))
    n, (first, second) = unit_cuts(text, lambda n: sorted((h1 % (n + 1), h2 % (n + 1))), block_chars)
    if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= plain_from:
        return n, "plain", None, None, text
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if h4 % 100 < spm_below:
        return n, "spm", first, second - first, "".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return n, "psm", first, second - first, "".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, plain_from: int = 90,
              spm_below: int = 20) -> DataFrame:
    """One row per row of ``docs``: doc_id, n (units), form, prefix_chars, middle_chars, output (the whole text).

    Null texts count as empty; empty texts, texts that hold a marker and the share of ids whose
    third hash is ``plain_from`` or more of 100 stay plain (null character counts). The choice
    depends on the seed and the id alone, so repeated rows give equal rows; a null id is hashed as
    an empty one. An empty table gives no rows; columns other than id and text are not read. Very
    long texts are matched in blocks of ``BLOCK_CHARS`` characters; memory holds one text, its
    output and a block's captures.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        for b in lean(batches):
            ids, texts = (b.column(i).to_pylist() for i in range(2))
            got = [(i, *arrange(i, t, seed, plain_from, spm_below)) for i, t in zip(ids, texts)]
            columns = zip(*got) if got else [[]] * len(names)
            yield pa.record_batch([pa.array(v, t) for v, t in zip(columns, types)], names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text")).mapInArrow(run, _OUT)


def restore(form: str = "form", output: str = "output") -> Column:
    """The exact text from a form and its output."""
    piece = F.split(F.col(output), "<[PSM]>")
    return (F.when(F.col(form) == "psm", F.concat(piece[1], piece[3], piece[2]))
            .when(F.col(form) == "spm", F.concat(piece[2], piece[3], piece[1])).otherwise(F.col(output)))


def digest(transformed: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256 of ``transform``'s rows."""
    return transformed.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                              F.sha2(F.col("output"), 256).alias("output_sha256"),
                              F.sha2(restore(), 256).alias("restored_sha256"))
