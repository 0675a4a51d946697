"""Language identification with error-correcting output codes.

Every learned language has a codeword of bits. For each bit, a binary n-gram classifier tells
the languages with a 1 from those with a 0: its weights are smoothed log ratios of character
n-gram shares, and its margin for a text is the mean weight of the text's n-grams. Decoding
chooses the codeword with the smallest loss: each bit adds exp(-margin * sign / spread),
weighted by how well that bit separates its two sides. Texts whose second-best codeword is
nearly as good are flagged as ambiguous.

The classifiers need n-gram counts per language only, which Spark sums; the driver and the
tasks hold one table of counts per language and of weights per bit.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsignal.llm.common import lean

#: Cells of the hashed n-gram tables, per n-gram length.
CELLS = 1 << 14
LENGTHS = (1, 2, 3)
#: Learning rows per language, about (a sample by hash of the id).
MAX_ROWS_PER_LANG = 4000
#: Languages above this many share codes drawn from a seed instead of all possible columns.
EXHAUSTIVE_LANGS = 5
SEED = 11
#: Gap of the losses' softmax below which a text is flagged.
AMBIGUOUS = 0.6
BLOCK_CHARS = 1_000_000


def codewords(n: int, seed: int = SEED) -> np.ndarray:
    """``n`` codewords of +1 / -1: all distinct splits for few languages, else the best of seeded draws."""
    if n <= 1:
        return np.ones((n, 1), np.int8)
    if n <= EXHAUSTIVE_LANGS:
        # language 0 always has +1; each column is one of the splits of the others
        splits = np.arange(1, 1 << (n - 1))
        rest = 1 - 2 * ((splits[None, :] >> np.arange(n - 1)[:, None]) & 1)
        return np.vstack([np.ones(len(splits), int), rest]).astype(np.int8)
    draw, bits, best, far = random.Random(seed), max(15, int(np.ceil(10 * np.log2(n)))), None, -1
    for _ in range(200):
        code = np.array([[draw.choice((-1, 1)) for _ in range(bits)] for _ in range(n)], np.int8)
        if (np.abs(code.sum(0)) == n).any():
            continue  # a bit that splits nothing
        apart = (bits - code.astype(int) @ code.T.astype(int)) // 2
        least = (apart + bits * np.eye(n, dtype=int)).min()
        if least > far:
            best, far = code, least
    return best


def _cells(codes: np.ndarray) -> list[np.ndarray]:
    """Table cells of all n-grams of a lower-cased text's code points."""
    out, h = [], np.zeros(len(codes), np.uint64)
    for n in range(max(LENGTHS)):
        h = h[:len(codes) - n] * np.uint64(0x9E3779B97F4A7C15) + codes[n:].astype(np.uint64) + np.uint64(1)
        if n + 1 in LENGTHS:
            mixed = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            out.append(((mixed >> np.uint64(40)) & np.uint64(CELLS - 1)).astype(np.int64))
    return out


def ngram_counts(text: str) -> np.ndarray:
    """Counts per n-gram length and cell, over the whole text; white space and digits count as a blank."""
    total, text, carry = np.zeros((len(LENGTHS), CELLS)), text.lower(), np.zeros(0, np.uint32)
    for at in range(0, len(text), BLOCK_CHARS):  # blocks bound the memory; n-grams across their borders count once
        codes = np.frombuffer(text[at:at + BLOCK_CHARS].encode("utf-32-le", "surrogatepass"), np.uint32)
        plain = np.where((codes < 65) | (codes > 90) & (codes < 97) | (codes > 122) & (codes < 128), 32, codes).astype(np.uint32)
        before = np.append(carry[-1:] if len(carry) else np.uint32(0), plain[:-1])
        plain = np.append(carry, plain[(plain != 32) | (before != 32)])
        for k, cells in enumerate(_cells(plain)):
            total[k] += np.bincount(cells[max(0, len(carry) - LENGTHS[k] + 1):], minlength=CELLS)
        carry = plain[max(0, len(plain) - max(LENGTHS) + 1):]
    return total


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


@dataclass
class Codes:
    """Learned languages, codewords, and each bit's weights, spread and trust."""

    langs: list[str]
    code: np.ndarray
    weights: np.ndarray  # (lengths * cells, bits)
    spread: np.ndarray
    trust: np.ndarray

    @classmethod
    def learn(cls, counts: dict[str, np.ndarray], smooth: float = 0.5) -> Codes:
        langs = sorted(counts)
        code = codewords(len(langs))
        if not langs:
            return cls([], code, np.zeros((0, 0)), np.zeros(0), np.zeros(0))
        shares = []
        for lang in langs:
            c = counts[lang].reshape(len(LENGTHS), CELLS)
            shares.append((c + smooth) / (c.sum(1, keepdims=True) + smooth * CELLS))
        share = np.array(shares).reshape(len(langs), len(LENGTHS), CELLS)
        weights, spread, trust = [], [], []
        for bit in code.T:
            one, zero = bit > 0, bit < 0
            if not zero.any():
                w = np.zeros((len(LENGTHS), CELLS))
            else:
                w = np.log(share[one].mean(0)) - np.log(share[zero].mean(0))
            # the margin that texts of each language are expected to have
            margin = np.einsum("lnc,nc->l", share, w) / len(LENGTHS)
            weights.append(w.ravel())
            spread.append(max(np.abs(margin).mean(), 1e-9))
            trust.append(max(float((margin * bit).min()), 0.05 * spread[-1]) / spread[-1])
        return cls(langs, code, np.array(weights).T.astype(np.float32), np.array(spread), np.array(trust))

    def margins(self, text: str) -> np.ndarray:
        c = ngram_counts(text)
        c /= np.maximum(c.sum(1, keepdims=True), 1)
        flat = c.ravel()
        seen = np.flatnonzero(flat)
        return flat[seen] @ self.weights[seen] / len(LENGTHS)

    def decode(self, text: str) -> tuple[str, float, bool]:
        """(language, share of the softmax over negative losses, ambiguous)."""
        signed = np.clip(self.code * (self.margins(text) / self.spread), -6, 6)
        loss = (np.exp(-signed) * self.trust).sum(1) / self.trust.sum()
        p = np.exp(-4 * (loss - loss.min()))
        p /= p.sum()
        best = np.argsort(-p, kind="stable")
        gap = p[best[0]] - (p[best[1]] if len(p) > 1 else 0)
        return self.langs[best[0]], float(p[best[0]]), bool(gap < AMBIGUOUS)


def learning_rows(id_col: str = "doc_id") -> Column:
    """Whether an id is learnt from: crc32 of the id as text, modulo 4, is not 2."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 != 2


def learn(docs: DataFrame, learning: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", max_rows: int = MAX_ROWS_PER_LANG) -> Codes:
    """Fit on whole texts with a language; null ids, texts and languages are not learnt from.

    Languages with more than ``max_rows`` rows give a sample of about that many by hash of the id.
    The n-gram tables are summed by Spark per language and cell.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang")).where(
        "doc_id is not null and lang is not null and text is not null")
    rows = rows if learning is None else rows.where(learning)
    sizes = rows.groupBy("lang").count().collect()  # one row per language
    if not sizes:
        return Codes.learn({})
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("learn")), 32)
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], int(2**32 * min(1, max_rows / r["count"])))])
    sample = rows.where(draw < share[F.col("lang")]).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                c = ngram_counts(text.as_py()).ravel()
                total[lang] = total[lang] + c if lang in total else c
        for lang, c in total.items():
            at = np.flatnonzero(c)
            yield pa.record_batch([pa.array([lang] * len(at)), pa.array(at, pa.int32()), pa.array(c[at])],
                                  ["lang", "cell", "n"])

    cells = sample.mapInArrow(run, "lang string, cell int, n double").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    counts = {r["lang"]: np.zeros(len(LENGTHS) * CELLS) for r in sizes}
    got = cells.toArrow().combine_chunks()  # at most lengths * CELLS rows of 20 bytes per language
    if got.num_rows:
        lang = got.column("lang").combine_chunks().dictionary_encode()
        cell, n = (got.column(c).to_numpy() for c in ("cell", "n"))
        for i, name in enumerate(lang.dictionary.to_pylist()):
            at = lang.indices.to_numpy() == i
            counts[name][cell[at]] = n[at]
    return Codes.learn(counts)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             model: Codes | None = None, max_rows: int = MAX_ROWS_PER_LANG) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score (0 to 1), ambiguous.

    Texts that are null or have no letter are ``und`` with score 0, and so is every text if no
    language was learnt. Only the text enters a prediction. A null id is not held out; repeated
    rows get equal predictions; an empty table gives no rows. Other columns are not read.
    """
    model = learn(docs, learning_rows(id_col), id_col, text_col, lang_col, max_rows) if model is None else model
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bits * cells numbers, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = shared.value
        for b in lean(batches):
            out = []
            for t in b.column(2):
                text = t.as_py()
                out.append(codes.decode(text) if codes.langs and has_letter(text) else ("und", 0.0, True))
            lang, score, vague = zip(*out) if out else ((), (), ())
            yield pa.record_batch([b.column(0), b.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                                   pa.array(vague, pa.bool_())], ["doc_id", "held_out", "lang_pred", "score", "ambiguous"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(~learning_rows(id_col), F.lit(False)),
                       F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean")
