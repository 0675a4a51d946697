"""Token counts from a finite-state transducer compiled out of a byte-level BPE tokenizer.

Method. The tokenization of every prefix of a piece ends in one certain token, and that token
follows from the last few bytes and from the tokens in which the shorter prefixes end: a token
t may follow a token s exactly if the tokenizer gives [s, t] for the bytes of s and t together.
A state of the transducer is thus the list of places at which a token may still begin: the node
of the vocabulary's byte tree reached from there, the token that ends there, and how many tokens
have been counted since. Together with the pre-tokenizer's mode (letters, digits, other signs,
white space, the beginning of a contraction, an unfinished UTF-8 character) this gives a
deterministic machine over bytes. Each transition is annotated with the change of the number of
tokens; the sum over a text is its count, so no state needs a final step. The machine is
compiled as texts need it and kept as one table per Python worker, of bounded size.

Texts are cut into chunks of equal length at any byte. Past its first synchronising place (a
space behind a printable ASCII sign) a chunk no longer depends on the state in which it is
entered. Its state map is therefore (head, count, exit state): run the head from the entry
state, add the count, leave in the exit state. All chunks of a batch run side by side in numpy,
and their maps are composed pairwise in a tree until each text has one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsignal.llm.common import lean, whole_text

CHUNK_BYTES = 512
#: Cells of the transition table (4 bytes each) at which it is emptied and compiled anew.
TABLE_CELLS = 30_000_000
#: Bytes of text handled side by side.
BATCH_BYTES = 4_000_000

# modes of the pre-tokenizer
_BEGIN, _LETTERS, _DIGITS, _SIGNS, _SPACES, _QUOTE, _QUOTE2 = range(7)
# endings of contractions, as the pre-tokenizer lists them (fixed values)
_ENDINGS = {"s", "t", "re", "ve", "m", "ll", "d"}
_MACHINES: dict[str, Transducer] = {}


class BytePairs:
    """Prefix tokenization of one piece, a byte at a time; states are interned."""

    def __init__(self, tokenizer):
        self.model = tokenizer.model
        self.fits: dict[tuple[int, int], bool] = {}
        back = _bytes_of_signs()
        self.children: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        self.text: dict[int, str] = {}
        added = set(tokenizer.get_added_tokens_decoder())
        for text, t in tokenizer.get_vocab().items():
            if t in added or any(s not in back for s in text):
                continue
            node = 0
            for s in text:
                kids = self.children[node]
                if back[s] not in kids:
                    kids[back[s]] = len(self.children)
                    self.children.append({})
                    self.token.append(-1)
                node = kids[back[s]]
            self.token[node] = t
            self.text[t] = text
        self.forget()

    def forget(self) -> None:
        """Drop the states, keep the vocabulary's tree."""
        self.states: list[tuple] = []
        self.ids: dict[tuple, int] = {}
        self.steps: dict[tuple[int, int], tuple[int, int]] = {}
        self.fits.clear()
        self.start = self._intern(((0, -1, 0),))

    def _intern(self, s: tuple) -> int:
        if s not in self.ids:
            self.ids[s] = len(self.states)
            self.states.append(s)
        return self.ids[s]

    def _may_follow(self, s: int, t: int) -> bool:
        if (s, t) not in self.fits:
            text = self.text[t] if s < 0 else self.text[s] + self.text[t]
            self.fits[s, t] = [x.id for x in self.model.tokenize(text)] == ([t] if s < 0 else [s, t])
        return self.fits[s, t]

    def step(self, state: int, byte: int) -> tuple[int, int]:
        """(next state, change of the number of tokens)."""
        if (state, byte) not in self.steps:
            alive, last, change = [], None, 0
            for node, end, since in self.states[state]:
                node = self.children[node].get(byte)
                if node is None:
                    continue
                alive.append((node, end, since))
                t = self.token[node]
                if last is None and t >= 0 and self._may_follow(end, t):
                    last, change = t, 1 - since
            new = [(n, e, s + change) for n, e, s in alive if self.children[n]]
            self.steps[state, byte] = self._intern((*new, (0, last, 0))), change
        return self.steps[state, byte]

    def feed(self, state: int, piece: bytes) -> tuple[int, int]:
        total = 0
        for b in piece:
            state, change = self.step(state, b)
            total += change
        return state, total


def _bytes_of_signs() -> dict[str, int]:
    """The byte that each sign of the byte-level alphabet stands for: printable signs stand for
    themselves, all other bytes are written from U+0100 on, in order."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Transducer:
    """Byte transducer whose transitions carry token-count changes; compiled lazily."""

    def __init__(self, path: str, table_cells: int = TABLE_CELLS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cells = table_cells
        self.kinds: dict[str, int] = {}
        self.pairs = BytePairs(self.tokenizer)
        self._reset()

    def _reset(self) -> None:
        self.pairs.forget()
        self.column = np.full(256, -1, np.int64)  # table columns of the bytes seen so far
        self.width, self.known = 64, 0
        self.states: list[tuple] = []
        self.ids: dict[tuple, int] = {}
        self.table = np.zeros((1024, self.width), np.int32)  # next state << 8 | change + 128; 0: not compiled
        self._intern((b"", _BEGIN, self.pairs.start))

    def _intern(self, s: tuple) -> int:
        if s not in self.ids:
            self.ids[s] = len(self.states)
            self.states.append(s)
            if len(self.states) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        return self.ids[s]

    def _kind(self, c: str) -> int:
        """The class of a character, asked of the tokenizer's own pre-tokenizer."""
        if c not in self.kinds:
            one = lambda s: len(self.tokenizer.pre_tokenizer.pre_tokenize_str(s)) == 1
            self.kinds[c] = (_LETTERS if one("a" + c) else _DIGITS if one("1" + c)
                             else _SIGNS if one("!" + c) else _SPACES)
        return self.kinds[c]

    # -- transitions -------------------------------------------------------------------------
    def _next(self, state: tuple, byte: int) -> tuple[tuple, int]:
        part, mode, *rest = state
        part += bytes([byte])
        need = 1 if part[0] < 0x80 else 2 if part[0] < 0xE0 else 3 if part[0] < 0xF0 else 4
        if len(part) < need:
            return (part, mode, *rest), 0
        new, change = self._char(part, mode, rest)
        return (b"", *new), change

    def _char(self, c: bytes, mode: int, rest: list) -> tuple[tuple, int]:
        feed, start = self.pairs.feed, self.pairs.start
        text = c.decode()
        kind = self._kind(text)
        if mode in (_LETTERS, _DIGITS, _SIGNS) and kind == mode:
            s, change = feed(rest[0], c)
            return (mode, s), change
        if mode == _QUOTE:  # an apostrophe that begins a piece
            if text in _ENDINGS:
                return (_BEGIN, start), feed(start, b"'" + c)[1] - feed(start, b"'")[1]
            if kind == _SIGNS:
                s, change = feed(rest[0], c)
                return (_SIGNS, s), change
            if any(len(e) == 2 and e[0] == text for e in _ENDINGS):
                s, change = feed(start, c)
                return (_QUOTE2, s, text), change
        if mode == _QUOTE2:  # the apostrophe and one letter of a longer ending
            if rest[1] + text in _ENDINGS:
                both = feed(start, b"'")[1] + feed(start, rest[1].encode())[1]
                return (_BEGIN, start), feed(start, b"'" + rest[1].encode() + c)[1] - both
            if kind == _LETTERS:
                s, change = feed(rest[0], c)
                return (_LETTERS, s), change
        if mode == _SPACES:
            # rest: state over all spaces, state over all but the last, their counts' difference, last
            whole, short, diff, last = rest
            if kind == _SPACES:
                s, change = feed(whole, c)
                return (_SPACES, s, whole, change, text), change
            # the last space leaves the run: a blank joins the next piece, others stand alone
            base = -diff
            if last == " ":
                s, change = feed(start, b" " + c)
                return (kind, s), base + change
            s, change = feed(start, c)
            alone = feed(start, last.encode())[1]
            return self._fresh(kind, s, text), base + alone + change
        # a new piece begins
        s, change = feed(start, c)
        if kind == _SPACES:
            return (_SPACES, s, start, change, text), change
        return self._fresh(kind, s, text), change

    @staticmethod
    def _fresh(kind: int, s: int, text: str) -> tuple:
        return (_QUOTE, s) if text == "'" else (kind, s)

    def _compile(self, keys: np.ndarray) -> None:
        for key in keys.tolist():
            state, byte = key >> 8, key & 255
            new, change = self._next(self.states[state], byte)
            to = self._intern(new)
            self.table[state, self.column[byte]] = to << 8 | (change + 128)

    # -- running -----------------------------------------------------------------------------
    def run(self, data: np.ndarray, lo: np.ndarray, hi: np.ndarray, state: np.ndarray):
        """Run data[lo:hi] of every lane from its state, side by side: (states, counts)."""
        order = np.argsort(lo - hi, kind="stable")
        at, length, s = lo[order], (hi - lo)[order], state[order].astype(np.int64)
        total = np.zeros(len(at), np.int64)
        steps = int(length[0]) if len(length) else 0
        live = np.searchsorted(-length, -np.arange(1, steps + 1), side="right")
        for i, n in enumerate(live.tolist()):
            byte = data[at[:n] + i]
            cell = s[:n] * self.width + self.column[byte]
            v = self.table.reshape(-1)[cell]
            if not v.all():
                miss = v == 0
                self._compile(np.unique(s[:n][miss] << 8 | byte[miss]))
                v = self.table.reshape(-1)[cell]
            s[:n] = v >> 8
            total[:n] += (v & 255) - 128
        out, counts = np.empty_like(s), np.empty_like(total)
        out[order], counts[order] = s, total
        return out, counts

    def _columns(self, data: np.ndarray) -> None:
        new = [b for b in np.flatnonzero(np.bincount(data, minlength=256)) if self.column[b] < 0]
        for b in new:
            self.column[b] = self.known
            self.known += 1
        if self.known > self.width:
            wide = min(256, max(self.known, 2 * self.width))
            self.table = np.pad(self.table, ((0, 0), (0, wide - self.width)))
            self.width = wide

    def count(self, texts: list[bytes], chunk: int = CHUNK_BYTES) -> np.ndarray:
        """Tokens of each text (without special tokens' strings)."""
        if self.table.size > self.cells:
            self._reset()
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        out = np.zeros(len(texts), np.int64)
        if not sizes.sum():
            return out
        data = np.frombuffer(b"".join(texts), np.uint8)
        self._columns(data)
        first = np.cumsum(sizes) - sizes
        # chunks: of which text, from where to where
        per = -(-sizes // chunk)
        doc = np.repeat(np.arange(len(texts)), per)
        rank = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
        lo = first[doc] + rank * chunk
        hi = np.minimum(lo + chunk, first[doc] + sizes[doc])
        # the first place of each chunk behind which its entry state does not matter
        space = (data == 32) | (data >= 9) & (data <= 13)
        sync = np.flatnonzero(space[1:] & (data[:-1] > 32) & (data[:-1] < 127)) + 1
        head = np.append(sync, len(data))[np.searchsorted(sync, lo)]
        head = np.where(rank == 0, lo, np.minimum(head, hi))
        known = (rank == 0) | (head < hi)
        exits, counts = self.run(data, head, hi, np.zeros(len(lo), np.int64))
        # the maps: (known, head from lo to head, count, exit); compose neighbours until one is left
        while len(doc) > np.count_nonzero(per):
            rank = np.arange(len(doc)) - np.searchsorted(doc, doc)
            right = np.flatnonzero(rank % 2 == 1)
            left = right - 1
            ran = known[left]
            a, b = left[ran], right[ran]
            mid, more = self.run(data, lo[b], head[b], exits[a])
            counts[a] += more + np.where(known[b], counts[b], 0)
            exits[a] = np.where(known[b], exits[b], mid)
            a, b = left[~ran], right[~ran]  # no synchronising place yet: the heads join
            head[a], known[a], counts[a], exits[a] = head[b], known[b], counts[b], exits[b]
            keep = np.ones(len(doc), bool)
            keep[right] = False
            doc, lo, head, known = doc[keep], lo[keep], head[keep], known[keep]
            counts, exits = counts[keep], exits[keep]
        out[doc] = counts
        return out

    def count_texts(self, texts: list[str]) -> np.ndarray:
        """Tokens of whole texts; the strings of special tokens are one token each."""
        parts, owner, extra = [], [], np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            pieces = [t]
            for s in self.special:
                if s in t:
                    pieces = [x for p in pieces for x in p.split(s)]
            extra[i] = len(pieces) - 1
            parts += [p.encode() for p in pieces]
            owner += [i] * len(pieces)
        np.add.at(extra, np.array(owner, np.int64), self.count(parts))
        return extra


def machine(path: str) -> Transducer:
    """One transducer per Python worker and tokenizer."""
    if path not in _MACHINES:
        _MACHINES[path] = Transducer(path)
    return _MACHINES[path]


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 1024, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_tokens, over_limit (n_tokens > ``limit``).

    Null and empty texts have 0 bytes and 0 tokens; null ids stay null; repeated rows each get
    a row; an empty table gives none. Other columns are not read. Nothing is shuffled.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = machine(tokenizer)
        for b in lean(batches):
            texts = b.column(1).to_pylist()
            n_bytes = np.fromiter((len(t.encode()) for t in texts), np.int64, len(texts))
            counts = np.zeros(len(texts), np.int64)
            cut = np.searchsorted(np.cumsum(n_bytes), np.arange(0, n_bytes.sum() + BATCH_BYTES, BATCH_BYTES))
            for lo, hi in zip(cut, np.append(cut[1:], len(texts))):
                if lo < hi:
                    counts[lo:hi] = m.count_texts(texts[lo:hi])
            yield pa.record_batch([b.column(0), pa.array(n_bytes), pa.array(counts), pa.array(counts > limit)],
                                  ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
