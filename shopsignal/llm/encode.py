"""Token ids of whole texts from the tokenizers library, each distinct segment encoded once.

The library pre-splits a text and encodes each piece by itself. With the two kinds of file named
in ``PROVEN`` no piece reaches from a non-space character over a following space, nor from a
letter or digit to a following full stop or comma: their patterns put white space, letters and
other signs into different pieces, and what they normalise (composition, lower case, runs of
white space) never joins characters across these places. A text may therefore be cut there, and
the ids of a segment (spaces and the word after them, or signs) do not depend on its neighbours.
A batch's segments are numbered by Arrow; the library encodes those that the worker has not yet
seen. Texts with rarer white space or with a special token's string, and all texts of any other
kind of file, go to the library whole.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Segments kept per Python worker (about 60 bytes each); they are dropped when there are more.
CACHE_SEGMENTS = 600_000
#: Bytes of text encoded together.
BATCH_BYTES = 2_000_000
_JOINED = 200  # new segments per call of the library

# The (normalizer, pre-tokenizer) settings for which the cuts above hold, as the library writes them.
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True}
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PROVEN = [
    (None, {**_BYTES, "use_regex": True}),
    ({"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
     {"type": "Sequence", "pretokenizers": [
         {"type": "Split", "pattern": {"Regex": _WORDS}, "behavior": "Removed", "invert": True},
         {**_BYTES, "use_regex": False}]}),
]

_RARE_SPACE = re.compile(r"[^\S \t\n\r\x0b\x0c]")
_ENCODERS: dict[str, SegmentEncoder] = {}


class SegmentEncoder:
    def __init__(self, path: str, limit: int = CACHE_SEGMENTS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        shape = json.loads(self.tokenizer.to_str())
        self.cut = (shape["normalizer"], shape["pre_tokenizer"]) in PROVEN
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.limit = limit
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.binary())  # segments by number: no Python object is kept for one
        self.first, self.length = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.uint32)
        self.flat, self.used = np.zeros(1 << 18, "<u4"), 0

    def batches(self, texts: list[str]) -> Iterator[list[np.ndarray]]:
        """The ids of each text, for a bounded number of bytes at a time."""
        at = size = 0
        for i, t in enumerate(texts):
            size += len(t)
            if size >= BATCH_BYTES or i + 1 == len(texts):
                yield self.encode(texts[at:i + 1])
                at, size = i + 1, 0

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids (unsigned 32 bits) of each whole text."""
        whole = [not self.cut or bool(_RARE_SPACE.search(t)) or any(s in t for s in self.special) for t in texts]
        raw = [b"" if w else t.encode() for t, w in zip(texts, whole)]
        ids, ends = self._plain(raw)
        out = np.split(ids, ends[:-1])
        for i, w in enumerate(whole):
            if w:
                out[i] = np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, "<u4")
        return out

    def _plain(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > self.limit:
            self._forget()
        data = b"".join(raw)
        if not data:
            return np.zeros(0, "<u4"), np.zeros(len(raw), np.int64)
        stops = np.cumsum([len(r) for r in raw])
        cuts = _cuts(data, stops)
        number = pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(data)])
        coded = number.dictionary_encode()
        segment = self._numbers(coded.dictionary)[coded.indices.to_numpy()]
        length = self.length[segment].astype(np.int64)
        done = np.cumsum(length)
        source = np.repeat(self.first[segment] - (done - length), length)
        source += np.arange(len(source))
        # tokens before the end of each text: segments never cross one
        return self.flat[source], np.append(0, done)[np.searchsorted(cuts, stops)]

    def _numbers(self, segments: pa.Array) -> np.ndarray:
        """The number of each distinct segment; new ones are encoded and numbered."""
        out = pc.index_in(segments, value_set=self.known).fill_null(-1).to_numpy().astype(np.int64)
        miss = np.flatnonzero(out < 0)
        if not len(miss):
            return out
        new = segments.take(pa.array(miss)).to_pylist()
        # a segment may follow another only if it begins with white space and that one does not end
        # with any; other control characters would join the signs before them
        follows = np.array([s[0] in b" \t\n\v\f\r" and not s.isspace() for s in new])
        order = np.concatenate([np.flatnonzero(follows), np.flatnonzero(~follows)])
        count, n = int(follows.sum()), len(self.known)
        ordered = [new[i] for i in order]
        for i in range(0, count, _JOINED):
            self._learn_joined(ordered[i:min(i + _JOINED, count)], n + i)
        alone = ordered[count:]
        for i, e in enumerate(self.tokenizer.encode_batch([s.decode() for s in alone], add_special_tokens=False)):
            self._store(n + count + i, np.array([0, len(e.ids)]), e.ids)
        self.known = pa.concat_arrays([self.known, pa.array(ordered, pa.binary())])
        out[miss[order]] = n + np.arange(len(order))
        return out

    def _learn_joined(self, segments: list[bytes], number: int) -> None:
        data = b"".join(segments)
        e = self.tokenizer.encode(data.decode(), add_special_tokens=False)
        # a token belongs to the segment in which its first character lies
        first = np.fromiter((a for a, _ in e.offsets), np.int64, len(e.ids))
        chars = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
        ends = chars[np.cumsum([len(s) for s in segments]) - 1]
        self._store(number, np.append(0, np.searchsorted(first, ends)), e.ids)

    def _store(self, number: int, cuts: np.ndarray, ids: list[int]) -> None:
        """Keep the ids of the segments numbered from ``number`` on; ``cuts``: where each one's ids begin."""
        more, used = len(cuts) - 1, self.used
        while number + more > len(self.first):
            self.first, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.first, self.length))
        while used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[used:used + len(ids)] = ids
        self.first[number:number + more] = used + cuts[:-1]
        self.length[number:number + more] = np.diff(cuts)
        self.used += len(ids)


def _cuts(data: bytes, stops: np.ndarray) -> np.ndarray:
    """Places at which texts may be cut, ends of texts included, as 32-bit offsets."""
    b = np.frombuffer(data, np.uint8)
    space = (b == 32) | (b >= 9) & (b <= 13)
    low = b | 32
    word = (low >= 97) & (low <= 122) | (b >= 48) & (b <= 57)
    cut = np.zeros(len(b) + 1, bool)
    cut[1:-1] = space[1:] & ~space[:-1] | ((b[1:] == 44) | (b[1:] == 46)) & word[:-1]
    cut[0] = cut[-1] = True
    cut[stops] = True
    return np.flatnonzero(cut).astype(np.int32)


def encoder(path: str) -> SegmentEncoder:
    """One encoder per Python worker and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = SegmentEncoder(path)
    return _ENCODERS[path]
