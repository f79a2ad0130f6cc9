"""Token ids of many texts with a public byte-level vocabulary, given as ranks.

A text is cut where the tokenizer always cuts: before a space that follows a
visible ASCII character and precedes a letter or digit. The pieces repeat
often, so each distinct one of a chunk is tokenized once, nearly all in one call.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa

from stopwise.llm.textkit import Chunk

# Fixed value: the pattern that splits text before the merges.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

_VISIBLE = np.zeros(256, bool)
_VISIBLE[33:127] = True
_FOLLOWS = np.zeros(256, bool)
_FOLLOWS[48:58] = _FOLLOWS[65:91] = _FOLLOWS[97:123] = True
_FOLLOWS[0xC3:0xE0] = True  # two-byte letters; white space has other lead bytes


class Tokens:
    """Ids of each text of a chunk, one after the other."""

    def __init__(self, ranks_path: str) -> None:
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        # No special tokens: their strings are ordinary text.
        self._encoding = tiktoken.Encoding(
            "public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self._bytes = np.zeros(max(ranks.values()) + 1, np.int64)
        self._bytes[list(ranks.values())] = [len(token) for token in ranks]

    def _distinct(self, pieces: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces, one after the other, and where each piece's ids begin.

        Inner pieces keep their cuts side by side, so one call does them all; the others
        follow after them, hence the order of the beginnings.
        """
        inner = _inner(pieces)
        alike = pieces.filter(pa.array(inner))
        _, stops, data = _buffers(alike)
        found = np.array(self._encoding.encode_ordinary(data.tobytes().decode("utf-8")), np.uint32)
        last = np.searchsorted(np.cumsum(self._bytes[found]), stops[1:]) + 1
        lengths = np.zeros(len(pieces), np.int64)
        lengths[inner] = np.diff(last, prepend=0)
        begin = np.zeros(len(pieces), np.int64)
        begin[inner] = last - lengths[inner]
        each = [found]
        end = len(found)
        for i in np.flatnonzero(~inner).tolist():
            text = pieces[i].as_py().decode("utf-8", "replace")
            own = np.array(self._encoding.encode_ordinary(text), np.uint32)
            each.append(own)
            begin[i], lengths[i] = end, len(own)
            end += len(own)
        return np.concatenate(each), np.stack([begin, lengths])

    def encode(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the chunk, and where each text's ids begin (one more at the end)."""
        data, offsets = chunk.data, chunk.offsets
        cut = np.zeros(len(data) + 1, bool)
        if len(data) > 2:
            cut[1:-2] = (data[1:-1] == 32) & _VISIBLE[data[:-2]] & _FOLLOWS[data[2:]]
            # A cut looks at its neighbours, which must be of the same text.
            before = offsets[1:-1] - 1
            cut[before[before > 0]] = False
        cut[offsets] = True
        cut[len(data)] = False
        starts = np.flatnonzero(cut)
        if not len(starts):
            return np.empty(0, np.uint32), np.zeros(len(offsets), np.int64)
        # The pieces cover the chunk without gaps.
        bounds = np.append(starts, len(data)).astype(np.int32)
        pieces = pa.Array.from_buffers(
            pa.binary(),
            len(starts),
            [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))],
        ).dictionary_encode()
        ids, places = self._distinct(pieces.dictionary)
        begin, length = places[:, pieces.indices.to_numpy()]
        done = np.zeros(len(length) + 1, np.int64)
        np.cumsum(length, out=done[1:])
        place = np.arange(done[-1]) + np.repeat(begin - done[:-1], length)
        return ids[place], done[np.searchsorted(starts, offsets)]


def _buffers(pieces: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each piece begins and, from zero, the borders of all; and their bytes."""
    held = pieces.buffers()
    borders = np.frombuffer(held[1], np.int32)[pieces.offset : pieces.offset + len(pieces) + 1]
    data = np.frombuffer(held[2] or b"", np.uint8)[borders[0] : borders[-1]]
    borders = borders.astype(np.int64) - borders[0]
    return borders[:-1], borders, data


def _inner(pieces: pa.BinaryArray) -> np.ndarray:
    """Whether a piece begins with a space before a letter or digit and ends visibly."""
    starts, borders, data = _buffers(pieces)
    inner = np.diff(borders) > 1
    first = starts[inner]
    last = data[borders[1:][inner] - 1]
    inner[inner] = (data[first] == 32) & _FOLLOWS[data[first + 1]] & _VISIBLE[last]
    return inner


_MADE: dict[str, Tokens] = {}


def tokens(ranks_path: str) -> Tokens:
    """The worker's tokenizer for a rank file."""
    if ranks_path not in _MADE:
        _MADE[ranks_path] = Tokens(ranks_path)
    return _MADE[ranks_path]
