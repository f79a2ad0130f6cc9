"""Byte-level BPE encoding by tree concatenation, and decoding, of a public vocabulary.

The tokenizer cuts a text into pieces (words, numbers, runs of signs or white space) before it
merges bytes, and pieces do not influence each other. Distinct short pieces of a chunk are encoded once.
A piece longer than a leaf stays unsplit however long it is: it is halved until the parts are
leaves, which are rows of their own, dealt to all tasks and encoded in parallel. Then halves
are joined pairwise, as a tree. At a join, a window of a few tokens on both sides is
encoded anew, and grows until its first tokens are those of the left half and its
last ones those of the right half; the tokens outside it stay. A sequence of tokens
is what the merges make of its bytes if that holds for all pairs of neighbours, and each
pair lies in the window or in a half that was right before, so the result is exact.

Decoding looks up the bytes of each id; bytes that are not UTF-8 become U+FFFD.

Documents that may have a long piece, or have a special token's string, are found by the places
where words begin; only they are cut here and shuffled. A document's ids meet in one task in the
end, as they are one row of the result.

Defined cases: a null text is empty and has no ids; the string of a special token is that token,
as the tokenizers library has it, unless ``special`` is false; rows that repeat or
share an id, or have none, get a result each. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopwise.llm.shared import held_packed, partitions
from stopwise.llm.textkit import SPACES, Chunk, binary_array, chunks
from stopwise.llm.tokens import PATTERN, tokens

LEAF = 1 << 12  # bytes
# White space as the tokenizer has it, and its pattern in these terms.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CUT = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+"
    rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
AGREE = 2  # tokens that both sides of a window must have in common with their half


class Vocabulary:
    """Bytes of each id, ids of a piece, special strings: read from a tokenizer's JSON file."""

    def __init__(self, path: str) -> None:
        import regex
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = {c: b for b, c in _visible_bytes().items()}
        ranks = {
            bytes(byte_of[c] for c in token): number for token, number in spec["model"]["vocab"].items()
        }
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        size = max([*ranks.values(), *self.special.values()]) + 1
        each = [b""] * size
        for token, number in ranks.items():
            each[number] = token
        for text, number in self.special.items():
            each[number] = text.encode()
        self._data = np.frombuffer(b"".join(each), np.uint8)
        self._offsets = np.zeros(size + 1, np.int64)
        np.cumsum([len(x) for x in each], out=self._offsets[1:])
        self._cut = regex.compile(CUT).findall
        specials = "|".join(regex.escape(x) for x in sorted(self.special, key=len, reverse=True))
        self._split = regex.compile(f"({specials})").split if specials else None
        self._one = tiktoken.Encoding(
            "public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )._encode_single_piece
        self._known: dict[str, list[int]] = {}

    def piece(self, data: bytes) -> np.ndarray:
        """Ids of bytes that are merged without being cut."""
        return np.array(self._one(data), np.uint32) if data else np.empty(0, np.uint32)

    def pieces(self, text: str, special: bool) -> Iterator[str | int]:
        """What the text is cut into; a number is a special token's id."""
        if not special or self._split is None:
            yield from self._cut(text)
            return
        for part in self._split(text):
            if part in self.special:
                yield self.special[part]
            elif part:
                yield from self._cut(part)

    def short(self, piece: str) -> list[int]:
        """Ids of a short piece; those of the newest chunks are kept."""
        found = self._known.get(piece)
        if found is None:
            if len(self._known) > 1 << 18:
                self._known.clear()
            found = self._known[piece] = self._one(piece.encode())
        return found

    def bytes_of(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids, one after the other."""
        low = self._offsets[ids]
        lengths = self._offsets[ids.astype(np.int64) + 1] - low
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self._data[np.arange(total) + np.repeat(low - ends + lengths, lengths)].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        return self.bytes_of(ids).decode("utf-8", "replace")


def _visible_bytes() -> dict[int, str]:
    """How the file writes each byte: visible Latin letters as they are, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


def halves(data: bytes, leaf: int) -> list[bytes]:
    """The leaves of the tree over a piece: halved until none is longer than ``leaf``."""
    if len(data) <= leaf:
        return [data]
    middle = len(data) // 2
    return halves(data[:middle], leaf) + halves(data[middle:], leaf)


def join(vocabulary: Vocabulary, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Ids of the bytes of two encoded halves as one piece."""
    if not len(left) or not len(right):
        return np.concatenate([left, right])
    size = 2 * AGREE
    while True:
        a, b = left[-size:], right[:size]
        window = vocabulary.piece(vocabulary.bytes_of(np.concatenate([a, b])))
        # A side that the window holds whole needs no agreement: it begins or ends the piece.
        agrees = (len(a) == len(left) or np.array_equal(window[:AGREE], a[:AGREE])) and (
            len(b) == len(right) or np.array_equal(window[-AGREE:], b[-AGREE:])
        )
        if agrees and (len(window) >= 2 * AGREE or (len(a) == len(left) and len(b) == len(right))):
            return np.concatenate([left[: len(left) - len(a)], window, right[len(b) :]])
        size *= 2


def concatenate(vocabulary: Vocabulary, leaves: list[np.ndarray]) -> np.ndarray:
    """Leaves joined pairwise, level by level, in the shape of their halving."""
    if not leaves:
        return np.empty(0, np.uint32)
    while len(leaves) > 1:
        leaves = [
            join(vocabulary, leaves[k], leaves[k + 1]) if k + 1 < len(leaves) else leaves[k]
            for k in range(0, len(leaves), 2)
        ]
    return leaves[0]


_MADE: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The worker's vocabulary of a file."""
    if path not in _MADE:
        _MADE[path] = Vocabulary(path)
    return _MADE[path]


# --- in Spark ------------------------------------------------------------------------------

# Bytes that are white space in no place of a character: visible ASCII, first bytes of letters.
_VISIBLE = np.zeros(256, bool)
_VISIBLE[33:127] = _VISIBLE[0xC3:0xE0] = True


def by_hand(chunk: Chunk, leaf: int, contents: list[bytes]) -> np.ndarray:
    """Rows of a chunk that may have a piece longer than a leaf, or have one of the contents.

    A piece never goes on from ASCII white space to a visible character, but for one space
    that it may begin with, so it is no longer than from one such place to the next.
    """
    data, offsets = chunk.data, chunk.offsets
    out = np.zeros(len(chunk), bool)
    starts = np.flatnonzero(SPACES[data[:-1]] & _VISIBLE[data[1:]]) + 1
    places = np.union1d(starts, offsets)
    wide = places[:-1][np.diff(places) >= leaf]
    out[np.searchsorted(offsets, wide, "right") - 1] = True
    whole = data.tobytes() if contents else b""
    for content in contents:
        at = whole.find(content)
        while at >= 0:
            out[np.searchsorted(offsets, at, "right") - 1] = True
            at = whole.find(content, at + 1)
    return out


@dataclass(frozen=True)
class Tokenizer:
    """Files of one public vocabulary, the tokenizer's JSON file and the same as ranks; whether
    special strings are tokens; and the longest piece that is encoded at once."""

    path: str
    ranks_path: str
    special: bool = True
    leaf: int = LEAF

    def sides(self, batch: pa.RecordBatch) -> np.ndarray:
        """Which rows of a batch are cut by hand."""
        contents = [x.encode() for x in vocabulary(self.path).special] if self.special else []
        found = [by_hand(chunk, self.leaf, contents) for chunk in chunks(batch.column("text"))]
        return np.concatenate(found) if found else np.zeros(0, bool)


_IDS = "doc_id long, ids binary"
_PARTS = "row long, doc_id long, part long, leaf long, ids binary, bytes binary"


def _plain(files: Tokenizer, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents whose pieces are all short."""
    known = tokens(files.ranks_path)
    for batch in batches:
        batch = batch.filter(pa.array(~files.sides(batch)))
        doc_id = batch.column("doc_id")
        for chunk in chunks(batch.column("text")):
            ids, bounds = known.encode(chunk)
            data = ids.astype("<u4", copy=False).tobytes()
            cut = (4 * bounds).tolist()
            packed = [data[a:b] for a, b in zip(cut, cut[1:])]  # noqa: B905 - pairs of neighbours
            yield pa.RecordBatch.from_arrays(
                [doc_id.slice(chunk.first, len(chunk)), binary_array(packed)], names=["doc_id", "ids"]
            )


def _cut(files: Tokenizer, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The other documents as parts: ids of runs of short pieces, and leaves of long pieces."""
    known = vocabulary(files.path)
    names = [x.split()[0] for x in _PARTS.split(", ")]
    for batch in batches:
        batch = batch.filter(pa.array(files.sides(batch)))
        rows, doc_ids = batch.column("row").to_pylist(), batch.column("doc_id").to_pylist()
        for chunk in chunks(batch.column("text")):
            for k in range(len(chunk)):
                own = rows[chunk.first + k], doc_ids[chunk.first + k]
                out: list[tuple] = []
                ids: list[int] = []
                for piece in known.pieces(chunk.text(k).decode("utf-8", "replace"), files.special):
                    if isinstance(piece, int):
                        ids.append(piece)
                    elif len(data := piece.encode()) <= files.leaf:
                        ids += known.short(piece)
                    else:
                        part = out[-1][2] + 1 if out else 0
                        out.append((*own, part, 0, np.array(ids, "<u4").tobytes(), None))
                        ids = []
                        out += [(*own, part + 1, n, None, x) for n, x in enumerate(halves(data, files.leaf))]
                out.append((*own, out[-1][2] + 1 if out else 0, 0, np.array(ids, "<u4").tobytes(), None))
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in columns[:4]]
                    + [binary_array(list(x)) for x in columns[4:]],
                    names=names,
                )


def _leaves(path: str, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = vocabulary(path)
    for batch in batches:
        data, ids = batch.column("bytes").to_pylist(), batch.column("ids").to_pylist()
        found = [x if d is None else known.piece(d).tobytes() for x, d in zip(ids, data, strict=True)]
        names = ["row", "doc_id", "part", "leaf"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(x) for x in names), binary_array(found)], names=[*names, "ids"]
        )


def _assembled(path: str, table: pa.Table) -> pa.Table:
    """Of one document: leaves of each piece joined as a tree, and all parts in order."""
    known = vocabulary(path)
    table = table.sort_by([("part", "ascending"), ("leaf", "ascending")])
    part = table.column("part").to_numpy()
    each = [np.frombuffer(x, np.uint32) for x in table.column("ids").to_pylist()]
    starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])).tolist()
    joined = [
        concatenate(known, each[a:b]) for a, b in zip(starts, [*starts[1:], len(part)], strict=True)
    ]
    return pa.table(
        {
            "doc_id": table.column("doc_id").slice(0, 1),
            "ids": binary_array([np.concatenate(joined).astype("<u4", copy=False).tobytes()]),
        }
    )


def _assembled_rows(texts: DataFrame, files: Tokenizer) -> DataFrame:
    spark = texts.sparkSession
    parts = held_packed(
        texts.withColumn("row", F.monotonically_increasing_id()).mapInArrow(partial(_cut, files), _PARTS)
    )
    # Every leaf is dealt by itself, so a long piece is encoded by many tasks.
    leaves = parts.repartition(partitions(spark), "row", "part", "leaf").mapInArrow(
        partial(_leaves, files.path), "row long, doc_id long, part long, leaf long, ids binary"
    )
    return leaves.groupBy("row").applyInArrow(lambda table: _assembled(files.path, table), _IDS)


def _each(docs: DataFrame, files: Tokenizer, after: Callable, schema: str) -> DataFrame:
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    plain = texts.mapInArrow(lambda batches: after(_plain(files, batches)), schema)
    return plain.unionByName(_assembled_rows(texts, files).mapInArrow(after, schema))


def _as_they_are(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from batches


def encode(docs: DataFrame, files: Tokenizer) -> DataFrame:
    """(doc_id, ids): ids of each row as little-endian unsigned 32-bit numbers, for rows (doc_id, text)."""
    return _each(docs, files, _as_they_are, _IDS)


def _decoded(path: str, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = vocabulary(path)
    for batch in batches:
        texts = [
            None if x is None else known.decode(np.frombuffer(x, np.uint32))
            for x in batch.column("ids").to_pylist()
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"]
        )


def decode(encoded: DataFrame, files: Tokenizer) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids)."""
    return encoded.select("doc_id", "ids").mapInArrow(
        partial(_decoded, files.path), "doc_id long, text string"
    )


_DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _digests(path: str, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = vocabulary(path)
    for batch in batches:
        count, ids, decoded = [], [], []
        for packed in batch.column("ids").to_pylist():
            found = np.frombuffer(packed, np.uint32)
            count.append(len(found))
            ids.append(hashlib.sha256(packed).hexdigest())
            decoded.append(hashlib.sha256(known.decode(found).encode()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(count, pa.int64()),
                pa.array(ids, pa.string()),
                pa.array(decoded, pa.string()),
            ],
            names=[x.split()[0] for x in _DIGESTS.split(", ")],
        )


def digests(docs: DataFrame, files: Tokenizer) -> DataFrame:
    """Per row doc_id, n_tokens, and SHA-256 of its ids and of the text decoded from them; ids of
    documents without long pieces never leave the task that makes them."""
    return _each(docs, files, partial(_digests, files.path), _DIGESTS)
