"""A hidden Markov language model, trained and applied in Spark.

A token is a word or the end of a text. Each word has emissions of its own in every
state: its expected counts there, plus a share that it has in common with the words of
its ending, its last letters. An ending's share in a state is the expected number of its
distinct words there, dealt evenly to those words and one more part, which is kept for
words never seen. The probability of a text is summed exactly over all paths of states
by the scaled forward recursion.

* Blocks exchange word counts: each sends its distinct words with their
  training counts, a bucket adds them up and answers each block with the totals and with
  each word's number in the bucket. Then a block is stored as numbers of its words; texts
  are not read again.
* Each round of Baum-Welch is an exchange of expected counts per word and state. Keys
  do not travel again, numbers do. A word's count in a state travels as its share of the word's whole
  count, which both sides know, in steps of 1/65535. An ending is sent by one block.
* A round's table replaces that of the round before. Only tables of fixed size reach the
  driver: beginnings, moves, and sums by state and ending.

Words are identified by 64-bit hashes.

Defined cases: a null text counts as empty and has the end alone; without
training texts all tokens are unknown; rows that repeat each count and get their own
result. Columns other than doc_id, text and held_out are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.llm import blocks as B
from stopwise.llm.hmm import Hmm, expected_counts, log10_likelihood
from stopwise.llm.shared import delete, held_dealt, partitions, reclaim, stored_until
from stopwise.llm.textkit import LOWER, NOT_SPACE, Chunk, Hasher, binary_array, chunks, let_go, mix, words

STATES = 6
ROUNDS = 6
ENDINGS = 2048  # classes of words by their last letters
_HASHER = Hasher(6)
_U = np.uint64

# Symbols of a block: the end, then its distinct words.
_END = 0


def _endings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    value = np.zeros(len(starts), _U)
    for k in range(1, 4):
        inside = ends - k >= starts
        byte = np.where(inside, data[np.maximum(ends - k, 0)], 0).astype(_U)
        value = value * _U(257) + byte
    return 1 + (mix(value + _U(1)) % _U(ENDINGS)).astype(np.int64)


@dataclass
class _Tokens:
    hashes: np.ndarray  # of all words of a block
    endings: np.ndarray
    counts: np.ndarray  # words by row


def _tokens(batch: pa.RecordBatch) -> _Tokens:
    hashes, endings, counts = [np.empty(0, _U)], [np.empty(0, np.int64)], []
    for chunk in chunks(batch.column("text")):
        data = LOWER[chunk.data]
        found = words(Chunk(chunk.first, data, chunk.offsets), NOT_SPACE)
        hashes.append(_HASHER.spans(data, found.starts, found.ends))
        endings.append(_endings(data, found.starts, found.ends))
        counts.append(found.counts())
    return _Tokens(
        np.concatenate(hashes),
        np.concatenate(endings),
        np.concatenate(counts) if counts else np.empty(0, np.int64),
    )


def _training(batch: pa.RecordBatch) -> np.ndarray:
    return ~batch.column("held_out").fill_null(False).to_numpy(zero_copy_only=False)


def _send(count: int, block_id: int, batch: pa.RecordBatch):
    """Distinct words of a block: hash, ending class, training count."""
    found = _tokens(batch)
    some, number, _, bounds = B.distinct_keys(found.hashes, count)
    used = np.repeat(_training(batch), found.counts)
    n = np.bincount(number, used, minlength=len(some)).astype(np.int64)
    ending = np.zeros(len(some), np.int64)
    ending[number] = found.endings
    parts = np.flatnonzero(np.diff(bounds))
    cut = [slice(bounds[b], bounds[b + 1]) for b in parts]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(parts, pa.int64()),
            pa.array([block_id] * len(parts), pa.int64()),
            binary_array([some[c].tobytes() for c in cut]),
            binary_array([_squeeze(n[c]) for c in cut]),
            binary_array([_squeeze(ending[c]) for c in cut]),
        ],
        names=["bucket", "block_id", "keys", "n", "endings"],
    )


def _squeeze(values: np.ndarray) -> bytes:
    return B.pack_ints(np.cumsum(values))


def _unsqueeze(packed: bytes) -> np.ndarray:
    return np.diff(B.unpack_ints(packed), prepend=0)


# --- packed arrays -------------------------------------------------------------------------


def _narrow(values: np.ndarray) -> np.ndarray:
    """Integers in as few bytes as they need."""
    if values.dtype.kind not in "iu" or not len(values):
        return values
    kind = np.promote_types(np.min_scalar_type(values.min()), np.min_scalar_type(values.max()))
    return values.astype(kind)


def _arrays(**values: np.ndarray) -> bytes:
    """Arrays of any lengths as one compressed row."""
    narrow = {name: _narrow(x) for name, x in values.items()}
    head = ",".join(f"{name}:{x.dtype.str}:{len(x)}" for name, x in narrow.items()).encode()
    data = [len(head).to_bytes(4, "little"), head, *(x.tobytes() for x in narrow.values())]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(data))


def _from_arrays(packed: bytes) -> dict[str, np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(packed)
    at = 4 + int.from_bytes(data[:4], "little")
    out = {}
    for part in data[4:at].decode().split(","):
        name, kind, size = part.split(":")
        values = np.frombuffer(data, kind, int(size), at)
        at += values.nbytes
        out[name] = values.astype(np.int64) if values.dtype.kind in "iu" else values
    return out


_STEPS = 65535


def _shares(expected: np.ndarray, cut: Iterable[slice]) -> list[bytes]:
    """Which part of each word's count is in each state but the last, state by state; a text of
    bytes for each range of words."""
    total = expected.sum(axis=1, keepdims=True)
    part = np.divide(expected, total, out=np.zeros_like(expected), where=total > 0)
    steps = np.rint(part[:, :-1].T * _STEPS).astype("<u2")
    packer = zstandard.ZstdCompressor(level=1)
    return [packer.compress(np.ascontiguousarray(steps[:, x]).tobytes()) for x in cut]


def _from_shares(packed: Iterable[bytes], counts: np.ndarray, states: int) -> np.ndarray:
    """The counts dealt to states again, of ranges of words that follow one another."""
    part = np.empty((len(counts), states))
    unpacker, at = zstandard.ZstdDecompressor(), 0
    for one in packed:
        steps = np.frombuffer(unpacker.decompress(one), "<u2").reshape(states - 1, -1)
        part[at : at + steps.shape[1], :-1] = steps.T
        at += steps.shape[1]
    part[:, -1] = np.maximum(0, _STEPS - part[:, :-1].sum(axis=1))
    return part * (counts / part.sum(axis=1))[:, None]


_TOTALS = (
    "block_id long, bucket long, known binary, bits binary, words long, tokens long, "
    "types binary, sums binary"
)


def _shaken(hashes: np.ndarray, states: int) -> np.ndarray:
    """Factors that shake each word's emissions apart, the same wherever it occurs."""
    out = np.empty((len(hashes), states))
    for k in range(states):
        one, two = (
            ((mix(hashes + _U(2 * k + j + 17)) >> _U(11)).astype(np.float64) + 1) / 2.0**53
            for j in (0, 1)
        )
        out[:, k] = np.exp(0.7 * np.sqrt(-2 * np.log(one)) * np.cos(2 * np.pi * two))
    return out


def _first_expected(hashes: np.ndarray, counts: np.ndarray, states: int) -> np.ndarray:
    parts = _shaken(hashes, states)
    return counts[:, None] * parts / parts.sum(axis=1, keepdims=True)


def _head(begin: np.ndarray, move: np.ndarray, end: np.ndarray) -> np.ndarray:
    return np.concatenate([begin[None, :], move, end[None, :]])


def _summed(head: np.ndarray, expected: np.ndarray, endings: np.ndarray) -> bytes:
    """Of one bucket: beginnings, moves, ends, expected words, and distinct words by ending."""
    total = expected.sum(axis=1)
    kinds = expected / np.where(total > 0, total, 1)[:, None]
    by_ending = np.stack(
        [np.bincount(endings, kinds[:, k], minlength=ENDINGS + 1) for k in range(expected.shape[1])],
        axis=1,
    )
    return np.concatenate([head, expected.sum(axis=0)[None, :], by_ending]).astype("<f8").tobytes()


def _totals(states: int, table: pa.Table) -> pa.Table:
    """Of one bucket: to every block its words' counts over all blocks, their numbers among the
    bucket's trained words, whether the block is the first that has the word for training, and
    the first model's shares; on one row also the bucket's sums and words by ending."""
    table = table.sort_by("block_id")
    keys = [np.frombuffer(x, _U) for x in table.column("keys").to_pylist()]
    some, first, number = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    n = np.concatenate([_unsqueeze(x) for x in table.column("n").to_pylist()])
    ending = np.concatenate([_unsqueeze(x) for x in table.column("endings").to_pylist()])[first]
    c = np.bincount(number, n, minlength=len(some)).astype(np.int64)
    trained = c > 0
    place = np.cumsum(trained) - 1
    used = np.flatnonzero(n > 0)
    owner = np.zeros(len(number), bool)
    owner[used[np.unique(number[used], return_index=True)[1]]] = True
    expected = _first_expected(some, c, states)
    known, answers = [], []
    end = 0
    for key in keys:
        own = slice(end, end + len(key))
        end += len(key)
        mine = number[own]
        had = trained[mine]
        known.append(
            _arrays(c=c[mine].astype(np.int64), place=place[mine[had]].astype(np.int64), owner=owner[own][had])
        )
        answers += _shares(expected[mine[had]], [slice(None)])
    types = np.bincount(ending[trained], minlength=ENDINGS + 1).astype(np.int64)
    rest = len(keys) - 1
    return pa.table(
        {
            "block_id": table.column("block_id"),
            "bucket": table.column("bucket"),
            "known": binary_array(known),
            "bits": binary_array(answers),
            "words": pa.array([int(trained.sum())] + [0] * rest, pa.int64()),
            "tokens": pa.array([int(c.sum())] + [0] * rest, pa.int64()),
            "types": binary_array([_squeeze(types)] + [b""] * rest),
            "sums": binary_array(
                [_summed(np.zeros((states + 2, states)), expected, ending)] + [b""] * rest
            ),
        }
    )


@dataclass(frozen=True)
class Vocabulary:
    """What the corpus says about words, in tables of fixed size."""

    texts: int  # training texts, and so ends
    words: int  # distinct words
    tokens: int  # words and ends
    types: np.ndarray  # distinct words by ending


def _types(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(ENDINGS + 1, np.int64)
    for batch in batches:
        for packed in batch.column("types").to_pylist():
            total += _unsqueeze(packed)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(len(total))), pa.array(total)], names=["ending", "types"]
    )


def _vocabulary(answers: DataFrame, texts: int) -> Vocabulary:
    sums = answers.agg(F.sum("words"), F.sum("tokens")).first()
    types = np.zeros(ENDINGS + 1, np.int64)
    for row in (
        answers.where("length(types) > 0").select("types").mapInArrow(_types, "ending long, types long")
        .groupBy("ending").agg(F.sum("types").alias("types")).collect()
    ):
        types[row["ending"]] = row["types"]
    return Vocabulary(texts, sums[0] or 0, (sums[1] or 0) + texts, types)


@dataclass(frozen=True)
class WordModel:
    """The parts of the model that do not grow with the vocabulary."""

    begin: np.ndarray  # by state
    move: np.ndarray  # state x state
    end: np.ndarray  # emission of the end by state
    share: np.ndarray  # ending x state: what each of its words has besides its own counts
    total: np.ndarray  # by state: sum of all words' counts and shares, and of ends

    def with_words(self, expected: np.ndarray, endings: np.ndarray) -> Hmm:
        """The model over the end and the given words."""
        emit = (expected + self.share[endings]) / self.total
        return Hmm(self.begin, self.move, np.concatenate([self.end[None, :], emit]))


def word_model(sums: np.ndarray, types: np.ndarray) -> WordModel:
    """From sums of all buckets, laid out as by ``_summed``."""
    states = sums.shape[1]
    begin, move = sums[0] + 0.1, sums[1 : states + 1] + 0.1
    end, counted = sums[states + 1] + 0.1, sums[states + 2]
    # Every state keeps a little of every ending.
    kinds = sums[states + 3 :] + 0.1 * (types + 1)[:, None] / states
    kinds[0] = 0
    total = counted + kinds.sum(axis=0) + end
    return WordModel(
        begin / begin.sum(),
        move / move.sum(axis=1, keepdims=True),
        end / total,
        kinds / (types + 1)[:, None],
        total,
    )


def _added(states: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((states + 3 + ENDINGS + 1, states))
    for batch in batches:
        for packed in batch.column("sums").to_pylist():
            total += np.frombuffer(packed, "<f8").reshape(total.shape)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(len(total)))]
        + [pa.array(np.ascontiguousarray(total[:, k])) for k in range(states)],
        names=["place", *(f"s{k}" for k in range(states))],
    )


def _all_sums(answers: DataFrame, states: int) -> np.ndarray:
    names = [f"s{k}" for k in range(states)]
    rows = (
        answers.where("length(sums) > 0").select("sums")
        .mapInArrow(partial(_added, states), "place long, " + ", ".join(f"{x} double" for x in names))
        .groupBy("place").agg(*(F.sum(x).alias(x) for x in names))
        .toArrow()
    )
    out = np.zeros((states + 3 + ENDINGS + 1, states))
    out[rows.column("place").to_numpy()] = np.stack([rows.column(x).to_numpy() for x in names], axis=1)
    return out


# --- blocks as numbers of their words ------------------------------------------------------


def _prepare(count: int, block_id: int, batch: pa.RecordBatch, answers: dict[int, bytes]):
    """A block without its texts: per row the words by number among the block's distinct words,
    per word its ending and counts, per trained word its place in its bucket."""
    found = _tokens(batch)
    some, number, _, bounds = B.distinct_keys(found.hashes, count)
    endings = np.zeros(len(some), np.int64)
    endings[number] = found.endings
    training = _training(batch)
    n = np.bincount(number, np.repeat(training, found.counts), minlength=len(some)).astype(np.int64)
    c = np.zeros(len(some), np.int64)
    places, owners = [np.empty(0, np.int64)], [np.empty(0, bool)]
    for bucket in sorted(answers):
        got = _from_arrays(answers[bucket])
        c[bounds[bucket] : bounds[bucket + 1]] = got["c"]
        places.append(got["place"])
        owners.append(got["owner"])
    kept = batch.select([B.ORDER, "held_out"])
    packed = _arrays(
        counts=found.counts.astype(np.int64),
        number=number.astype(np.int32),
        endings=endings.astype(np.uint16),
        n=n,
        c=c,
        bounds=bounds.astype(np.int64),
        place=np.concatenate(places).astype(np.int64),
        owner=np.concatenate(owners).astype(bool),
    )
    yield pa.RecordBatch.from_arrays(
        [pa.array([block_id]), binary_array([B.write_table(pa.Table.from_batches([kept]))]), binary_array([packed])],
        names=["block_id", "rows", "block"],
    )


_PREPARED = "block_id long, rows binary, block binary"


class _Prepared:
    def __init__(self, rows: bytes, packed: bytes) -> None:
        self.rows = B.read_block(rows)
        got = _from_arrays(packed)
        self.counts, self.number = got["counts"], got["number"].astype(np.int64)
        self.endings, self.n, self.c = got["endings"].astype(np.int64), got["n"], got["c"]
        self.place, self.owner = got["place"], got["owner"].astype(bool)
        self.trained = np.flatnonzero(self.c > 0)
        self.bounds = np.searchsorted(self.trained, got["bounds"])  # of buckets, among these

    def expected(self, answers: dict[int, bytes], states: int) -> np.ndarray:
        """Expected counts over all blocks of this block's words."""
        out = np.zeros((len(self.c), states))
        some = [b for b in sorted(answers) if self.bounds[b] < self.bounds[b + 1]]
        if some:
            mine = np.concatenate([self.trained[self.bounds[b] : self.bounds[b + 1]] for b in some])
            out[mine] = _from_shares((answers[b] for b in some), self.c[mine], states)
        return out


def _met(prepared: DataFrame, answers: DataFrame, work, schema: str) -> DataFrame:
    """Apply a function to each prepared block and the answers it got."""
    got = answers.groupBy("block_id").agg(
        F.collect_list(F.struct("bucket", "bits")).alias("answers")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pairs = batch.column("answers")[i].as_py() or []
                own = _Prepared(batch.column("rows")[i].as_py(), batch.column("block")[i].as_py())
                bits = {x["bucket"]: x["bits"] for x in pairs}
                yield from work(batch.column("block_id")[i].as_py(), own, bits)
                del own, bits, pairs
                let_go()

    return (
        prepared.join(got, "block_id", "left")
        .select("block_id", "rows", "block", "answers")
        .mapInArrow(run, schema)
    )


_SENT = "bucket long, block_id long, place binary, shares binary, head binary"


def _expectation(shared, block_id: int, own: _Prepared, answers: dict[int, bytes]):
    """A block's Baum-Welch counts over its training texts, by bucket of its words."""
    model = shared.value
    states = len(model.begin)
    training = _training(own.rows)
    used = np.repeat(training, own.counts)
    lengths = own.counts[training]
    begin, move, emit = expected_counts(
        model.with_words(own.expected(answers, states), own.endings),
        _with_ends(1 + own.number[used], lengths),
        lengths + 1,
        np.float32,
    )
    # A block without words still has beginnings and ends.
    parts = np.flatnonzero(np.diff(own.bounds)) if len(own.trained) else np.zeros(1, np.int64)
    mine = [slice(own.bounds[b], own.bounds[b + 1]) for b in parts]
    n, endings = own.n[own.trained], own.endings[own.trained]
    places = [
        _arrays(
            place=np.diff(own.place[c], prepend=0),
            n=n[c],
            owner=own.owner[c],
            endings=endings[c][own.owner[c]],
        )
        for c in mine
    ]
    head = _head(begin, move, emit[_END]).astype("<f8").tobytes()
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(parts, pa.int64()),
            pa.array([block_id] * len(parts), pa.int64()),
            binary_array(places),
            binary_array(_shares(emit[1:][own.trained], mine)),
            binary_array([head] + [b""] * (len(parts) - 1)),
        ],
        names=[x.split()[0] for x in _SENT.split(", ")],
    )


def _expected_totals(states: int, table: pa.Table) -> pa.Table:
    """Of one bucket: to every block the shares of its words over all blocks, and the sums."""
    table = table.sort_by("block_id")
    sent = [_from_arrays(x) for x in table.column("place").to_pylist()]
    places = [np.cumsum(x["place"]) for x in sent]
    size = max((int(x[-1]) + 1 for x in places if len(x)), default=0)
    expected, endings = np.zeros((size, states)), np.zeros(size, np.int64)
    for got, place, packed in zip(sent, places, table.column("shares").to_pylist(), strict=True):
        if len(place):
            expected[place] += _from_shares([packed], got["n"], states)
            endings[place[got["owner"].astype(bool)]] = got["endings"]
    head = np.zeros((states + 2, states))
    for packed in table.column("head").to_pylist():
        if packed:
            head += np.frombuffer(packed, "<f8").reshape(head.shape)
    rest = [b""] * (len(places) - 1)
    return pa.table(
        {
            "block_id": table.column("block_id"),
            "bucket": table.column("bucket"),
            "bits": binary_array([_shares(expected[place], [slice(None)])[0] for place in places]),
            "sums": binary_array([_summed(head, expected, endings), *rest]),
        }
    )


def _with_ends(symbols: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return np.insert(symbols, np.cumsum(counts), _END)


def _first_model(counted: DataFrame, vocabulary: Vocabulary, states: int) -> WordModel:
    """States that stay, with words shaken apart."""
    sums = _all_sums(counted, states)
    sums[0] = vocabulary.texts / states
    move = np.full((states, states), 0.05 / max(1, states - 1))
    np.fill_diagonal(move, 0.95 if states > 1 else 1.0)
    sums[1 : states + 1] = move * vocabulary.tokens / states
    sums[states + 1] = vocabulary.texts / states
    return word_model(sums, vocabulary.types)


def train(
    prepared: DataFrame,
    counted: DataFrame,
    before: str,
    vocabulary: Vocabulary,
    states: int,
    rounds: int,
) -> tuple[WordModel, DataFrame]:
    """Baum-Welch over stored blocks: the model, and the table of expected counts that
    belongs to it. Each round is one pass over all training texts, and its table replaces
    the one before, the first that of the counts in the folder ``before``."""
    spark = prepared.sparkSession
    model = _first_model(counted, vocabulary, states)
    answers = counted.select("block_id", "bucket", "bits")
    for _ in range(rounds if vocabulary.texts else 0):
        shared = spark.sparkContext.broadcast(model)
        sent = _met(prepared, answers, partial(_expectation, shared), _SENT)
        totals, path = stored_until(
            sent.groupBy("bucket").applyInArrow(
                lambda table: _expected_totals(states, table),
                "block_id long, bucket long, bits binary, sums binary",
            )
        )
        model = word_model(_all_sums(totals, states), vocabulary.types)
        answers = totals.select("block_id", "bucket", "bits")
        shared.unpersist()
        delete(spark, before)
        before = path
        del sent, totals
        reclaim(spark)
    return model, answers


SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double"
)


def _score(shared, block_id: int, own: _Prepared, answers: dict[int, bytes]):
    vocabulary, model = shared.value
    expected = own.expected(answers, len(model.begin))
    c = own.c[own.number]
    n_rows = len(own.counts)
    rows = np.repeat(np.arange(n_rows), own.counts)

    def per_row(values: np.ndarray) -> np.ndarray:
        return np.bincount(rows, values, minlength=n_rows)

    tokens = own.counts + 1
    floor = np.log10(vocabulary.tokens + vocabulary.words + (vocabulary.texts > 0) + 1)
    base = per_row(np.log10(c + 1)) + np.log10(vocabulary.texts + 1) - tokens * floor
    hmm = model.with_words(expected, own.endings)
    likely = log10_likelihood(hmm, _with_ends(1 + own.number, own.counts), tokens)
    yield pa.RecordBatch.from_arrays(
        [
            own.rows.column(B.ORDER),
            own.rows.column("held_out").fill_null(False),
            pa.array(tokens.astype(np.int64)),
            pa.array((per_row(c > 0) + (vocabulary.texts > 0)).astype(np.int64)),
            pa.array(np.full(n_rows, vocabulary.tokens, np.int64)),
            pa.array(base),
            pa.array(likely),
        ],
        names=[x.split()[0] for x in SCORES.split(", ")],
    )


def scores(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """Scores of all rows (doc_id, text, held_out), learned from those not held out."""
    spark = docs.sparkSession
    only = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.coalesce(F.col("held_out"), F.lit(False)).alias("held_out"),
    )
    # Blocks are dealt by number once; from then on answers come to them.
    dealt = 2 * partitions(spark)
    held = B.store_blocks(only, dealt=dealt)
    reclaim(spark)
    size = held.agg(F.sum("bytes")).first()[0] or 0
    count = B.bucket_count(size // 24, held)
    texts = only.where(~F.col("held_out")).count()
    sent = B.map_blocks(
        held,
        partial(_send, count),
        "bucket long, block_id long, keys binary, n binary, endings binary",
    )
    counted, path = stored_until(
        sent.groupBy("bucket").applyInArrow(lambda table: _totals(states, table), _TOTALS)
    )
    del sent
    reclaim(spark)
    prepared = held_dealt(
        B.answer_blocks(
            held,
            counted.select("block_id", "bucket", F.col("known").alias("bits")),
            partial(_prepare, count),
            _PREPARED,
        ),
        dealt,
        "block_id",
    )
    # The texts are not needed any more.
    del held
    reclaim(spark)
    vocabulary = _vocabulary(counted, texts)
    model, answers = train(prepared, counted, path, vocabulary, states, rounds)
    shared = spark.sparkContext.broadcast((vocabulary, model))
    return _met(prepared, answers, partial(_score, shared), SCORES)
