"""Language identification by error-correcting output codes.

Each language has a codeword of bits. One binary classifier per bit, a
log-odds model over hashed byte n-grams, predicts that bit. A text gets the
language whose codeword is nearest in loss-weighted decoding: the exponential
loss of each bit's margin, weighted by how reliably that bit is predicted for
that language on the training texts. A text whose two nearest codewords are
about as near is flagged ambiguous.

Training uses all labelled rows it is given. Only sums per bit and n-gram
(a fixed number) reach the driver.

Defined cases: a null text, or one without a letter, is ``und`` with score 0
and not ambiguous; rows without a label are not learned from; with no labelled row all is ``und``;
with one language all texts with a letter get it. Each row gets its own
result, and an existing ``prediction`` column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.llm.shared import stored
from stopwise.llm.textkit import LOWER, Chunk, chunks, let_go

GRAMS = (2, 3)
FEATURES = 1 << 15
EXHAUSTIVE = 6  # up to so many languages get all distinct bits; more get random ones
SHARPNESS = 4.0
AMBIGUOUS = 0.02
UNKNOWN = "und"
PREDICTION = "struct<lang:string,score:double,ambiguous:boolean>"
_HELD = 64  # languages a task counts before it passes the counts on

_LETTERS = np.zeros(256, bool)
_LETTERS[97:123] = _LETTERS[128:] = True


def codewords(count: int) -> np.ndarray:
    """A row of +1/-1 bits per language; all rows differ, and no two bits say the same."""
    if count <= 1:
        return np.ones((count, 0), np.int8)
    if count <= EXHAUSTIVE:
        bits = np.arange(1, 1 << (count - 1))
        table = (bits[None, :] >> np.arange(count)[:, None]) & 1
    else:
        width = 10 * int(np.ceil(np.log2(count)))
        table = np.random.default_rng(count).integers(0, 2, (count, width))
        # The number of a language, as bits, keeps codewords apart.
        own = (np.arange(count)[:, None] >> np.arange(int(np.ceil(np.log2(count))))) & 1
        table = np.hstack([table, own])
        table = table[:, (table.min(axis=0) == 0) & (table.max(axis=0) == 1)]
    return (2 * table - 1).astype(np.int8)


def features(chunk: Chunk) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each gram size: hashed n-grams with a letter, and the row of each."""
    data = LOWER[chunk.data]
    letter = _LETTERS[data]
    wide = data.astype(np.uint32)
    rows = np.repeat(np.arange(len(chunk)), np.diff(chunk.offsets))
    for size in GRAMS:
        count = len(data) - size + 1
        if count <= 0:
            continue
        value = np.full(count, size, np.uint32)
        near = np.zeros(count, bool)
        for k in range(size):
            value *= np.uint32(0x01000193)
            value ^= wide[k : k + count]
            near |= letter[k : k + count]
        value ^= value >> np.uint32(15)
        value *= np.uint32(0x2C1B3C6D)
        value ^= value >> np.uint32(17)
        near &= rows[:count] == rows[size - 1 :]
        yield (value[near] & np.uint32(FEATURES - 1)).astype(np.int64), rows[:count][near]


def _gram_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, feature, n): a task's sums, passed on when it ends or holds many languages."""
    held: dict[str, np.ndarray] = {}

    def passed() -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(some), pa.string()),
                    pa.array(some.astype(np.int32)),
                    pa.array(counts[some]),
                ],
                names=["lang", "feature", "n"],
            )
        held.clear()

    for batch in batches:
        known = batch.column("lang").dictionary_encode()
        names = known.dictionary.to_pylist()
        codes = known.indices.to_numpy(zero_copy_only=False)
        for chunk in chunks(batch.column("text")):
            own = codes[chunk.first : chunk.first + len(chunk)]
            for found, rows in features(chunk):
                for code in np.unique(own).tolist():
                    counts = np.bincount(found[own[rows] == code], minlength=FEATURES)
                    name = names[code]
                    held[name] = held[name] + counts if name in held else counts
            if len(held) > _HELD:
                yield from passed()
    yield from passed()


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    codes: np.ndarray  # language x bit, +1 or -1
    weights: np.ndarray  # feature x bit, log-odds
    trust: np.ndarray  # language x bit, rows sum to the number of bits

    def margins(self, chunk: Chunk) -> np.ndarray:
        """Mean log-odds of each text's n-grams, per bit."""
        sums = np.zeros((len(chunk), self.codes.shape[1]))
        seen = np.zeros(len(chunk))
        for found, rows in features(chunk):
            if not len(rows):
                continue
            here, begin = np.unique(rows, return_index=True)
            for bit in range(sums.shape[1]):
                sums[here, bit] += np.add.reduceat(self.weights[bit][found], begin)
            seen[here] += np.diff(np.append(begin, len(rows)))
        return sums / np.maximum(seen, 1)[:, None]

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest language, its share of all nearness, and whether the next is about as near."""
        loss = np.zeros((len(margins), len(self.langs)))
        for bit in range(self.codes.shape[1]):
            agree = np.clip(SHARPNESS * margins[:, bit], -30, 30)
            loss += self.trust[:, bit] * np.exp(-agree[:, None] * self.codes[:, bit])
        loss /= max(1, self.codes.shape[1])
        best = loss.argmin(axis=1)
        near = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
        near /= near.sum(axis=1, keepdims=True)
        if len(self.langs) == 1:
            return best, np.ones(len(best)), np.zeros(len(best), bool)
        two = np.sort(near, axis=1)[:, -2:]
        return best, two[:, 1], two[:, 1] - two[:, 0] < AMBIGUOUS


def _agreement(model: Model, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per language and bit: training texts, and those whose bit is predicted right."""
    place = {lang: i for i, lang in enumerate(model.langs)}
    texts = np.zeros(len(model.langs), np.int64)
    right = np.zeros(model.codes.shape, np.int64)
    for batch in batches:
        langs = np.array([place[x] for x in batch.column("lang").to_pylist()], np.int64)
        for chunk in chunks(batch.column("text")):
            own = langs[chunk.first : chunk.first + len(chunk)]
            good = (model.margins(chunk) * model.codes[own]) > 0
            np.add.at(texts, own, 1)
            np.add.at(right, own, good)
    lang, bit = np.divmod(np.arange(right.size), max(1, right.shape[1]))
    yield pa.RecordBatch.from_arrays(
        [pa.array(lang), pa.array(bit), pa.array(texts[lang]), pa.array(right.ravel())],
        names=["lang", "bit", "texts", "right"],
    )


def fit(labelled: DataFrame) -> Model:
    """Learn from the rows (text, lang) whose text and lang are not null."""
    rows = labelled.where("text IS NOT NULL AND lang IS NOT NULL").select(
        F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    )
    counts = stored(
        rows.mapInArrow(_gram_counts, "lang string, feature int, n long")
        .groupBy("lang", "feature")
        .agg(F.sum("n").alias("n"))
    )
    langs = tuple(sorted(row[0] for row in counts.select("lang").distinct().collect()))
    codes = codewords(len(langs))
    width = codes.shape[1]
    if not width:
        return Model(langs, codes, np.zeros((0, FEATURES)), np.ones(codes.shape))
    spark = labelled.sparkSession
    signs = spark.createDataFrame(
        [(lang, [int(x) for x in code]) for lang, code in zip(langs, codes, strict=True)],
        "lang string, code array<int>",
    )
    sums = (
        counts.join(signs, "lang")
        .select("feature", "n", F.posexplode("code").alias("bit", "sign"))
        .groupBy("bit", "feature")
        .agg(
            F.sum(F.when(F.col("sign") > 0, F.col("n")).otherwise(0)).alias("yes"),
            F.sum(F.when(F.col("sign") < 0, F.col("n")).otherwise(0)).alias("no"),
        )
        .toArrow()
    )
    bit, feature = (sums.column(x).to_numpy() for x in ("bit", "feature"))
    weights = np.zeros((width, FEATURES))
    for name, sign in (("yes", 1), ("no", -1)):
        n = np.full((width, FEATURES), 0.5)
        n[bit, feature] += sums.column(name).to_numpy()
        weights += sign * np.log(n / n.sum(axis=1, keepdims=True))
    model = Model(langs, codes, weights, np.ones(codes.shape))
    known = (
        rows.mapInArrow(
            partial(_agreement, model), "lang long, bit long, texts long, right long"
        )
        .groupBy("lang", "bit")
        .agg(F.sum("texts").alias("texts"), F.sum("right").alias("right"))
        .collect()
    )
    trust = np.zeros(codes.shape)
    for row in known:
        trust[row["lang"], row["bit"]] = (row["right"] + 1) / (row["texts"] + 2)
    trust *= width / trust.sum(axis=1, keepdims=True)
    return Model(langs, codes, weights, trust)


def predict(docs: DataFrame, model: Model, name: str = "prediction") -> DataFrame:
    """The rows with a struct column (lang, score, ambiguous), from text alone; it replaces a column
    of that name."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(PREDICTION)
    def decoded(texts: pa.Array) -> pa.Array:
        known = shared.value
        langs, scores, flags = [], [], []
        for chunk in chunks(texts):
            best, score, near = known.decode(known.margins(chunk))
            langs += [known.langs[i] for i in best.tolist()]
            scores.append(score)
            flags.append(near)
        kept = (np.concatenate(x) if x else np.empty(0) for x in (scores, flags))
        score, near = kept
        let_go()
        return pa.StructArray.from_arrays(
            [
                pa.array(langs, pa.string()),
                pa.array(score, pa.float64()),
                pa.array(near.astype(bool), pa.bool_()),
            ],
            names=["lang", "score", "ambiguous"],
        )

    unknown = F.struct(
        F.lit(UNKNOWN).alias("lang"),
        F.lit(0.0).alias("score"),
        F.lit(False).alias("ambiguous"),
    )
    text = F.col("text").cast("string")
    if not model.langs:
        return docs.withColumn(name, unknown)
    has_letter = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    found = docs.withColumn(name, decoded(F.coalesce(text, F.lit(""))))
    return found.withColumn(name, F.when(has_letter, F.col(name)).otherwise(unknown))
