"""Small tables with the awkward cases every operator must handle."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, hash long, key string, "
    "row long, bucket long, prediction string, _words long, _kept string, label long, node long"
)
EMPTY = SCHEMA


def sentence(rng: random.Random, count: int, stock: list[str]) -> str:
    return " ".join(rng.choice(stock) for _ in range(count))


def texts(seed: int = 7) -> list[str | None]:
    rng = random.Random(seed)
    stock = ["".join(rng.choice("abdegilmnorstu") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    passage = sentence(rng, 70, stock)
    base = sentence(rng, 200, stock)
    near = base.split(" ")
    near[20], near[150] = "zzz", "yyy"
    far = base.split(" ")
    far[::15] = ["q%d" % k for k in range(len(far[::15]))]
    return [
        None,
        "",
        " \t\n\x0b\x0c\r ",
        "word",
        "Two Words",
        "two words",
        "...!? 123",
        "日本語 テキスト 🙂 ñandú ÉTÉ",
        base,
        base,
        " ".join(near),
        " ".join(far),
        sentence(rng, 40, stock) + " " + passage + " " + sentence(rng, 50, stock),
        passage + " " + sentence(rng, 30, stock),
        passage,
        "spam " * 120,
        "ab" * 300,
        "the cat <|endoftext|> sat\n\n on  the mat's 'end",
        sentence(rng, 6000, stock),
        "A" * 99,
        "B" * 100 + "C" + "B" * 100,
        *(sentence(rng, rng.randint(1, 60), stock) for _ in range(20)),
    ]


def rows(seed: int = 7) -> list[tuple]:
    """Ids out of order, one missing; one row twice; clashing extra columns."""
    found = texts(seed)
    ids: list[int | None] = [3 * k - 20 for k in range(len(found))]
    ids[4] = None
    langs = ["en", "fr", None, "de"]
    out = [
        (
            doc_id,
            text,
            langs[k % 4],
            None if k % 5 == 0 else f"src{k % 3}",
            None if text is None else len(text),
            k, "key", k, 1, "p", 5, "kept", 2, 3,
        )
        for k, (doc_id, text) in enumerate(zip(ids, found, strict=True))
    ]
    random.Random(seed).shuffle(out)
    return out


def documents(spark, seed: int = 7, parts: int = 3):
    return spark.createDataFrame(rows(seed), SCHEMA).repartition(parts, "row")


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
