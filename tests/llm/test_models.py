"""Language identification, language model, URL filter, chat formatting, components."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stopwise.llm import blocks, chat_format, hmm, language_id, language_model, url_filter
from stopwise.llm.components import components
from stopwise.llm.hmm import Hmm, expected_counts, log10_likelihood
from stopwise.llm.queries import RULES
from stopwise.llm.shared import crc_remainder, reachable
from tests.llm import samples

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    reachable(spark)
    return samples.documents(spark).cache()


# Language identification


def test_held_out_accuracy(spark):
    reachable(spark)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn(
        "held_out", crc_remainder(F.col("doc_id"), 4) == 2
    )
    model = language_id.fit(docs.where(~F.col("held_out")))
    # Label, source and id can't matter: the text alone is passed.
    found = language_id.predict(docs.where("held_out").select("text", "lang"), model)
    right, all_ = found.agg(
        F.sum((F.col("prediction.lang") == F.col("lang")).cast("int")), F.count("*")
    ).first()
    assert right / all_ > 0.98


def test_predictions_of_awkward_rows(spark, docs):
    model = language_id.fit(docs)
    assert set(model.langs) == {"en", "fr", "de"}
    rows = language_id.predict(docs, model).collect()
    assert len(rows) == docs.count()
    for row in rows:
        p = row.prediction
        assert 0 <= p.score <= 1
        letter = any(ch.isalpha() for ch in row.text or "")
        assert (p.lang == "und") == (not letter)
        if not letter:
            assert p.score == 0 and not p.ambiguous
    empty = samples.no_documents(spark)
    nothing = language_id.fit(empty)
    assert {r.prediction.lang for r in language_id.predict(docs, nothing).collect()} == {"und"}
    assert language_id.predict(empty, model).count() == 0
    one = language_id.fit(docs.where("lang = 'fr'"))
    assert {r.prediction.lang for r in language_id.predict(docs, one).collect()} == {"fr", "und"}


@pytest.mark.parametrize("count", [0, 1, 2, 3, 4, 6, 7, 40])
def test_codewords_differ(count):
    codes = language_id.codewords(count)
    assert len({tuple(row) for row in codes.tolist()}) == count
    if count > 1:
        assert (codes.min(axis=0) == -1).all() and (codes.max(axis=0) == 1).all()


def test_decoding_corrects_a_wrong_bit_and_flags_a_tie():
    codes = language_id.codewords(4)
    model = language_id.Model(
        ("a", "b", "c", "d"), codes, np.zeros((7, language_id.FEATURES)), np.ones(codes.shape)
    )
    margins = codes.astype(float) * 0.5
    margins[:, 3] *= -1
    best, _, near = model.decode(margins)
    assert best.tolist() == [0, 1, 2, 3] and not near.any()
    _, score, near = model.decode(np.zeros((1, 7)))
    assert near[0] and score[0] == pytest.approx(0.25)


# Language model


def brute_paths(model: Hmm, symbols: list[int]) -> float:
    """Sum over all state paths."""
    now = model.begin * model.emit[symbols[0]]
    for s in symbols[1:]:
        now = np.array([sum(now[i] * model.move[i, j] for i in range(len(now))) for j in range(len(now))])
        now = now * model.emit[s]
    return math.log10(now.sum())


def random_model(states: int, symbols: int) -> Hmm:
    rng = np.random.default_rng(4)
    begin, move, emit = rng.random(states), rng.random((states, states)), rng.random((symbols, states))
    return Hmm(begin / begin.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def test_forward_is_exact():
    model = random_model(3, 5)
    rng = random.Random(2)
    texts = [[rng.randrange(5) for _ in range(n)] for n in (1, 7, 3, 1, 12, 400)]
    found = log10_likelihood(model, np.array(sum(texts, [])), np.array([len(t) for t in texts]))
    assert found == pytest.approx([brute_paths(model, t) for t in texts], rel=1e-10)


def test_baum_welch_counts_and_climb():
    model = random_model(2, 4)
    rng = random.Random(3)
    texts = [[rng.choice([0, 0, 1]) for _ in range(9)] + [rng.choice([2, 3]) for _ in range(9)] for _ in range(8)]
    flat, lengths = np.array(sum(texts, [])), np.array([len(t) for t in texts])
    begin, move, emit = expected_counts(model, flat, lengths)
    assert begin.sum() == pytest.approx(8)
    assert move.sum() == pytest.approx(sum(len(t) - 1 for t in texts))
    assert emit.sum(axis=1) == pytest.approx(np.bincount(flat, minlength=4))
    # Counts add up over texts, which is what lets partitions be added.
    parts = [expected_counts(model, np.array(t), np.array([len(t)])) for t in texts]
    assert sum(p[1] for p in parts) == pytest.approx(move)
    before = log10_likelihood(model, flat, lengths).sum()
    for _ in range(5):
        begin, move, emit = expected_counts(model, flat, lengths)
        model = Hmm(begin / begin.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
        after = log10_likelihood(model, flat, lengths).sum()
        assert after >= before - 1e-9
        before = after


@pytest.mark.parametrize("kind, close", [(np.float64, 1e-9), (np.float32, 2e-3)])
def test_pieces_side_by_side_change_nothing(monkeypatch, kind, close):
    rng = np.random.default_rng(3)
    move, emit = rng.random((4, 4)) ** 6 + 1e-6, rng.random((50, 4)) ** 8 + 1e-9
    model = Hmm(np.array([0.7, 0.1, 0.1, 0.1]), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    lengths = np.array([1, 7, 8, 9, 16, 17, 300, 3, 24, 25])
    symbols = rng.integers(0, 50, lengths.sum())
    whole = expected_counts(model, symbols, lengths, kind), log10_likelihood(model, symbols, lengths)
    monkeypatch.setattr(hmm, "PIECE", 8)
    assert len(hmm.Pieces(lengths).heads.active) == len(hmm.Pieces(lengths).rest.active) == 8
    cut = expected_counts(model, symbols, lengths, kind), log10_likelihood(model, symbols, lengths)
    for a, b in zip(cut[0], whole[0], strict=True):
        np.testing.assert_allclose(a, b, rtol=close, atol=close)
    np.testing.assert_allclose(cut[1], whole[1], rtol=1e-12)
    assert cut[0][2].sum() == pytest.approx(lengths.sum())


def test_scores_and_base(spark, docs, monkeypatch):
    monkeypatch.setattr(blocks.store_blocks, "__defaults__", (3000,))
    rows = docs.withColumn("held_out", F.col("row") % 4 == 1)
    found = {(r.doc_id, r.held_out, r.n_tokens): r for r in language_model.scores(rows, rounds=2).collect()}
    tokens = [
        (r.doc_id, r.held_out, re.findall(r"[^\x20\x09-\x0D]+", (r.text or "").translate(LOWER)) + [None])
        for r in rows.collect()
    ]
    counts = Counter(t for _, held, own in tokens if not held for t in own)
    total, kinds = sum(counts.values()), len(counts)
    assert len(found) == len(tokens)
    for doc_id, held, own in tokens:
        row = found[doc_id, held, len(own)]
        base = sum(math.log10((counts[t] + 1) / (total + kinds + 1)) for t in own)
        assert row.n_known == sum(counts[t] > 0 for t in own)
        assert row.train_tokens == total
        assert row.base_score == pytest.approx(base)
        assert row.score < 0 and math.isfinite(row.score)
    none = language_model.scores(rows.withColumn("held_out", F.lit(True)), rounds=1).collect()
    assert {r.n_known for r in none} == {0} and len(none) == len(tokens)
    empty = samples.no_documents(spark).withColumn("held_out", F.lit(False))
    assert language_model.scores(empty, rounds=1).count() == 0


def one_machine(texts: list[str | None], held: list[bool], states: int, rounds: int) -> np.ndarray:
    """Scores by plain Baum-Welch over all texts at once, with counts in full precision."""
    L = language_model
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string()), "held_out": held})
    tokens = L._tokens(batch)
    some, number, _, _ = blocks.distinct_keys(tokens.hashes, 1)
    endings = np.zeros(len(some), np.int64)
    endings[number] = tokens.endings
    training = ~np.array(held)
    used = np.repeat(training, tokens.counts)
    c = np.bincount(number[used], minlength=len(some))
    types = np.bincount(endings[c > 0], minlength=L.ENDINGS + 1)
    expected = L._first_expected(some, c, states)
    head = np.full((states, states), 0.05 / (states - 1))
    np.fill_diagonal(head, 0.95)
    n = int(training.sum())
    first = np.concatenate(
        [np.full((1, states), n / states), head * (c.sum() + n) / states, np.full((1, states), n / states)]
    )

    def model(head: np.ndarray) -> L.WordModel:
        sums = np.frombuffer(L._summed(head, expected, endings)).reshape(-1, states).copy()
        return L.word_model(sums, types)

    now = model(first)
    for _ in range(rounds):
        lengths = tokens.counts[training]
        begin, move, emit = expected_counts(
            now.with_words(expected, endings), L._with_ends(1 + number[used], lengths), lengths + 1
        )
        expected = emit[1:]
        now = model(L._head(begin, move, emit[0]))
    whole = L._with_ends(1 + number, tokens.counts)
    return log10_likelihood(now.with_words(expected, endings), whole, tokens.counts + 1)


def test_training_over_blocks_equals_one_machine(spark, monkeypatch):
    """Also with a word that is a third of all, texts without words, and words seen once."""
    reachable(spark)
    monkeypatch.setattr(blocks.store_blocks, "__defaults__", (4000,))
    rng = random.Random(12)
    texts: list[str | None] = [None, "", "the", "once-only " * 3]
    for k in range(150):
        stock = [f"{'ab'[k % 2]}{rng.randrange(300)}{rng.choice(['en', 'ing', 's'])}" for _ in range(rng.randrange(60))]
        texts.append(" ".join(x for w in stock for x in rng.choice([(w,), (w, "the")])))
    held = [k % 7 == 2 for k in range(len(texts))]
    frame = spark.createDataFrame(
        [(k, t, h) for k, (t, h) in enumerate(zip(texts, held, strict=True))],
        "doc_id long, text string, held_out boolean",
    ).repartition(3)
    rows = language_model.scores(frame, states=4, rounds=5).collect()
    got = {r.doc_id: r.score for r in rows}
    want = one_machine(texts, held, 4, 5)
    assert [got[k] for k in range(len(texts))] == pytest.approx(want.tolist(), rel=2e-3, abs=2e-3)


def test_rare_words_have_emissions_of_their_own(spark, monkeypatch):
    """Two topics over 6000 words each that share their endings: only the words tell them apart."""
    reachable(spark)
    monkeypatch.setattr(blocks.store_blocks, "__defaults__", (60_000,))
    rng = random.Random(8)
    rows = []
    for doc_id in range(600):
        topic = "ab"[doc_id % 2]
        rows.append((doc_id, " ".join(f"{topic}{rng.randrange(6000)}xyz" for _ in range(200)), doc_id >= 540))
    for doc_id in (600, 601, 602):
        # Halves of one topic or of two.
        own = [f"{t}{rng.randrange(6000)}xyz" for t in ("ab" * 100 if doc_id == 602 else "ab"[doc_id % 2] * 200)]
        rows.append((doc_id, " ".join(own), True))
    frame = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean").repartition(3)
    found = {r.doc_id: r for r in language_model.scores(frame).collect()}
    # A topic has half of the words, so knowing it is worth a factor of two a word.
    gains = [(found[k].score - found[k].base_score) / found[k].n_tokens for k in range(540, 602)]
    assert min(gains) > 0.15
    mixed = found[602]
    assert (mixed.score - mixed.base_score) / mixed.n_tokens < 0


def test_word_emissions_sum_to_one():
    rng = np.random.default_rng(2)
    states, kinds = 3, language_model.ENDINGS + 1
    endings = rng.integers(1, kinds, 500)
    expected = rng.random((500, states)) * 4
    types = np.bincount(endings, minlength=kinds)
    head = rng.random((states + 2, states))
    sums = np.frombuffer(language_model._summed(head, expected, endings)).reshape(-1, states)
    model = language_model.word_model(sums, types)
    known = model.with_words(expected, endings).emit.sum(axis=0)
    unseen = model.with_words(np.zeros((kinds - 1, states)), np.arange(1, kinds)).emit[1:].sum(axis=0)
    assert known + unseen == pytest.approx(np.ones(states))


def test_model_beats_base_on_held_out_texts(spark):
    reachable(spark)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn(
        "held_out", crc_remainder(F.col("doc_id"), 7) == 2
    )
    score, base, n = (
        language_model.scores(docs).where("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    )
    assert (score - base) / n > 0.2


# URL filter


def brute_rule(host: str, path: str) -> str | None:
    fits = [
        r.text
        for r in RULES
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return max(fits, key=len, default=None)


def test_rules_of_awkward_urls(spark):
    urls = [
        None, "", "no mark", "http://", "http://NET/", "https://a.Net/x?y#z", "http://net",
        "x://example.net/en/1", "http://sub.example.net/en/?q", "http://example.net/EN/",
        "http://example.com/de/", "http://notexample.com/de/1", "http://a.b.example.com/de/x#y",
        "http://org/fr/", "http://o.org/fr/a", "http://o.org?fr/", "http://a://b/c", "http://o.org/fr/a",
    ]
    pages = spark.createDataFrame(
        [(k, u, None if k % 3 else '<a href="//net/x">', k, "v") for k, u in enumerate(urls)],
        "page_id long, url string, html string, host long, verdict string",
    )
    rows = url_filter.judge(pages, RULES).collect()
    assert len(rows) == len(urls)
    for row in rows:
        url = urls[row.page_id] or ""
        rest = url.partition("://")[2] if "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        assert (row.host, row.path) == (host.translate(LOWER), path)
        assert row.rule == brute_rule(row.host, row.path)
        if row.rule:
            assert row.verdict == next(r.verdict for r in RULES if r.text == row.rule)
        assert row.verdict in ("allow", "block")
    assert url_filter.judge(pages.where("false"), RULES).count() == 0


def test_propagation_equals_power_iteration(spark):
    edges = [("a", "b", 2.0), ("b", "c", 1.0), ("c", "a", 1.0), ("a", "c", 1.0), ("d", "c", 3.0)]
    seeds = [("a", 3, 0), ("d", 1, 0), ("c", 0, 2), ("e", 0, 0)]
    found = {
        r.host: (r.trust, r.distrust)
        for r in url_filter.propagate(
            spark.createDataFrame(edges, "src string, dst string, weight double"),
            spark.createDataFrame(seeds, "host string, trust long, distrust long"),
        ).collect()
    }
    for which in (0, 1):
        seed = {h: x[which] for h, *x in seeds}
        seed = {h: v / sum(seed.values()) for h, v in seed.items() if v}
        ways = [(a, b, w) if which == 0 else (b, a, w) for a, b, w in edges]
        out = Counter()
        for a, _, w in ways:
            out[a] += w
        rank = dict(seed)
        for _ in range(url_filter.ROUNDS):
            new = Counter({h: v * 0.15 for h, v in seed.items()})
            for a, b, w in ways:
                new[b] += 0.85 * rank.get(a, 0) * w / out[a]
            rank = new
        for host in "abcd":
            assert found[host][which] == pytest.approx(rank.get(host, 0) / sum(rank.values()))


def test_links_carry_distrust_backwards(spark):
    pages = [
        (k, f"http://bad{k}.net/x", "") for k in range(3)
    ] + [
        (10, "http://farm.example.info/", '<a href="http://bad0.net/x">' + "<A HREF='//bad1.net'>"),
        (11, "http://fine.example.edu/", '<a href="/own">'),
        (12, "http://farm.example.info/2", None),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = {r.page_id: r for r in url_filter.judge(frame, RULES).collect()}
    assert found[10].distrust > 0 and found[10].trust == 0
    assert found[11].verdict == "allow" and found[11].distrust == 0
    assert found[0].verdict == "block"


# Chat formatting


def fold_by_hand(events):
    """(seq, turn, kind, role, text) in order -> final turns."""
    turns: dict[int, list] = {}
    for _, turn, kind, role, text in sorted(events, key=lambda e: e[0]):
        if kind in chat_format.RESETS:
            turns = {t: v for t, v in turns.items() if t < turn}
        turns.setdefault(turn, []).append((role or "", text or ""))
    return [(t, v[0][0], "".join(x for _, x in v)) for t, v in sorted(turns.items())]


def test_fold_edits_and_regenerations(spark):
    rng = random.Random(11)
    logs, want = [], {}
    for conv in range(25):
        events = []
        for seq in range(rng.randint(1, 25)):
            kind = rng.choices(["delta", "edit", "regenerate"], [8, 1, 1])[0]
            role = rng.choice(["user", "assistant", None])
            text = rng.choice(["a", "", None, "### x", "\\"])
            events.append((seq, rng.randint(0, 4), kind, role, text))
        logs += [(conv, *e) for e in events]
        want[conv] = fold_by_hand(events)
    rng.shuffle(logs)
    frame = spark.createDataFrame(
        logs, "conv_id long, seq long, turn long, kind string, role string, text string"
    ).repartition(3)
    got: dict[int, list] = {}
    for r in chat_format.fold(frame).collect():
        got.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    assert {k: sorted(v) for k, v in got.items()} == want


def test_round_trip_of_hostile_texts(spark):
    odd = [
        "", None, "\\", "\\\\", "\\h", "\\l#<", "### Assistant: </turn>", " </turn>\n### user: x",
        r"\### Assistant: </turn> ok", "a\nb", "🙂<", "trailing \\",
    ]
    roles = ["user", "assistant", "a:b", "### x: \\", None, ""]
    rows = [(k % 7, k, roles[k % 6], odd[k % 12], k) for k in range(84)]
    rows += [(99, 1, "assistant", "same", 0), (99, 1, "assistant", "same", 0), (None, 1, "user", "lost", 0)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, seq long")
    events = chat_format.turn_events(frame, step=3)
    back = chat_format.read_back(chat_format.render(chat_format.fold(events))).collect()
    assert len(back) == 9
    for row in back:
        own = sorted((r for r in rows if r[0] == row.conv_id), key=lambda r: r[1])
        assert [(m.role, m.text) for m in row.messages] == [(r[2] or "", r[3] or "") for r in own]
        assert row.learned == "".join(r[3] or "" for r in own if r[2] == "assistant")
    assert chat_format.fold(chat_format.turn_events(frame.where("false"))).count() == 0


def test_chat_plan_is_native(spark):
    from stopwise.llm.queries import op9_chat_format

    plan = op9_chat_format(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_probe_conversation(spark):
    from stopwise.llm.queries import PROBE, op9_chat_format

    row = op9_chat_format(spark, SMALL).where("conv_id = -7").first()
    assert row.n_turns == 2 and row.loss_chars == len(PROBE)
    assert row.loss_sha256 == hashlib.sha256(PROBE.encode()).hexdigest()


def test_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(300), 1000 + rng.randrange(280)) for _ in range(330)]
    edges += [(400 + k, 5000 + k + d) for k in range(40) for d in (0, 1)]  # a long path
    parent: dict[int, int] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for node, key in edges:
        parent[root(node)] = root(-key)
    least: dict[int, int] = {}
    for node, _ in edges:
        least[root(node)] = min(node, least.get(root(node), node))
    found = components(spark.createDataFrame(edges, "node long, key long")).collect()
    assert {r.node: r.label for r in found} == {n: least[root(n)] for n, _ in edges}
    assert len(found) == len({n for n, _ in edges})


def test_crc_remainder_of_awkward_ids(spark):
    frame = spark.createDataFrame([(5,), (-3,), (None,)], "doc_id long")
    rows = frame.select("doc_id", crc_remainder(F.col("doc_id"), 7).alias("r")).collect()
    for row in rows:
        text = "" if row.doc_id is None else str(row.doc_id)
        assert row.r == zlib.crc32(text.encode()) % 7
