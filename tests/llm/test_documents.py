"""Operators on documents against brute force, on awkward rows and in several blocks."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from stopwise.llm import (
    blocks,
    byte_dedup,
    decontaminate,
    fingerprints,
    jaccard_join,
    packing,
    substring_dedup,
)
from stopwise.llm.queries import ranks_path
from stopwise.llm.shared import reachable
from tests.llm import samples

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
FIRST = -(1 << 63)


@pytest.fixture(scope="module")
def docs(spark):
    reachable(spark)
    return samples.documents(spark).cache()


@pytest.fixture(scope="module")
def empty(spark):
    reachable(spark)
    return samples.no_documents(spark)


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(blocks.store_blocks, "__defaults__", (2000,))


def ordered():
    """(id, text) as the operators order them: a missing id first, texts of null empty."""
    rows = [(r[0], r[1] or "") for r in samples.rows()]
    return sorted(rows, key=lambda r: FIRST if r[0] is None else r[0])


def test_word_passages(docs, empty, small_blocks):
    seen, want = set(), []
    for doc_id, text in ordered():
        words = WORD.findall(text)
        gone = [False] * len(words)
        for k in range(len(words) - 19):
            window = tuple(words[k : k + 20])
            if window in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(window)
        want.append(
            (doc_id, len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g))
        )
    found = substring_dedup.repeated_passages(docs)
    # Clashing result names are replaced, other extra columns kept.
    assert found.columns.count("_words") == 1 and "label" in found.columns
    rows = [(r.doc_id, r._words, r._removed, r._kept) for r in found.collect()]
    assert sorted(rows, key=repr) == sorted(want, key=repr)
    assert substring_dedup.repeated_passages(empty).count() == 0


def test_without_repeats_keeps_clean_texts(docs):
    before = {r.row: r for r in docs.collect()}
    after = {r.row: r for r in substring_dedup.without_repeats(docs).collect()}
    # An exact copy goes whole; texts without a repeat stay as they are.
    assert set(before) - set(after)
    for row, kept in after.items():
        if kept.text == before[row].text:
            assert kept == before[row]
        else:
            assert kept.n_chars == len(kept.text)


@pytest.mark.parametrize("heavy", [20_000, 1])
def test_byte_passages(docs, empty, small_blocks, heavy):
    seen, want = set(), []
    for doc_id, text in ordered():
        data = text.encode()
        gone = [False] * len(data)
        for k in range(len(data) - 99):
            window = data[k : k + 100]
            if window in seen:
                gone[k : k + 100] = [True] * 100
            seen.add(window)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        want.append((doc_id, len(data), sum(gone), spans, kept))
    found = byte_dedup.repeated_bytes(docs, heavy=heavy)
    rows = [(r.doc_id, r._bytes, r._removed, r._spans, bytes(r._kept)) for r in found.collect()]
    assert sorted(rows, key=repr) == sorted(want, key=repr)
    assert byte_dedup.repeated_bytes(empty).count() == 0


def test_refined_buckets_equal_windows():
    import numpy as np

    rng = np.random.default_rng(3)
    text = rng.integers(97, 99, 400).astype(np.uint8)
    for window in (5, 8, 13, 100):
        bucket = byte_dedup.refine(text, window)
        data = text.tobytes()
        count = len(data) - window + 1
        windows = [data[k : k + window] for k in range(count)]
        names = sorted(set(windows))
        order = [names.index(x) for x in windows]
        same = {}
        for a, b in zip(order, bucket[:count].tolist()):
            assert same.setdefault(a, b) == b
        assert len(set(same.values())) == len(names)


def shingles(text: str, ngram: int = 3) -> frozenset:
    words = WORD.findall(text.translate(LOWER))
    if len(words) < ngram:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + ngram]) for k in range(len(words) - ngram + 1))


def linked(rows, ngram=3, num=90):
    """Brute force over numbered (id, text) rows: component ids."""
    sets = [shingles(text, ngram) for _, text in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(k)] = min(doc_id, least.get(root(k), doc_id))
    return [(i, len(s), least.get(root(k), i)) for k, ((i, _), s) in enumerate(zip(rows, sets))]


def test_jaccard_components(spark, docs, empty, small_blocks):
    want = linked(ordered())
    found = [tuple(r) for r in jaccard_join.linked_documents(docs).collect()]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    assert any(component != doc_id for doc_id, _, component in want)
    assert jaccard_join.linked_documents(empty).count() == 0


def test_first_of_each_at_five_words_and_four_fifths(spark):
    """Copies with an eighth to a quarter added, cut off, or some words changed, by brute force."""
    reachable(spark)
    import random

    rng = random.Random(11)
    base = [[f"w{rng.randint(0, 9999)}" for _ in range(200)] for _ in range(6)]
    rows = [(k, words) for k, words in enumerate(base)]
    for words in base:
        for more in (24, 36, 44, 60):
            rows.append((len(rows), words + [f"y{rng.randint(0, 9999)}" for _ in range(more)]))
        for less in (20, 36, 60):
            rows.append((len(rows), words[:-less]))
        for changes in (2, 4, 8):
            own = list(words)
            for place in rng.sample(range(200), changes):
                own[place] = f"x{place}"
            rows.append((len(rows), own))
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for _, w in rows]
    root = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = [new if r == old else r for r in root]
    want = {k for k, r in enumerate(root) if r == k}
    frame = spark.createDataFrame([(k, " ".join(w)) for k, w in rows], "doc_id long, text string")
    assert {r.doc_id for r in jaccard_join.first_of_each(frame).collect()} == want
    assert 6 < len(want) < len(rows) - 20
    closer = {r.doc_id for r in jaccard_join.first_of_each(frame, ngram=3, num=90, den=100).collect()}
    assert len(closer) > len(want)


def test_first_of_each_decides_per_row(spark):
    """Repeated rows, missing ids, and one id with two texts."""
    reachable(spark)
    one, two, three, four = (" ".join(f"{x}{k}" for k in range(40)) for x in "abcd")
    rows = [
        (1, one, "p"), (2, two, "p"), (2, one, "p"),  # the second text of 2 is a copy of 1, the first is none
        (3, three, "p"), (3, three, "p"), (3, three, "q"),
        (None, two, "p"), (None, four, "p"), (None, four, "p"),
        (4, "", "p"), (4, "", "p"), (None, None, "p"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    found = jaccard_join.first_of_each(frame)
    assert found.columns == frame.columns
    want = [(1, one, "p"), (2, two, "p"), (3, three, "p"), (None, four, "p"), (4, "", "p"), (4, "", "p"), (None, None, "p")]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)


def test_jaccard_groups_larger_than_a_tile(spark, monkeypatch, small_blocks):
    reachable(spark)
    import random

    rng = random.Random(5)
    base = [f"w{rng.randint(0, 400)}" for _ in range(120)]
    rows = []
    for k in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = f"x{rng.randint(0, 50)}"
        rows.append((k, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(jaccard_join, "TILE", 500)
    for tile in (500, 1 << 20):
        monkeypatch.setattr(jaccard_join, "SKETCH_TILE", tile)
        found = sorted(tuple(r) for r in jaccard_join.linked_documents(frame).collect())
        assert found == sorted(linked(rows))


def test_size_classes_never_part_linked_sizes():
    classes = jaccard_join.SizeClasses(90, 100, 3000)
    for small in range(9, 2500, 7):
        for large in range(small, small * 100 // 90 + 1):
            own, other = classes.of([small, large])
            assert other - own in (0, 1)
            # At most as many elements differ as there are blocks less one.
            union = small * 100 // 90
            assert union - -(-90 * union // 100) < classes.blocks[own]


@pytest.mark.parametrize("num", [80, 90])
def test_linked_sets_share_a_key(num):
    """Pairs at and near the bound, with elements taken away and added; none is missed."""
    rng = np.random.default_rng(num)

    def drawn(count):
        return rng.integers(0, 1 << 64, count, dtype=np.uint64)

    linked = 0
    for _ in range(600):
        size = int(rng.integers(3, 700))
        base = drawn(size)
        spare = size * (100 - num) // num + 1
        changed = int(rng.integers(0, spare + 1))
        less = int(rng.integers(0, changed + 1))
        one, two = np.unique(base), np.unique(np.concatenate([base[less:], drawn(changed - less)]))
        both = len(np.intersect1d(one, two))
        if both == len(one) == len(two) or 100 * both < num * (len(one) + len(two) - both):
            continue
        linked += 1
        sizes = np.array([len(one), len(two)])
        keys, owners = jaccard_join.block_keys(
            np.concatenate([one, two]), np.repeat([0, 1], sizes), sizes, num, 100
        )
        assert np.isin(keys[owners == 0], keys[owners == 1]).any()
        packed = jaccard_join.sketches(
            np.concatenate([one, two]), np.repeat([0, 1], sizes), sizes, num, 100
        )
        if (jaccard_join.SizeClasses(num, 100, int(sizes.max())).of(sizes) >= 0).all():
            assert len(set(jaccard_join.sketch_links(packed, sizes, num, 100).tolist())) == 1
    assert linked > 300


@pytest.mark.parametrize("num", [80, 90])
def test_sketches_part_sets_that_share_a_passage(num):
    """Strangers with a fifth of their shingles in common share keys, but no sketch."""
    rng = np.random.default_rng(num)
    passage = rng.integers(0, 1 << 64, 60, dtype=np.uint64)
    sets = [
        np.unique(np.concatenate([passage, rng.integers(0, 1 << 64, 240, dtype=np.uint64)]))
        for _ in range(40)
    ]
    sizes = np.array([len(x) for x in sets])
    packed = jaccard_join.sketches(
        np.concatenate(sets), np.repeat(np.arange(40), sizes), sizes, num, 100
    )
    found = jaccard_join.sketch_links(packed, sizes, num, 100)
    assert len(set(found.tolist())) == 40


def test_a_set_has_no_more_keys_than_its_prefix():
    """Per size class one key more than blocks may differ."""
    rng = np.random.default_rng(5)
    sizes = np.array([3, 40, 300, 301, 2000])
    classes = jaccard_join.SizeClasses(80, 100, 2000)
    hashes = np.concatenate([np.sort(rng.integers(0, 1 << 64, n, dtype=np.uint64)) for n in sizes])
    _, owners = jaccard_join.block_keys(hashes, np.repeat(np.arange(len(sizes)), sizes), sizes, 80, 100)
    own = classes.of(sizes)
    want = [sum(int(classes.differ[k]) + 1 for k in (x, x - 1) if k >= 0) for x in own]
    assert np.bincount(owners, minlength=len(sizes)).tolist() == want


def test_contamination(spark, docs, empty):
    long_text = max((t for t in samples.texts() if t), key=len).split(" ")
    items = [
        (1, " ".join(long_text[100:140])),
        (2, "TWO words"),
        (3, ""),
        (4, None),
        (None, "word"),
        (5, " ".join(long_text[110:135])),
        (5, " ".join(long_text[110:135])),
        (10, "日本語 テキスト"),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    pattern = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")

    def split(text):
        return pattern.findall((text or "").translate(LOWER))

    want = []
    for doc_id, text in {(r[0], r[1]) for r in samples.rows()}:
        words, hit, names = split(text), set(), set()
        for item_id, item in items:
            own = split(item)
            size = min(10, len(own))
            windows = {tuple(own[k : k + size]) for k in range(len(own) - size + 1)} if own else set()
            for k in range(len(words) - size + 1):
                if size and tuple(words[k : k + size]) in windows:
                    hit.update(range(k, k + size))
                    names.add("" if item_id is None else str(item_id))
        want.append((doc_id, len(words), len(hit), sorted(names)))
    found = decontaminate.contamination(docs, benchmark).collect()
    rows = [(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found]
    assert sorted(rows, key=repr) == sorted(want, key=repr)
    assert sum(r[2] > 0 for r in rows) >= 5
    clean = decontaminate.remove_contaminated(docs, benchmark)
    hit_ids = {(r[0], r[1]) for r in rows if r[2]}
    assert clean.columns == docs.columns
    assert not {(r.doc_id, len(split(r.text))) for r in clean.collect()} & hit_ids
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(docs, nothing).where("n_hit > 0").count() == 0
    assert decontaminate.contamination(empty, benchmark).count() == 0


def winnowed(data: bytes, k: int, window: int) -> list[int]:
    import numpy as np

    if not data:
        return []
    if len(data) < k:
        return [0]
    hashes = fingerprints._HASHER.grams(np.frombuffer(data, np.uint8), k) >> np.uint64(32)
    hashes = hashes.astype(np.uint32).tolist()
    out = set()
    for low in range(max(1, len(hashes) - window + 1)):
        part = hashes[low : low + window]
        out.add(max(low + j for j, h in enumerate(part) if h == min(part)))
    return sorted(out)


def test_fingerprints(docs, empty):
    found = fingerprints.compared(fingerprints.with_next(docs)).collect()
    line = sorted(
        ((r[0], r[1] or "") for r in samples.rows()),
        key=lambda r: (r[0] is not None, r[0] or 0, r[1]),
        reverse=True,
    )
    assert len(found) == len(line)
    by_id = {r.doc_id: r for r in found}
    for k, (doc_id, text) in enumerate(line):
        following = line[(k + 1) % len(line)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        row = by_id[doc_id]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for name, data in ((row.fingerprint, text), (row.edited_fingerprint, edited)):
            assert fingerprints.decode(name)[1].tolist() == winnowed(data.encode(), 12, 20)
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
    assert by_id[4].fingerprint == by_id[7].fingerprint  # equal texts
    assert fingerprints.with_next(empty).count() == 0


def test_packing(spark, docs, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(ranks_path().replace(".tiktoken", ".json"))
    tokenizer.encode_special_tokens = True
    twice = docs.unionByName(docs.where("row = 9"))
    pieces = packing.pack(twice, ranks_path(), width=64, part_windows=8).collect()
    ids = {}
    for row in twice.collect():
        found = tokenizer.encode(row.text or "", add_special_tokens=False).ids + [0]
        ids.setdefault(row.doc_id, []).append(found)
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(ids)
    for doc_id, own in by_doc.items():
        tokens = ids[doc_id][0]
        covered = [0] * len(tokens)
        for p in own:
            assert p.doc_tokens == len(tokens)
            for k in range(p.start, p.start + p.length):
                covered[k] += 1
            data = b"".join(t.to_bytes(4, "little") for t in tokens[p.start : p.start + p.length])
            assert zlib.crc32(data) == p.ids_crc32
        # A row that repeats is packed once more.
        assert covered == [len(ids[doc_id])] * len(tokens)
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == [sum(p.length for p in own[:k]) for k in range(len(own))]
        total = sum(p.length for p in own)
        assert total <= 64 and total & (total - 1) == 0  # nothing to pad
    assert packing.pack(empty, ranks_path()).count() == 0


def test_windows_keep_the_mixture():
    import numpy as np

    sizes = np.array([5000, 300, 7, 1, 2900])
    taken = packing.fill_windows(sizes, np.zeros(5), 1, 64)
    assert (taken.sum(axis=0) == sizes).all()
    assert (taken[:-1].sum(axis=1) == 64).all() and (taken >= 0).all()
    share = sizes / sizes.sum()
    owed = np.cumsum(np.ones(len(taken) - 1) * 64)[:, None] * share - np.cumsum(taken[:-1], axis=0)
    assert np.abs(owed).max() < 2


def test_cached_tokens_equal_the_tokenizer():
    import pyarrow as pa
    from tokenizers import Tokenizer

    from stopwise.llm.textkit import chunks
    from stopwise.llm.tokens import Tokens

    reference = Tokenizer.from_file(ranks_path().replace(".tiktoken", ".json"))
    reference.encode_special_tokens = True
    odd = [" a  b \n c", "it's 'sup", "x  y", "a\u0085 b", "　 z", " lead", "trail ", "é è à"]
    column = pa.array([*samples.texts(), *odd, *samples.texts(9)])
    made = Tokens(ranks_path())
    for chunk in chunks(column, 3000):
        ids, begin = made.encode(chunk)
        for row in range(len(chunk)):
            text = column[chunk.first + row].as_py() or ""
            want = reference.encode(text, add_special_tokens=False).ids
            assert ids[begin[row] : begin[row + 1]].tolist() == want


def test_blocks_learn_how_common_keys_are():
    """In how many blocks a key is, 0 if it occurs once."""
    held = [[3, 3, 5, 9, 1 << 40], [5, 7, 9], [9, 1 << 40, 1 << 63], [1 << 63, 9]]
    held = [np.array(x, np.uint64) for x in held]
    sent = [blocks.send_keys(k, x, 4).to_pylist() for k, x in enumerate(held)]
    told = {k: {} for k in range(len(held))}
    for bucket in range(4):
        rows = [x for one in sent for x in one if x["bucket"] == bucket]
        if rows:
            for x in blocks._shared(pa.Table.from_pylist(rows)).to_pylist():
                told[x["block_id"]][x["bucket"]] = x["bits"]
    found = [blocks.spread_of(x, 4, told[k]).tolist() for k, x in enumerate(held)]
    assert found == [[1, 1, 2, 4, 2], [2, 0, 4], [4, 2, 2], [2, 4]]


def test_common_passages_do_not_chain_strangers():
    """Strangers share passages that many others have; linked pairs share what is rare as well."""
    rng = np.random.default_rng(7)

    def drawn(count):
        return rng.integers(0, 1 << 64, count, dtype=np.uint64)

    def largest(keys, rows):
        """Rows of the largest group that keys connect."""
        group = np.arange(len(sets))
        for key in np.unique(keys):
            met = np.unique(group[rows[keys == key]])
            group[np.isin(group, met)] = met[0]
        return np.bincount(group).max()

    passages = [drawn(60) for _ in range(4)]
    sets = []
    for k in range(60):
        one = np.concatenate([passages[k % 4], passages[(k + 1) % 4], drawn(300)])
        sets += [np.unique(one), np.unique(np.concatenate([one[30:], drawn(15)]))]
    sizes = np.array([len(x) for x in sets])
    made = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes), sizes, 80, 100
    keys, owners, elements, enough = jaccard_join.level_keys(*made)
    _, number, often = np.unique(keys, return_inverse=True, return_counts=True)
    told = jaccard_join.first_keys(keys, owners, elements, enough, often[number])
    keys, rows = keys[told], owners[told] // 2
    for k in range(0, len(sets), 2):
        assert np.isin(keys[rows == k], keys[rows == k + 1]).any()
    assert largest(keys, rows) <= 20
    # In an order without regard to rarity, passages tie all of them.
    assert largest(*jaccard_join.block_keys(*made)) == len(sets)


def test_fingerprints_hold_no_texts_beside_their_batch(spark):
    """Texts are not queued for the rows of a batch, and windows fit what they hold in memory."""
    reachable(spark)
    rows = [(k, f"text number {k} " * (4000 * (k == 3) + 40)) for k in range(5000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    following = fingerprints.with_next(frame)
    found = fingerprints.compared(following)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "EvalPython" not in plan
    assert 1 << fingerprints._BUCKET < int(spark.conf.get("spark.sql.windowExec.buffer.in.memory.threshold"))
    texts = dict(rows)
    nexts = {r.doc_id: r.next_text for r in following.select("doc_id", "next_text").collect()}
    assert nexts == {k: texts[(k - 1) % 5000] for k in texts}
    got = {r.doc_id: r.n_chars for r in found.collect()}
    assert got == {k: len(x) for k, x in rows}
