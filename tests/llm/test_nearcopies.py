"""Near copies of the pipeline's stage against all pairs compared."""

import random

import numpy as np

import corpus_pipeline
from tests.llm.test_groups import roots
from tidemark.llm import nearcopies, simhash
from tidemark.llm.common import DOCUMENT

WORDS = [f"w{i}" for i in range(3000)]


def jaccard(a, b):
    x, y = (set(simhash.shingle_hashes(t, 5).tolist()) for t in (a, b))
    return len(x & y) / len(x | y)


def changed(rng, text, n):
    words = text.split()
    for at in rng.sample(range(len(words)), n):
        words[at] = rng.choice(WORDS)
    return " ".join(words)


def test_bits_are_counted():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 1 << 63, 1000, dtype=np.uint64) * np.uint64(2)
    assert nearcopies.ones_of(hashes).tolist() == [int(((hashes >> np.uint64(i)) & np.uint64(1)).sum()) for i in range(64)]


def test_copies_of_similarity_are_one_group(spark):
    rng = random.Random(3)
    texts = []
    for i in range(60):
        first = " ".join(rng.choices(WORDS, k=300))
        # From nearly equal to some way below the similarity.
        texts += [first, changed(rng, first, 1 + i % 12), changed(rng, first, 1 + i % 7)]
    rows = [(i, t, "en", f"s{i % 7}", len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").select(*DOCUMENT)
    kept = sorted(r["doc_id"] for r in corpus_pipeline.one_of_each_group(spark, docs, "").select("doc_id").collect())
    prints = [simhash.fingerprint(t, 5) for t in texts]
    pairs = [(a, b) for a in range(len(texts)) for b in range(a + 1, min(a + 3, len(texts)))]
    near = [(a, b) for a, b in pairs if jaccard(texts[a], texts[b]) >= 0.8]
    close = [(a, b) for a, b in pairs if ((prints[a] ^ prints[b]) & (1 << 64) - 1).bit_count() <= 3]
    ids = list(range(len(texts)))
    assert len(set(near) - set(close)) > 20
    assert kept == sorted(set(roots(near + close, ids).values()))


def test_a_large_group_becomes_one_without_all_of_its_pairs(spark):
    rng = random.Random(4)
    first = " ".join(rng.choices(WORDS, k=300))
    texts = [first, *(changed(rng, first, 2) for _ in range(150))]
    rows = [(i, t, i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row long")
    described = nearcopies.descriptions(docs, 5)
    found = nearcopies.copies(docs, described, 5, 0.8).collect()
    assert len(found) < len(texts) ** 2 / 4
    sets = {r["shingles"] for r in described.collect()}
    assert len(set(roots([tuple(r) for r in found], sorted(sets)).values())) == 1


def test_bands_grow_with_the_sets_and_miss_few():
    small, large = nearcopies.layout(1000), nearcopies.layout(10_000_000)
    assert small.shape[1] == nearcopies.LEAST_WIDTH and large.shape[1] == 20 and len(large) > len(small)
    for bands in (small, large):
        assert all(len(set(band)) == len(band) for band in bands.tolist())
        assert nearcopies.missed(bands.shape[1], len(bands)) <= nearcopies.MISSED
    # Of pairs that differ as at a similarity of 0.8, no more share no band than said.
    rng = np.random.default_rng(5)
    differ = rng.random((4000, nearcopies.BITS)) < nearcopies.DIFFERING
    missed = ~(~differ[:, small]).all(axis=2).any(axis=1)
    assert missed.mean() <= 4 * nearcopies.MISSED


def test_common_shingles_and_links_of_a_chunk(monkeypatch):
    rng = np.random.default_rng(6)
    monkeypatch.setattr(nearcopies, "CELLS", 200)
    base = rng.choice(10_000, 90, replace=False)
    drawn = [rng.choice(base, 80 if i % 2 else 40, replace=False) for i in range(30)]
    drawn += [drawn[1], rng.choice(10_000, 5000, replace=False), np.array([3])]
    hashes = [np.unique(d).astype(np.uint64) for d in drawn]
    sets = [set(h.tolist()) for h in hashes]
    common = nearcopies.common_shingles(hashes)
    assert all(common[i, j] == len(x & y) for i, x in enumerate(sets) for j, y in enumerate(sets) if i != j)
    ids = np.arange(100, 100 + len(sets))
    known = ids.copy()
    known[[3, 5]] = known[1]
    a, b = nearcopies.chunk_links(ids, known, hashes, 0.8)
    near = [(x + 100, y + 100) for x in range(len(sets)) for y in range(x) if 5 * len(sets[x] & sets[y]) >= 4 * len(sets[x] | sets[y])]
    before = [(103, 101), (105, 101)]
    everyone = ids.tolist()
    assert len(a) < len(sets)
    assert roots([*zip(a.tolist(), b.tolist()), *before], everyone) == roots(near + before, everyone)


def test_groups_of_many_chunks_are_those_of_all_pairs(spark, monkeypatch):
    """Loose clusters dealt into chunks of two sets each give the links of all pairs."""
    monkeypatch.setattr(nearcopies, "CHUNK_SETS", 2)
    rng = random.Random(8)
    texts = []
    for _ in range(3):
        first = " ".join(rng.choices(WORDS, k=300))
        texts += [first, *(changed(rng, first, 4 + i % 5) for i in range(20))]
    described = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, _row long")
    prints = nearcopies.descriptions(described, 5)
    set_of = {r["_row"]: r["shingles"] for r in prints.collect()}
    found = [tuple(r) for r in nearcopies.copies(described, prints, 5, 0.8).collect()]
    near = [(set_of[a], set_of[b]) for a in range(len(texts)) for b in range(a) if jaccard(texts[a], texts[b]) >= 0.8]
    everyone = sorted(set_of.values())
    assert near and roots(found, everyone) == roots(near, everyone)


def test_a_table_without_copies_or_rows_has_no_links(spark):
    texts = ["", None, "one", "two words", "a b c d e f g"]
    for some in (texts, []):
        docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(some)], "doc_id long, text string, _row long")
        assert nearcopies.copies(docs, nearcopies.descriptions(docs, 5), 5, 0.8).collect() == []


def test_nulls_empty_texts_and_repeated_rows(spark):
    """NULL ids come last, equal rows leave one, and texts without words are one group."""
    text = " ".join(WORDS[:50])
    rows = [(7, text, "k"), (7, text, "k"), (None, text, "k"), (3, "", None), (4, None, None), (None, None, None), (5, "one", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = nearcopies.deduplicated(docs, size=5, radius=3, least=0.8).collect()
    assert sorted(tuple(r) for r in kept) == [(3, "", None), (5, "one", "k"), (7, text, "k")]
