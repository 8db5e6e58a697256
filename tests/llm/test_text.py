"""Language, quality, toxicity, tokens, packing and extraction against plain versions."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import PROSE, TEXTS
from tidemark.llm import bpe, extraction, language, packing, quality, toxicity
from tidemark.llm.common import vocabulary
from tidemark.llm.queries import QUERIES

ENGLISH = "the cat and the dog were in the house with all of the children"
GERMAN = "der hund und die katze waren mit allen kindern in dem haus"


@pytest.fixture(scope="module")
def speakers(spark):
    rows = [(i, ENGLISH if i % 2 else GERMAN, "en" if i % 2 else "de") for i in range(20)]
    return spark.createDataFrame([*rows, (20, None, "en"), (21, "text", None)], "doc_id long, text string, lang string")


def test_known_words_unseen_words_and_letterless_texts(spark, speakers):
    model = language.fit(speakers)
    asked = [(0, "the house"), (1, "katzen hunde"), (2, "12 ²"), (3, ""), (4, None), (5, "日本語"), (6, ENGLISH)]
    found = {r["doc_id"]: r for r in language.predict(spark.createDataFrame(asked, "doc_id long, text string"), model).collect()}
    assert [found[i]["lang_pred"] for i in range(6)] == ["en", "de", "und", "und", "und", "de"]
    # Copies of a text teach once, so two words are no more than likely and a whole text is sure.
    assert 0.5 < found[0]["score"] < found[6]["score"] and found[6]["score"] > 0.95
    assert found[2]["score"] == 0 and found[5]["score"] == 0.5


def test_an_unseen_word_goes_to_the_longest_known_grams():
    tables = [{"cat": 1}, {"z": 2}, {"zz": 3}]
    logs = np.array([[0.0, 0], [1, 2], [3, 4], [5, 6]])
    scorer = language.Scorer(language.Model(["a", "b"], tables, logs, language.Settings(longest=2)))
    assert scorer.evidence(["cat", "zz", "z", "q"]).tolist() == [[1, 2], [5, 6], [3, 4], [0, 0]]


def test_confident_drops_only_the_undetermined(spark, speakers):
    docs = speakers.filter("text is not null").union(spark.createDataFrame([(99, "!!", "en")], speakers.schema))
    kept = language.confident(docs, language.fit(docs))
    assert {r["doc_id"] for r in kept.collect()} == {*range(20), 21} and kept.columns == docs.columns


def base_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_quality_counts(spark):
    texts = [*TEXTS, "a b c a b c a b", "x\nx\n\nx y\nx y", "a|b & <c>", "\x0b\x0c", "a b\n" * 5000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    found = {r["doc_id"]: tuple(r[n] for n in names) for r in quality.counts(docs).collect()}
    assert found == {i: base_counts(t) for i, t in enumerate(texts)}


def test_rules_name_what_they_reject(spark):
    row = "SELECT 60L n_words, 300L word_chars, 30L n_symbols, 0L n_dup_lines, 0L n_repeat_words, 1L n_stop_words, 1L n_lines"
    assert quality.judge(spark.sql(row)).first()["failed"] == ["symbols", "stop_words"]


def test_good_keeps_prose(spark):
    docs = spark.createDataFrame([(1, PROSE), (2, "#### " * 80), (3, "short"), (4, None)], "doc_id long, text string")
    assert [r["doc_id"] for r in quality.good(docs).collect()] == [1]


def test_toxic_words_are_learned_and_clean_ones_left(spark):
    rng = np.random.default_rng(0)
    texts = [" ".join(rng.choice([f"w{j}" for j in range(500)], 30)) + (" vileword" if i % 3 == 0 else "") for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(200)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    found = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, model).collect()}
    assert found == {i: int(i % 3 == 0) for i in range(300)}
    assert len(model.coordinates) < 1000


def test_the_bound_on_labelled_rows_holds(spark):
    docs = spark.createDataFrame([(i, "w" * (i + 1)) for i in range(50)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(50)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, toxicity.Settings(train_rows=5, l1=0))
    assert len(model.coordinates) == 5 + 1


def test_rows_of_one_id_teach_once(spark):
    docs = spark.createDataFrame([(1, f"word{i}") for i in range(40)] + [(2, "calm")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, toxicity.Settings(l1=0))
    assert len(model.coordinates) == 2 + 1


def test_no_labels_give_even_scores(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r["score"] for r in toxicity.score(docs, model).collect()} == {0.5}


@pytest.fixture(scope="module")
def tokenizers():
    library = pytest.importorskip("tokenizers")
    return {n: library.Tokenizer.from_file(vocabulary(n)) for n in ("word_bpe_49k.json", "byte_bpe_50k.json")}


ODD = st.text(alphabet=st.sampled_from("abAZé ßǅ'sʼ\n\t\x0b\x1c　́日½²1!*|<>\U0001f600"), max_size=400)


@settings(deadline=None, max_examples=200)
@given(text=st.one_of(ODD, ODD.map(lambda t: t * 20), ODD.map(lambda t: f"{t}<|endoftext|>{t}")))
def test_both_encoders_agree_with_the_library(tokenizers, encoders, text):
    for name, encode in encoders.items():
        assert encode(text) == tokenizers[name].encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoders():
    words, chunks = packing.WordEncoder(vocabulary("word_bpe_49k.json")), bpe.Encoder(vocabulary("byte_bpe_50k.tiktoken"))
    return {
        "word_bpe_49k.json": lambda t: np.frombuffer(next(words.encode([t])), "<u4").tolist(),
        "byte_bpe_50k.json": lambda t: np.frombuffer(chunks.encode(t), "<i4").tolist(),
    }


def test_shared_passages_are_encoded_once(tokenizers):
    encoder = bpe.Encoder(vocabulary("byte_bpe_50k.tiktoken"))
    passage = " ".join(f"word{i * i}" for i in range(2000))
    encoder.encode("one start of a text " + passage)
    kept = len(encoder.kept)
    text = "quite another beginning, " + passage
    ids = np.frombuffer(encoder.encode(text), np.int32).tolist()
    assert kept > 10 and len(encoder.kept) <= kept + 1
    assert ids == tokenizers["byte_bpe_50k.json"].encode(text).ids


def test_round_trip_of_awkward_texts(spark, awkward, tokenizers):
    import hashlib

    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    tokenizer = tokenizers["byte_bpe_50k.json"]
    found = {r["doc_id"]: r for r in QUERIES["op8_bpe_round_trip"](spark, awkward).collect()}
    for i, text in enumerate(TEXTS):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert found[i]["n_tokens"] == len(ids)
        assert found[i]["ids_sha256"] == digest(",".join(map(str, ids)))
        assert found[i]["decoded_sha256"] == digest(tokenizer.decode(ids, skip_special_tokens=False)) == digest(text or "")


def test_pieces_fill_sequences_without_gaps(spark, awkward, tokenizers):
    rows = QUERIES["op4_best_fit_packing"](spark, awkward).collect()
    sequences: dict[int, list] = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in sequences.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= 2048
    for i, text in enumerate(TEXTS):
        ids = [*tokenizers["word_bpe_49k.json"].encode(text or "", add_special_tokens=False).ids, 0]
        pieces = [ids[at : at + 2048] for at in range(0, len(ids), 2048)]
        want = [(p, 2048 * p, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for p, x in enumerate(pieces)]
        got = {(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows if r["doc_id"] == i}
        assert sorted(got) == want


@settings(deadline=None, max_examples=60)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 30), max_size=40))
def test_plans_use_up_the_histogram_and_waste_little(histogram):
    patterns = packing.plan(histogram, 64)
    used: Counter = Counter()
    for p in patterns:
        assert sum(x * n for x, n in p.parts) <= 64
        for x, n in p.parts:
            used[x] += n * p.times
    assert used == Counter(histogram)
    at_most = sum(p.times for p in packing.best_fit(histogram, 64))
    assert sum(p.times for p in patterns) <= at_most


def test_exact_complements_are_found():
    assert sum(p.times for p in packing.plan({50: 10, 10: 10, 4: 10}, 64)) == 10
    assert sum(p.times for p in packing.plan({40: 5, 12: 5, 8: 5, 4: 5}, 64)) == 5


def test_complements_behind_many_that_conflict_are_found():
    # Pairs of 40 beside a length of 24 that take the last 24 come first.
    index = packing.Complements({24: 1, 16: 1, 23: 1, 17: 1}, 64)
    assert index.pair(40) == (24, 16)
    assert index.pair(40, 24) == (23, 17)
    assert index.triple(60, 20, 20) is None


def test_a_hot_length_is_ranked_in_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_TOGETHER", 50)
    rows = spark.range(1000).selectExpr("id AS doc_id", "if(id < 600, 3L, 1 + id % 7) AS length")
    packed = packing.pack(rows, 16, ("doc_id",)).collect()
    spans = Counter()
    for r in packed:
        for at in range(r["offset"], r["offset"] + r["length"]):
            spans[r["sequence_id"], at] += 1
    assert len(packed) == 1000 and set(spans.values()) == {1} and max(at for _, at in spans) < 16


PAGE = f"""<!DOCTYPE html><html><head><title>t</title><script>var a = "</p>";</script></head><body>
<div class="site-nav"><a href=/>Home</a> <a href=/x>News</a></div><div class="cookie-notice">We use cookies</div>
<div id="content"><h1>A &amp; B</h1><div class="text"><p>{PROSE}<p>Second&nbsp;<b>bold</b> part <a href=y>link</a>.
<ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table></div></div>
<section class="comments"><p>{PROSE} {PROSE}</p></section><form>sign up <button>go</button></form><footer>end</footer></body></html>"""


def test_article_without_furniture():
    want = ["A & B", PROSE, "Second bold part link.", "one", "two", "c1", "c2"]
    assert extraction.main_text(PAGE).split("\n") == want


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("just text &lt;b&gt;", "just text <b>"),
        ("<article><p>a  b\n c</p><script>no</script><aside>no</aside><p hidden>no</p></article>", "a b c"),
        ("<p title='x > y'>in<!-- no --></p>", "in"),
        ("<article class=post><p>x</p><article class=comment>no</article></article>", "x"),
        ("<main><article><h1>T</h1><p>one</article></main><div>related junk of many words, many words</div>", "T\none"),
        (f"<div class=site-header>Logo</div><div class=entry-header>Title</div><p>{PROSE}</p>", f"Title\n{PROSE}"),
        ("<p><b>unclosed<p>next", "unclosed\nnext"),
    ],
)
def test_small_pages(page, text):
    assert extraction.main_text(page) == text


@settings(deadline=None, max_examples=200)
@given(st.text(alphabet=st.sampled_from("<>/pdivablitrx \"'=!-&;")))
def test_broken_markup_never_fails(page):
    extraction.main_text(page)
