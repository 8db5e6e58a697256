"""Every stage of the pipeline against a plain version, on what the stage before kept."""

import os
import re

import pytest

import corpus_pipeline
from tests.llm.test_groups import brute_fingerprint, roots
from tests.llm.test_text import base_counts
from tidemark.llm import language, quality
from tidemark.llm.common import DOCUMENT

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows before the first stage and after each."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = [[r.asDict() for r in docs.collect()]]
    for name, stage in corpus_pipeline.STAGES:
        folder = str(tmp_path_factory.mktemp("pipeline") / name)
        made = stage(spark, docs, SF_DIR)
        if name != "best_fit_packing":
            assert tuple(made.columns) == DOCUMENT
        made.write.parquet(folder)
        docs = spark.read.parquet(folder)
        found.append([r.asDict() for r in docs.collect()])
    return found


def by_id(rows):
    return {r["doc_id"]: r for r in rows}


def test_order_of_the_stages():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "quality_rules", "line_dedup", "simhash_near_dedup", "best_fit_packing"]


def test_only_uncertain_languages_go(spark, stages):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    scored = {r["doc_id"]: r for r in language.predict(docs, language.fit(docs)).collect()}
    kept = {i for i, r in scored.items() if r["lang_pred"] != "und" and r["score"] >= 0.5}
    assert set(by_id(stages[1])) == kept


def follows_rules(text):
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat = base_counts(text)
    n_lines = len([x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)])
    n_stop = sum(w in set(quality.STOP_WORDS) for w in re.findall(r"[^\x20\x09-\x0D]+", text))
    names = {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup_lines,
        "n_repeat_words": n_repeat, "n_stop_words": n_stop, "n_lines": n_lines, "greatest": max,
    }
    if n_words < 50 or 100 * n_repeat > 50 * n_words:
        return False
    ratios = [(eval(r.ratio, {"__builtins__": {}}, names), r) for r in quality.RULES]
    return all((r.least is None or x >= r.least) and (r.most is None or x <= r.most) for x, r in ratios)


def test_only_rule_breakers_go(stages):
    assert set(by_id(stages[2])) == {r["doc_id"] for r in stages[1] if follows_rules(r["text"])}


def test_spread_lines_go_but_for_one(stages):
    sites, first = {}, {}
    for r in stages[2]:
        for line in {x.strip(" \t\x0b\x0c\r") for x in r["text"].split("\n")}:
            if line:
                sites.setdefault(line, set()).add(r["source"])
                first[line] = min(r["doc_id"], first.get(line, r["doc_id"]))
    want = {}
    for r in stages[2]:
        lines = r["text"].split("\n")
        kept = [x for x in lines if not (len(sites.get(y := x.strip(" \t\x0b\x0c\r"), ())) >= 5 and first[y] != r["doc_id"])]
        text = "\n".join(kept)
        if len(kept) == len(lines) or text.strip(" \t\n\x0b\x0c\r"):
            want[r["doc_id"]] = text
    found = by_id(stages[3])
    assert {i: r["text"] for i, r in found.items()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in found.values())


def test_one_document_of_each_group_stays(stages):
    """Near copies are within the radius, or share four of five shingles of five words."""
    prints = {r["doc_id"]: brute_fingerprint(r["text"], 5) for r in stages[3]}
    shingles = {}
    for r in stages[3]:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), r["text"]))
        shingles[r["doc_id"]] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    def near(a, b):
        x, y = shingles[a], shingles[b]
        return (prints[a] ^ prints[b]).bit_count() <= 3 or (x and y and 5 * len(x & y) >= 4 * len(x | y))

    ids = sorted(prints)
    links = [(a, b) for a in ids for b in ids if a < b and near(a, b)]
    assert sorted(by_id(stages[4])) == sorted(set(roots(links, ids).values()))
    before = by_id(stages[3])
    assert all(before[r["doc_id"]] == r for r in stages[4])


def test_all_documents_are_packed(stages):
    assert {r["doc_id"] for r in stages[5]} == set(by_id(stages[4]))
    spans = {}
    for r in stages[5]:
        spans.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in spans.values():
        held.sort()
        assert [o for o, _ in held] == [sum(n for _, n in held[:i]) for i in range(len(held))]
        assert sum(n for _, n in held) <= 2048
    total = sum(r["length"] for r in stages[5])
    assert len(spans) <= total / 2048 * 1.1 + 1
