"""Counts of every prefix against the tokenizers library, and questions answered from them."""

import random

import pytest
from tokenizers import Tokenizer

from tidemark.llm import tokencounts
from tidemark.llm.common import vocabulary
from tidemark.llm.queries import QUERIES
from tests.llm.conftest import PROSE, TEXTS

PATH = vocabulary("byte_bpe_50k.json")
PARTS = (
    "a b the ing er aaaa 1 23 ! ... = <| |> <|endoftext|> ' 're 'll 've 's é 日本 Ж ø \U0001f600 x\x1cy r l".split(" ")
    + [" ", "  ", "\n", "\t", "\r\n", "\x85", "\xa0", "　"]
)


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_every_prefix_counts_as_a_text_of_its_own(library):
    rng = random.Random(3)
    count = tokencounts.Prefixes(PATH)
    for _ in range(1500):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14)))
        assert count(text).tolist() == [library(text[:n]) for n in range(1, len(text) + 1)], text


def test_kept_chunks_change_nothing(library, monkeypatch):
    monkeypatch.setattr(tokencounts, "KEPT_CHUNKS", 3)
    count = tokencounts.Prefixes(PATH)
    for _ in range(3):
        assert count(PROSE).tolist() == [library(PROSE[:n]) for n in range(1, len(PROSE) + 1)]


def test_long_texts_without_space(library):
    count = tokencounts.Prefixes(PATH)
    for text in ("a" * 50_000, "日本語" * 10_000, "x9/" * 20_000, " \n" * 20_000, "!" * 30_001):
        assert count(text)[-1] == library(text)


def test_questions_are_answered_from_the_counts(spark, library):
    rows = [(0, PROSE), (1, "you're  here<|endoftext|>\n\n now"), (2, ""), (3, None), (3, PROSE)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counted = tokencounts.prefix_counts(docs, PATH)
    for budget in (0, 1, 5, 1000):
        asked = counted.select("text", tokencounts.tokens(chars=7).alias("first"), tokencounts.longest_prefix(budget).alias("chars"))
        for row in asked.collect():
            text = row["text"] or ""
            assert row["first"] == library(text[:7])
            assert row["chars"] == max(n for n in range(len(text) + 1) if library(text[:n]) <= budget)
        cut = {r["text"] for r in tokencounts.truncated(counted, budget).collect()}
        assert all(library(t) <= budget for t in cut)


def test_query_gives_the_library_counts(spark, awkward, library):
    found = {(r["doc_id"], r["n_bytes"]): r for r in QUERIES["op13_token_counts"](spark, awkward).collect()}
    for i, text in enumerate(TEXTS):
        row = found[i, len((text or "").encode())]
        assert row["n_tokens"] == library(text or "")
        assert row["over_limit"] == (row["n_tokens"] > 512)
