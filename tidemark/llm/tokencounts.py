"""Token counts of every prefix of a text, kept so that later questions need no encoding.

A byte-pair encoding is right exactly when each two neighbouring tokens stand side by
side in the encoding of their joined bytes. So the last token of a prefix is the one
token that ends there and may follow the last token of the prefix before it, and the
count is one more than the count of that prefix: dynamic programming from left to right,
without a merge being made.

Counts of prefixes are those of the prefix as a text of its own, as the tokenizers
library gives them. They may fall as a text grows, since a longer text can end in one
token where the shorter one needs two.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import kept_by_worker

# White space as the vocabulary's splitting pattern knows it, and the
# endings that the pattern splits off whole, of which a part is split otherwise.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
ENDINGS = ("'re", "'ve", "'ll")

# Chunks whose counts a worker keeps: at most twice as many, since those used of the
# last so many stay when new ones fill the place. Longer chunks are not kept.
KEPT_CHUNKS = 250_000
LONGEST_KEPT = 64

# Characters of texts whose counts go to Spark at a time; one text may be longer.
CHARS_AT_A_TIME = 1 << 20


class Prefixes:
    """Counts tokens of every prefix, for a byte-level vocabulary of the tokenizers library.

    A text is cut before every run of white space. No token reaches over such a place,
    so counts of the parts add up, and a part that comes again is looked up.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.specials = [t["content"] for t in model["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, self.specials)) or r"(?!)")
        self.chunk = re.compile(f"[{SPACE}]+[^{SPACE}]*|[^{SPACE}]+")
        self.run = re.compile(f"[{SPACE}]+")
        self.word = re.compile(" ?[A-Za-z]+")
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self._read(model["model"])

    def _read(self, model: dict) -> None:
        import ahocorasick

        self.vocab = model["vocab"]
        self.merged: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair = self.vocab[left], self.vocab[right]
            self.merged[pair] = rank
            self.parts[self.vocab[left + right]] = pair
        # A token's last parts and first parts, each with the rank of the merge that ends it.
        self.tails: dict[int, list[tuple[int, float]]] = {}
        self.heads: dict[int, list[tuple[int, float]]] = {}
        self.tokens = ahocorasick.Automaton()
        for token, number in self.vocab.items():
            self.tails[number] = self._edge(number, 1)
            self.heads[number] = self._edge(number, 0)
            self.tokens.add_word(token, (number, len(token)))
        self.tokens.make_automaton()
        self.apart: dict[tuple[int, int], bool] = {}

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        found = [(token, float("inf"))]
        while token in self.parts:
            pair = self.parts[token]
            token = pair[side]
            found.append((token, self.merged[pair]))
        return found

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether no merge ever reaches over the border of two tokens.

        A merge of a last part of `left` with a first part of `right` happens if it
        ranks before the merges that end the two. Of equal merges the left one is first.
        """
        for tail, until in self.tails[left]:
            for head, before in self.heads[right]:
                rank = self.merged.get((tail, head))
                if rank is not None and rank < until and rank <= before:
                    return False
        return True

    def of_piece(self, piece: str) -> list[int]:
        """Counts at the ends 0 to n of a piece in byte-level letters, one for each byte."""
        counts = [0] * (len(piece) + 1)
        last: list[int | None] = [None] * (len(piece) + 1)
        apart = self.apart
        for end, (token, size) in self.tokens.iter(piece):
            end += 1
            if last[end] is not None:
                continue
            start = end - size
            if start:
                before = last[start]
                if before is None:
                    continue
                stays = apart.get((before, token))
                if stays is None:
                    if len(apart) >= 1_000_000:
                        apart.clear()
                    stays = apart[before, token] = self.stay_apart(before, token)
                if not stays:
                    continue
            last[end], counts[end] = token, counts[start] + 1
        return counts

    def of_chunk(self, chunk: str) -> list[int]:
        """Counts at the ends of the first 1 to n characters of a run of white space and a word."""
        if self.word.fullmatch(chunk):
            return self.of_piece(chunk.replace(" ", "\u0120"))[1:]
        counts: list[int] = []
        total = 0
        for piece, (start, end) in self.split(chunk):
            made = self.of_piece(piece)
            text = chunk[start:end]
            if len(made) == len(text) + 1:
                found = made[1:]
            else:
                found = [made[e] for e in accumulate(len(c.encode()) for c in text)]
            if text in ENDINGS:
                found[1] = 2
            counts.extend(total + n for n in found)
            total += made[-1]
        run = self.run.match(chunk)
        if run and 1 < run.end() < len(chunk):
            # As a text of its own, a run of white space is one piece up to its end.
            counts[: run.end()] = self.of_chunk(run.group())
        return counts

    def steps(self, text: str) -> bytes:
        """How the count changes with every character of a text without special tokens."""
        return b"".join(map(self._steps, self.chunk.findall(text)))

    def _steps(self, chunk: str) -> bytes:
        made = self.kept.get(chunk)
        if made is None:
            made = self.older.get(chunk)
            if made is None:
                made = array("i", [b - a for a, b in pairwise([0, *self.of_chunk(chunk)])]).tobytes()
            if len(chunk) <= LONGEST_KEPT:
                if len(self.kept) >= KEPT_CHUNKS:
                    self.older, self.kept = self.kept, {}
                self.kept[chunk] = made
        return made

    def plain(self, text: str) -> np.ndarray:
        return np.cumsum(np.frombuffer(self.steps(text), np.int32), dtype=np.int32)

    def __call__(self, text: str) -> np.ndarray:
        """Counts of the first 1 to n characters of a text."""
        if not any(s in text for s in self.specials):
            return self.plain(text)
        found, at, total = [], 0, 0
        for special in self.special.finditer(text):
            part = text[at : special.start()]
            found.append(self.plain(part) + total)
            # A beginning of the special token is plain text that may join the word before it.
            word = part[max((m.start() for m in self.chunk.finditer(part)), default=0) :]
            before = int(found[-1][-1 - len(word)]) if len(word) < len(part) else total
            begun = self.of_chunk(word + special.group()[:-1])[len(word) :]
            total = int(found[-1][-1]) + 1 if part else total + 1
            found.append(np.array([*(before + n for n in begun), total], np.int32))
            at = special.end()
        found.append(self.plain(text[at:]) + total)
        return np.concatenate(found).astype(np.int32)


def prefix_counts(docs: DataFrame, path: str, keep: tuple[str, ...] | None = None) -> DataFrame:
    """The rows of `docs` with `prefix_tokens`, the tokens of their first 1 to n characters.

    Characters are code points. A NULL or empty text has an empty array. `path` names
    the vocabulary's file, at the same place on every machine. The special token's text
    is the special token. An input column `prefix_tokens` is replaced.
    """
    keep = [c for c in keep or docs.columns if c != "prefix_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = kept_by_worker(("prefix counts", path), lambda: Prefixes(path))

        def made(part: pa.RecordBatch, counts: list[np.ndarray]) -> pa.RecordBatch:
            ends = np.cumsum([0, *map(len, counts)], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(counts)))
            return pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), lists], names=[*keep, "prefix_tokens"])

        for batch in batches:
            texts = batch.column("text")
            start, size, counts = 0, 0, []
            for row in range(batch.num_rows):
                counts.append(count(texts[row].as_py() or ""))
                size += len(counts[-1])
                if size >= CHARS_AT_A_TIME or row + 1 == batch.num_rows:
                    yield made(batch.slice(start, len(counts)), counts)
                    start, size, counts = row + 1, 0, []

    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("prefix_tokens", T.ArrayType(T.IntegerType()))])
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)


def tokens(prefix_tokens: Column | str = "prefix_tokens", chars: Column | int | None = None) -> Column:
    """Tokens of the first `chars` characters, of the whole text by default or beyond its end."""
    counts = F.col(prefix_tokens) if isinstance(prefix_tokens, str) else prefix_tokens
    size = F.size(counts)
    at = size if chars is None else F.least(size, chars if isinstance(chars, Column) else F.lit(chars))
    return F.when(at > 0, F.get(counts, at - 1)).otherwise(F.lit(0))


def longest_prefix(budget: Column | int, prefix_tokens: Column | str = "prefix_tokens") -> Column:
    """Characters of the longest beginning that has at most `budget` tokens."""
    counts = F.col(prefix_tokens) if isinstance(prefix_tokens, str) else prefix_tokens
    limit = budget if isinstance(budget, Column) else F.lit(budget)
    from_end = F.array_position(F.transform(F.reverse(counts), lambda n: n <= limit), True)
    return F.when(limit < 0, F.lit(None)).when(from_end > 0, F.size(counts) - from_end + 1).otherwise(F.lit(0)).cast("int")


def truncated(counted: DataFrame, budget: int, text: str = "text") -> DataFrame:
    """`counted` with its texts cut to the longest beginning of at most `budget` tokens."""
    kept = F.coalesce(F.col(text), F.lit(""))
    return counted.withColumn(text, F.substring(kept, F.lit(1), longest_prefix(budget)))
