"""Best-fit packing of token sequences by exact complements.

What is packed where depends on lengths only, and a length is at most the capacity.
So the lengths' histogram, never the rows, is planned with: a bounded table of
patterns (lengths side by side, and how often) that the rows then find their places
in by their rank among the rows of their length.
"""

from __future__ import annotations

import json
import re
from array import array
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import ROWS_AT_A_TIME, cut, kept_by_worker, set_aside

END_OF_DOCUMENT = 0

# Rows of one length that are ranked together.
RANKED_TOGETHER = 50_000


class WordEncoder(dict):
    """Token ids of whole texts, as the tokenizer file's library gives them.

    The file's merges end at spaces, so the parts of a text between spaces are
    encoded one by one and kept, little-endian unsigned 32-bit. Parts of plain Latin
    letters, digits and punctuation go straight to the merges; all others go through
    the tokenizer itself.
    """

    def __init__(self, path: str, kept_parts: int = 250_000):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kept_parts = kept_parts
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        ranks = {token_bytes(t): i for t, i in vocabulary.items() if not t.startswith("<|")}
        encoding = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
        self.merged = encoding._core_bpe.encode_single_piece

    def __missing__(self, part: str) -> bytes:
        if PLAIN.fullmatch(part) and "<|" not in part:
            ids = [i for piece in PIECES.findall(part.lower()) for i in self.merged(piece.encode() + END_OF_WORD)]
        else:
            ids = self.tokenizer.encode(part, add_special_tokens=False).ids
        found = self[part] = array("I", ids).tobytes()
        return found

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text."""
        for text in texts:
            if len(self) > self.kept_parts:
                self.clear()
            yield b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


# Latin letters that no normalization changes and whose small form is one letter; and
# ASCII but the apostrophe, which may begin a contraction. Pieces are what the
# tokenizer's splitting pattern finds in such text.
LETTERS = "A-Za-zÀ-ÖØ-öø-įıĲ-ſ"
PLAIN = re.compile(f"[{LETTERS}!-&(-~]*")
PIECES = re.compile(f"[{LETTERS}]+|[0-9]|[!-&(-/:-@\\[-`{{-~]+")

# Stands for the mark of a word's end; no UTF-8 text holds this byte.
END_OF_WORD = b"\xff"


def byte_of_character() -> dict[str, int]:
    """The byte-level alphabet: printable bytes as they are, others moved above 255."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    moved = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


BYTES = byte_of_character()


def token_bytes(token: str) -> bytes:
    ends = len(token) > len("</w>") and token.endswith("</w>")
    body = token.removesuffix("</w>") if ends else token
    return bytes(BYTES[c] for c in body) + (END_OF_WORD if ends else b"")


PIECE = "doc_id long, piece int, start long, length long, ids binary"


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int) -> DataFrame:
    """Documents as token ids with the id 0 after each, cut into pieces of `capacity`.

    A NULL text is an empty one: one piece that holds the id 0. `ids` are
    little-endian unsigned 32-bit. Repeated rows give repeated pieces.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_by_worker(("word encoder", tokenizer_path), lambda: WordEncoder(tokenizer_path))
        end = END_OF_DOCUMENT.to_bytes(4, "little")
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_A_TIME):
                part = batch.slice(at, ROWS_AT_A_TIME)
                keys = part.column("doc_id").to_pylist()
                encoded = encoder.encode([t or "" for t in part.column("text").to_pylist()])
                rows = [
                    (key, i, i * capacity, len(ids[at : at + 4 * capacity]) // 4, ids[at : at + 4 * capacity])
                    for key, ids in zip(keys, (e + end for e in encoded))
                    for i, at in enumerate(range(0, len(ids), 4 * capacity))
                ]
                columns = list(zip(*rows))
                kinds = (part.schema.field("doc_id").type, pa.int32(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    names=["doc_id", "piece", "start", "length", "ids"],
                )

    schema = T.StructType([docs.schema["doc_id"], *T._parse_datatype_string(PIECE).fields[1:]])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


@dataclass(frozen=True)
class Pattern:
    """Lengths that share a sequence, each so many times, and how many such sequences."""

    parts: tuple[tuple[int, int], ...]
    times: int


class Complements:
    """Single, pair and triple sums of the lengths at hand, by sum.

    Counts only fall, so entries that cannot be used now never can be again; each
    sum keeps the place of its first entry that still can.
    """

    def __init__(self, counts: dict[int, int], capacity: int):
        self.counts = counts
        lengths = sorted(counts, reverse=True)
        self.larger: dict[int, list[int]] = {}
        for i, a in enumerate(lengths):
            for b in lengths[i:]:
                if a + b < capacity:
                    self.larger.setdefault(a + b, []).append(a)
        self.lengths = lengths
        self.pair_at: dict[int, int] = {}
        self.triple_at: dict[int, int] = {}

    def enough(self, *lengths: int) -> bool:
        return all(self.counts[x] >= n for x, n in Counter(lengths).items())

    def pair(self, total: int, *others: int) -> tuple[int, int] | None:
        entries = self.larger.get(total, ())
        at = self.pair_at.get(total, 0)
        while at < len(entries) and not self.enough(entries[at], total - entries[at]):
            at += 1
        self.pair_at[total] = at
        for a in entries[at:] if others else entries[at : at + 1]:
            if self.enough(a, total - a, *others):
                return a, total - a
        return None

    def triple(self, total: int, *others: int) -> tuple[int, int, int] | None:
        at = self.triple_at.get(total, 0)
        first_usable = None
        while at < len(self.lengths):
            a = self.lengths[at]
            if a < total and self.counts[a] and self.pair(total - a, a):
                if first_usable is None:
                    first_usable = at
                if rest := self.pair(total - a, a, *others):
                    break
            at += 1
        else:
            rest = None
        self.triple_at[total] = len(self.lengths) if first_usable is None else first_usable
        return (a, *rest) if rest else None

    def filling(self, length: int, gap: int, most: int) -> tuple[int, ...] | None:
        """One, two or three lengths, `most` at most, that fill the gap beside `length`."""
        if gap in self.counts and self.enough(gap, length):
            return (gap,)
        if most > 1 and (found := self.pair(gap, length)):
            return found
        return self.triple(gap, length) if most > 2 else None


def plan(histogram: dict[int, int], capacity: int) -> list[Pattern]:
    """Patterns that take up every length as often as the histogram has it.

    Triples fill gaps that pairs cannot, but use up short lengths that the residuals
    may need. So complements are consumed with triples, with pairs and with single
    lengths only, and the plan with the fewest sequences is taken.
    """
    plans = [exact_then_best_fit(histogram, capacity, most) for most in (3, 2, 1)]
    return min(plans, key=lambda patterns: sum(p.times for p in patterns))


def exact_then_best_fit(histogram: dict[int, int], capacity: int, most: int) -> list[Pattern]:
    """From the longest down, a length is joined with up to `most` lengths that fill the
    sequence exactly, as often as the counts allow. What finds no complement is packed
    by best fit, longest first.
    """
    counts = dict(histogram)
    patterns = [Pattern(((capacity, 1),), counts.pop(capacity))] if counts.get(capacity) else []
    index = Complements(counts, capacity)
    for length in sorted(counts, reverse=True):
        while counts[length] and (found := index.filling(length, capacity - length, most)):
            together = Counter((length, *found))
            times = min(counts[x] // n for x, n in together.items())
            for x, n in together.items():
                counts[x] -= n * times
            patterns.append(Pattern(tuple(sorted(together.items(), reverse=True)), times))
    return patterns + best_fit({x: n for x, n in counts.items() if n}, capacity)


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing over counts: sequences with the same contents move together."""
    gaps: list[int] = []
    open_with: dict[int, Counter] = {}

    def put(gap: int, contents: tuple[tuple[int, int], ...], times: int) -> None:
        if gap not in open_with:
            insort(gaps, gap)
            open_with[gap] = Counter()
        open_with[gap][contents] += times

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                each = capacity // length
                if left >= each:
                    put(capacity - each * length, ((length, each),), left // each)
                    left %= each
                else:
                    put(capacity - left * length, ((length, left),), 1)
                    left = 0
                continue
            gap = gaps[at]
            contents, times = next(iter(open_with[gap].items()))
            # So many of this length in each sequence, then the rest in one more.
            each = min(gap // length, left)
            used = min(times, left // each)
            open_with[gap][contents] -= used
            if not open_with[gap][contents]:
                del open_with[gap][contents]
            if not open_with[gap]:
                del open_with[gap], gaps[at]
            put(gap - each * length, (*contents, (length, each)), used)
            left -= used * each
    return [Pattern(contents, times) for held in open_with.values() for contents, times in held.items()]


def places(patterns: list[Pattern]) -> np.ndarray:
    """For ranks of a length from `rank` on: sequence, pieces side by side, offset.

    One row for each length of each pattern, sorted by length and rank.
    """
    rows = []
    ranked: Counter = Counter()
    first = 0
    for pattern in patterns:
        offset = 0
        for length, side_by_side in pattern.parts:
            rows.append((length, ranked[length], first, side_by_side, offset))
            ranked[length] += side_by_side * pattern.times
            offset += side_by_side * length
        first += pattern.times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


# Columns that the rows have on the way.
WORKING = ("_group", "_groups", "_rank", "_before", "_n")


def pack(lengths: DataFrame, capacity: int, order: tuple[str, ...]) -> DataFrame:
    """Rows of `lengths` with `sequence_id` and `offset`; `length` is 1 to `capacity`.

    `order` are the columns that tell rows apart; rows equal in them may change
    places. Rows of one length are ranked in groups of bounded size by a hash of
    `order`, however many they are. Columns named as an output are replaced.
    """
    lengths, back = set_aside(lengths.drop("sequence_id", "offset"), WORKING)
    moved = {old: new for new, old in back.items()}
    order = tuple(moved.get(c, c) for c in order)
    lengths = cut(lengths)
    histogram = {r["length"]: r["n"] for r in lengths.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if any(not 1 <= x <= capacity for x in histogram):
        raise ValueError(f"lengths must be 1 to {capacity}")
    table = places(plan(histogram, capacity))
    spark = lengths.sparkSession
    # At most `capacity` rows: how many groups the rows of a length are dealt into.
    groups = spark.createDataFrame(
        [(x, -(-n // RANKED_TOGETHER)) for x, n in histogram.items()], "length long, _groups int"
    )
    dealt = lengths.join(F.broadcast(groups), "length").withColumn(
        "_group", F.pmod(F.xxhash64(*order, F.lit("group")), F.col("_groups"))
    )
    dealt = dealt.select(*lengths.columns, "_group")
    sizes = dealt.groupBy("length", "_group").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("length").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("length", "_group", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_group").orderBy(*order)
    ranked = (
        dealt.withColumn("_rank", F.row_number().over(within))
        .join(before, ["length", "_group"])
        .withColumn("_rank", F.col("_rank") + F.col("_before") - 1)
        .select(*lengths.columns, "_rank")
    )
    shared = spark.sparkContext.broadcast(table)
    kept = list(lengths.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        keys = table[:, 0] << 48 | table[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            row = table[np.searchsorted(keys, length << 48 | rank, side="right") - 1]
            at = rank - row[:, 1]
            sequence, offset = row[:, 2] + at // row[:, 3], row[:, 4] + at % row[:, 3] * length
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(sequence), pa.array(offset)],
                names=[*kept, "sequence_id", "offset"],
            )

    schema = T.StructType([*lengths.schema, *T._parse_datatype_string("sequence_id long, offset long").fields])
    return ranked.mapInArrow(run, schema).withColumnsRenamed(back)
