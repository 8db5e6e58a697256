"""BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash cuts texts where their contents say so, so a passage that documents
share is cut alike in each, encoded once in a task and reused. What the cuts break is
repaired: the text around each join is encoded anew, from the last place in the chunk
before to the first place in the chunk after at which the encodings of chunk and whole
text are bound to agree.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.common import ROWS_AT_A_TIME, kept_by_worker, map_rows

# The text and id of the vocabulary's special token, and the pattern
# that splits a text before merges.
SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

WINDOW = 16
MULTIPLIER = 0x9E3779B1
# One place in 2 ** 9 is a cut, none nearer than this to the one before.
CUT_BITS = 9
LEAST_CHUNK = 64

# Chunks kept for reuse; longer ones than the second figure are not kept.
KEPT_CHUNKS = 40_000
LONGEST_KEPT = 8192


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def cuts(data: np.ndarray) -> list[int]:
    """Ends of chunks: where the hash of the last WINDOW bytes has its first bits zero."""
    hashes = (data.astype(np.uint32) + np.uint32(1)) * np.uint32(0x85EBCA6B)
    width, factor = 1, MULTIPLIER
    while width < WINDOW:
        longer = hashes.copy()
        longer[width:] += hashes[:-width] * np.uint32(factor)
        hashes, width, factor = longer, 2 * width, factor * factor & 0xFFFFFFFF
    found, last = [], 0
    for at in (np.flatnonzero(hashes >> np.uint32(32 - CUT_BITS) == 0) + 1).tolist():
        if at - last >= LEAST_CHUNK:
            found.append(at)
            last = at
    return found


def agreed(data: np.ndarray) -> np.ndarray:
    """Places before a space and after a visible ASCII character.

    The splitting pattern never joins a character with a space after it and looks back
    at nothing, so a text is split there whatever stands around. The special token
    holds no space.
    """
    before = data[:-1]
    return np.flatnonzero((data[1:] == 32) & (before >= 33) & (before <= 126)) + 1


def parts(text: bytes) -> list[tuple[int, int, bool]]:
    """Start, end and whether it is the inside of a chunk, for parts that make up a text."""
    data = np.frombuffer(text, np.uint8)
    if len(data) < 2 * LEAST_CHUNK:
        return [(0, len(data), False)] if len(data) else []
    bounds = [0, *cuts(data), len(data)]
    safe = agreed(data)
    first = np.searchsorted(safe, bounds[:-1], side="left")
    last = np.searchsorted(safe, bounds[1:], side="right") - 1
    found, at = [], 0
    for a, b in zip(first.tolist(), last.tolist()):
        if a < b:
            start, end = int(safe[a]), int(safe[b])
            if at < start:
                found.append((at, start, False))
            found.append((start, end, True))
            at = end
    if at < len(data):
        found.append((at, len(data), False))
    return found


class Encoder:
    """Encodes texts of one task; insides of chunks are encoded once while kept."""

    def __init__(self, path: str):
        import tiktoken

        self.encoding = tiktoken.Encoding(
            "bytes", pat_str=PATTERN, mergeable_ranks=read_ranks(path), special_tokens={SPECIAL: SPECIAL_ID}
        )
        self.kept: dict[bytes, bytes] = {}

    def fresh(self, part: bytes) -> bytes:
        text = part.decode()
        if SPECIAL in text:
            ids = self.encoding.encode(text, allowed_special="all")
        else:
            ids = self.encoding.encode_ordinary(text)
        return np.array(ids, np.int32).tobytes()

    def encode(self, text: str) -> bytes:
        data = text.encode()
        made = []
        for start, end, inside in parts(data):
            part = data[start:end]
            ids = self.kept.get(part)
            if ids is None:
                ids = self.fresh(part)
                if inside and len(part) <= LONGEST_KEPT:
                    if len(self.kept) >= KEPT_CHUNKS:
                        self.kept.clear()
                    self.kept[part] = ids
            made.append(ids)
        return b"".join(made)


def encode(docs: DataFrame, ranks_path: str, keep: tuple[str, ...] | None = None) -> DataFrame:
    """The rows of `docs` with the token ids of their whole text, `ids`.

    A NULL text is an empty one and has no ids. `ranks_path` names the vocabulary's
    rank file, at the same place on every machine. The special token's text is the
    special token. An input column `ids` is replaced.
    """
    keep = [c for c in keep or docs.columns if c != "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_by_worker(("chunk encoder", ranks_path), lambda: Encoder(ranks_path))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_A_TIME):
                part = batch.slice(at, ROWS_AT_A_TIME)
                made = [encoder.encode(t or "") for t in part.column("text").to_pylist()]
                ends = np.cumsum([0, *(len(ids) // 4 for ids in made)], dtype=np.int32)
                values = pa.array(np.frombuffer(b"".join(made), np.int32))
                ids = pa.ListArray.from_arrays(pa.array(ends), values)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), ids], names=[*keep, "ids"])

    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """The rows of `encoded` with `decoded`, the text of their `ids`.

    Bytes that are no UTF-8 become replacement characters; NULL ids give NULL. An
    input column `decoded` is replaced.
    """
    keep = [c for c in encoded.columns if c != "decoded"]

    def make():
        tokens: list[bytes] = [b""] * (SPECIAL_ID + 1)
        for token, rank in read_ranks(ranks_path).items():
            tokens[rank] = token
        tokens[SPECIAL_ID] = SPECIAL.encode()

        def text(ids: list[int] | None) -> str | None:
            return None if ids is None else b"".join(map(tokens.__getitem__, ids)).decode("utf-8", "replace")

        return lambda many: ([text(ids) for ids in many],)

    return map_rows(encoded, ["ids"], keep, "decoded string", make)
