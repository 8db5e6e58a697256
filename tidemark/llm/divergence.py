"""How far sources of a language are from one another, and by which terms.

Shares of terms are integers, parts of a billion with one added to each count. A pair of
sources differs by the sum over all kept terms of floor((p - q)^2 / q), exactly.

Most terms are in few sources, and a source without a term has one share for all of
them. So a pair's sum is that of no term anywhere, plus corrections: of terms that one of
the two has, from a histogram of its shares, and of terms that both have. The last come
from a frequent-pattern tree: the shares of a term in order of its sources are a path,
terms with an equal beginning share its nodes, and each node with each node above it
gives one correction, times the terms that go through it. Sorted paths make the tree
node by node, so a task holds one path of it, not the tree; where a task's range begins
inside a subtree, its nodes have the rest of their terms elsewhere, and the sums agree.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut

SHARES = 1_000_000_000

# ASCII letters, lower-cased, and everything beyond ASCII, whose bytes are all above it.
TERM = rb"[a-z\x80-\xFF]+"

# Entries of counts that a task holds before it hands them on, and characters that it
# takes from a text at a time.
COUNTS_HELD = 500_000
# Fewer occurrences than 2 to this are in what a task holds, which is far below a terabyte.
DOCUMENT_BITS = 40
# Corrections that a task works out together.
CORRECTIONS_AT_A_TIME = 50_000


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs: occurrences of terms, and documents that have them.

    Counted in the task that reads the texts, so that a term is dealt out once for each
    of its sources and tasks, and added up where all of the term meet. Every group has a
    row of NULL term besides. NULL text, lang and source are empty.
    """
    inputs = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        terms = re.compile(TERM)
        # Occurrences of a term and, above DOCUMENT_BITS, the documents that have it.
        held: dict[tuple[str, str], dict[bytes, int]] = {}
        size = 0

        def made() -> pa.RecordBatch:
            sizes = [len(found) + 1 for found in held.values()]
            lang, source = (pa.array(np.repeat(np.array(side, object), sizes), pa.string()) for side in zip(*held))
            term = pa.array([t for found in held.values() for t in (None, *found)], pa.binary()).cast(pa.string())
            both = np.array([n for found in held.values() for n in (0, *found.values())], np.int64)
            n, docs = both & ((1 << DOCUMENT_BITS) - 1), both >> DOCUMENT_BITS
            return pa.RecordBatch.from_arrays(
                [lang, source, term, pa.array(n), pa.array(docs)], names=["lang", "source", "term", "n", "docs"]
            )

        for batch in batches:
            lang, source, texts = batch.columns
            texts = texts.cast(pa.binary())
            for row in range(batch.num_rows):
                known = held.setdefault((lang[row].as_py(), source[row].as_py()), {})
                size -= len(known)
                for t, n in Counter(terms.findall(texts[row].as_py().lower())).items():
                    known[t] = known.get(t, 0) + n + (1 << DOCUMENT_BITS)
                size += len(known)
                if size >= COUNTS_HELD:
                    yield made()
                    held, size = {}, 0
        if held:
            yield made()

    partial = docs.select(*inputs).mapInArrow(run, "lang string, source string, term string, n long, docs long")
    met = partial.repartition("lang", "term")
    return met.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SHARES * (count + 1) / (total + kept)), exact at any size."""
    wide = (count.cast("decimal(20,0)") + 1) * F.lit(SHARES).cast("decimal(10,0)")
    return 1 + F.call_function("div", wide, (total + kept).cast("decimal(20,0)"))


def distance(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q) of two shares, each 1 to 1 + SHARES, as a decimal."""
    return F.call_function("div", (p - q) * (p - q), q).cast("decimal(20,0)")


class Tree:
    """The frequent-pattern tree of one language's sorted paths, one path at a time.

    Items are (source, share, share without the term). A node that is left for good has
    all of its terms: it is corrected with every node above it and its terms go to its
    parent.
    """

    def __init__(self) -> None:
        self.path = np.zeros((16, 3), np.int64)
        self.items: list[tuple[int, int, int]] = []
        self.terms: list[int] = []
        self.sums: dict[tuple[int, int], int] = {}
        self._forget()

    def _forget(self) -> None:
        self.above: list[np.ndarray] = []
        self.nodes: list[tuple[int, int, int]] = []
        self.times: list[int] = []
        self.noted = 0

    def leave(self, depth: int) -> None:
        """Leave the nodes of the path below `depth`."""
        while len(self.items) > depth:
            node, terms = self.items.pop(), self.terms.pop()
            if self.items:
                self.terms[-1] += terms
                self.above.append(self.path[: len(self.items)].copy())
                self.nodes.append(node)
                self.times.append(terms)
                self.noted += len(self.items)
                if self.noted >= CORRECTIONS_AT_A_TIME:
                    self.correct()

    def insert(self, items: list[tuple[int, int, int]], terms: int) -> None:
        shared = 0
        for a, b in zip(self.items, items):
            if a != b:
                break
            shared += 1
        self.leave(shared)
        while len(items) > len(self.path):
            self.path = np.concatenate([self.path, np.zeros_like(self.path)])
        self.path[shared : len(items)] = items[shared:]
        self.items.extend(items[shared:])
        self.terms.extend([0] * (len(items) - shared))
        if self.terms:
            self.terms[-1] += terms

    def correct(self) -> None:
        """Add up the corrections of the noted nodes and ancestors by pair of sources.

        Shares are little above 2^30 at most, so squares fit; where sums might not, they
        are Python's integers.
        """
        if not self.nodes:
            return
        depths = [len(a) for a in self.above]
        a = np.concatenate(self.above).T
        b = np.repeat(np.array(self.nodes, np.int64), depths, axis=0).T
        times = np.repeat(np.array(self.times, np.int64), depths)
        self._forget()

        def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
            return (p - q) ** 2 // q

        for (i, p, without_p), (j, q, without_q) in ((a, b), (b, a)):
            each = apart(p, q) - apart(p, without_q) - apart(without_p, q) + apart(without_p, without_q)
            order = np.lexsort((j, i))
            i, j, n = i[order], j[order], times
            if int(np.abs(each).max()) * int(times.sum()) >= 1 << 62:
                each, n = each.astype(object), times.astype(object)
            starts = np.flatnonzero(np.r_[True, (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
            added = np.add.reduceat((each * n)[order], starts)
            for pair, value in zip(zip(i[starts].tolist(), j[starts].tolist()), added.tolist()):
                self.sums[pair] = self.sums.get(pair, 0) + value

    def finish(self) -> dict[tuple[int, int], int]:
        self.leave(0)
        self.correct()
        return self.sums


def shared_corrections(paths: DataFrame) -> DataFrame:
    """lang, a, b, value: corrections of pairs of sources for the terms that both have.

    `paths` has lang, items (array of source, share, share without the term, in order of
    the source) and terms, how many terms have these items.
    """
    ordered = paths.repartitionByRange("lang", "items").sortWithinPartitions("lang", "items")
    columns = ordered.select("lang", *(F.col(f"items.{c}").alias(c) for c in ("rank", "p", "z")), "terms")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, tree = None, Tree()
        for batch in batches:
            done = []
            for lang, *sides, terms in zip(*(c.to_pylist() for c in batch.columns)):
                if lang != at:
                    done.append((at, tree.finish()))
                    at, tree = lang, Tree()
                tree.insert(list(zip(*sides)), terms)
            yield made(done)
        yield made([(at, tree.finish())])

    def made(found: list[tuple[str, dict]]) -> pa.RecordBatch:
        rows = [(lang, *pair, str(n)) for lang, sums in found for pair, n in sums.items()]
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.string())
        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "a", "b", "value"])

    parts = columns.mapInArrow(run, "lang string, a int, b int, value string")
    return parts.groupBy("lang", "a", "b").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))


def audit(docs: DataFrame, least_docs: int = 3, terms_shown: int = 200) -> DataFrame:
    """lang, source, part, item, value, rank: how every source differs, and by which terms.

    Part `pair` has the distance of each group (lang, source) from every other source of
    its language, part `term` its terms above the language's share, at most `terms_shown`.
    Terms in fewer than `least_docs` documents of the language do not count; repeated
    documents count each. A language without kept terms has distances of 0. Equal
    values rank by item, in order of UTF-8 bytes. No documents, no rows.
    """
    by_term = term_counts(docs).groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"),
        F.sum("n").alias("lang_n"),
        F.collect_list(F.struct("source", "n")).alias("found"),
    )
    # The terms that count, and for each language one row of NULL term with all its sources.
    by_term = cut(by_term.filter(F.col("term").isNull() | (F.col("docs") >= least_docs)).drop("docs"))
    terms_kept = by_term.filter(F.col("term").isNotNull())
    kept = terms_kept.select("lang", "term", "lang_n", F.inline("found").alias("source", "n"))

    # One row for each group: its order in the language, its occurrences, the kept terms.
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = terms_kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    place = Window.partitionBy("lang").orderBy("source")
    zero = F.lit(0).cast("long")
    groups = (
        by_term.filter(F.col("term").isNull())
        .select("lang", F.explode("found.source").alias("source"))
        .join(sizes, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .select("lang", "source", *(F.coalesce(c, zero).alias(c) for c in ("total", "kept", "lang_total")), F.row_number().over(place).alias("rank"))
        .withColumn("z", F.when(F.col("kept") > 0, share(zero, F.col("total"), F.col("kept"))))
    )
    groups = cut(groups)

    shares = cut(
        kept.join(groups, ["lang", "source"]).select(
            "lang",
            "source",
            "rank",
            "term",
            "z",
            share(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
            share(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q"),
        )
    )

    value = distance(F.col("p"), F.col("q")).cast("long")
    first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = (
        shares.filter(F.col("p") > F.col("q"))
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), value.alias("value"))
        .withColumn("rank", F.row_number().over(first))
        .filter(F.col("rank") <= terms_shown)
    )

    # Terms that both sources of a pair have.
    items = F.array_sort(F.collect_list(F.struct("rank", "p", "z")))
    paths = shares.groupBy("lang", "term").agg(items.alias("items")).filter(F.size("items") > 1)
    both = shared_corrections(paths.groupBy("lang", "items").agg(F.count("*").alias("terms")))

    # Terms that one source has, for each other source of its language.
    histogram = shares.groupBy("lang", "rank", "z", "p").agg(F.count("*").alias("terms"))
    others = groups.filter(F.col("kept") > 0).select("lang", F.col("rank").alias("other"), F.col("z").alias("y"))
    one = histogram.join(others, "lang").filter(F.col("rank") != F.col("other"))
    p, z, y, n = (F.col(c) for c in ("p", "z", "y", "terms"))
    from_it = F.sum((distance(p, y) - distance(z, y)) * n)
    to_it = F.sum((distance(y, p) - distance(y, z)) * n)
    one = one.groupBy("lang", "rank", "other").agg(from_it.alias("from_it"), to_it.alias("to_it"))
    either = one.select("lang", F.col("rank").alias("a"), F.col("other").alias("b"), F.col("from_it").alias("value")).unionByName(
        one.select("lang", F.col("other").alias("a"), F.col("rank").alias("b"), F.col("to_it").alias("value"))
    )

    left, right = (
        groups.select("lang", F.col("source").alias(s), F.col("rank").alias(r), F.col("z").alias(w), F.col("kept").alias(k))
        for s, r, w, k in (("source", "a", "za", "kept"), ("item", "b", "zb", "k"))
    )
    none = F.coalesce(distance(F.col("za"), F.col("zb")) * F.col("kept"), F.lit(0).cast("decimal(38,0)"))
    pairs = left.join(right.drop("k"), "lang").filter(F.col("a") != F.col("b")).select("lang", "a", "b", "source", "item", none.alias("value"))
    wide = F.col("value").cast("decimal(38,0)").alias("value")
    names = [F.lit(None).cast("string").alias(c) for c in ("source", "item")]
    added = either.select("lang", "a", "b", *names, wide).unionByName(both.select("lang", "a", "b", *names, wide))
    summed = (
        pairs.select("lang", "a", "b", "source", "item", wide)
        .unionByName(added)
        .groupBy("lang", "a", "b")
        .agg(F.max("source").alias("source"), F.max("item").alias("item"), F.sum("value").cast("long").alias("value"))
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
        .withColumn("rank", F.row_number().over(first))
    )
    return summed.unionByName(terms)
