"""Language identification by word-first backoff.

A known word is scored by its log frequency in each language. A word that no
language's table holds is scored by its longest character n-grams that are known,
going to shorter ones until some are.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, map_rows

UNDETERMINED = "und"

# Runs of word characters that are neither digits nor underscores.
LETTERS = re.compile(r"[^\W\d_]+")

COUNTING_TASKS = 32


@dataclass(frozen=True)
class Settings:
    """Bounds of the model. They fix its size, whatever the size of the corpus.

    `train_rows` is the number of distinct labelled texts that the tables are counted
    from at most, shared out equally among the languages, one at least for each; a
    language's texts of least hash are taken. `words` and `grams` are the entries kept
    for a language (and n-gram length), the most frequent ones. Where there are more,
    those seen less than `least` times are left to the backoff.
    """

    train_rows: int = 6_000
    words: int = 20_000
    grams: int = 5_000
    longest: int = 4
    least: int = 2
    smoothing: float = 0.5
    cached_words: int = 300_000


@dataclass
class Model:
    """For words (0) and each n-gram length, the row of an entry in `logs`.

    A row of `logs` holds an entry's log frequency in each language; row 0, of no
    entry, says nothing.
    """

    languages: list[str]
    tables: list[dict[str, int]]
    logs: np.ndarray
    settings: Settings


def words_of(text: str) -> list[str]:
    found = LETTERS.findall(text.lower())
    return found if text.isascii() else [w for w in found if w.isascii() or any(map(str.isalpha, w))]


def marked(word: str, n: int) -> str:
    """The word with its ends marked, for n-grams that hold more than a mark."""
    return f"_{word}_" if n > 1 else word


def grams_of(word: str, n: int) -> list[str]:
    word = marked(word, n)
    return [word[i : i + n] for i in range(len(word) - n + 1)]


def counts_batch(lang: str, n: int, seen: dict[str, int]) -> pa.RecordBatch:
    columns = [
        pa.array([lang] * len(seen), pa.string()),
        pa.array([n] * len(seen), pa.int32()),
        pa.array(list(seen), pa.string()),
        pa.array(list(seen.values()), pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "n", "gram", "seen"])


def count_grams(labelled: DataFrame, settings: Settings) -> DataFrame:
    """How often each word (n = 0) and n-gram occurs in each language: lang, n, gram, seen."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                words.setdefault(lang, Counter()).update(words_of(text))
        for lang, counted in words.items():
            yield counts_batch(lang, 0, counted)
            for n in range(1, settings.longest + 1):
                seen: dict[str, int] = {}
                for word, times in counted.items():
                    for gram in grams_of(word, n):
                        seen[gram] = seen.get(gram, 0) + times
                yield counts_batch(lang, n, seen)

    return (
        labelled.select("lang", "text")
        .mapInArrow(count, "lang string, n int, gram string, seen long")
        .groupBy("lang", "n", "gram")
        .agg(F.sum("seen").alias("seen"))
    )


def training_rows(rows: DataFrame, settings: Settings) -> DataFrame:
    """Each language's distinct texts, of least hash where it has more than its number.

    Hashes are even, so the texts below twice the number's share of them hold the least
    ones; only those are sorted.
    """
    hashed = rows.withColumn("_hash", F.xxhash64("text"))
    distinct = cut(hashed.select("lang", "_hash").distinct())
    sizes = distinct.groupBy("lang").agg(F.count("*").alias("_n"))
    number = max(1, settings.train_rows // max(1, sizes.count()))
    part = F.shiftrightunsigned("_hash", 11)
    few = part / F.lit(float(1 << 53)) < (2 * number + 200) / F.col("_n")
    least = Window.partitionBy("lang").orderBy(part, "_hash")
    chosen = (
        distinct.join(F.broadcast(sizes), "lang")
        .filter(few)
        .withColumn("_place", F.row_number().over(least))
        .filter(F.col("_place") <= number)
        .select("lang", "_hash")
    )
    taken = hashed.join(F.broadcast(chosen), ["lang", "_hash"], "left_semi")
    once = taken.groupBy("lang", "_hash").agg(F.min("text").alias("text")).select("lang", "text")
    # In a few tasks the counts of all words would be large.
    return once.repartition(COUNTING_TASKS, "text")


def fit(docs: DataFrame, settings: Settings = Settings()) -> Model:
    """Learn from `text` and `lang` of the rows of `docs`; NULL in either teaches nothing.

    Languages are the distinct values of `lang`. An empty table gives a model
    without languages, which answers `und`.
    """
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    counted = count_grams(training_rows(rows, settings), settings)
    per_table = Window.partitionBy("lang", "n")
    most = Window.partitionBy("lang", "n").orderBy(F.desc("seen"), "gram")
    limit = F.when(F.col("n") == 0, settings.words).otherwise(settings.grams)
    kept = (
        counted.withColumn("place", F.row_number().over(most))
        .withColumn("entries", F.count("*").over(per_table))
        .filter(F.col("place") <= limit)
        .filter((F.col("seen") >= settings.least) | (F.col("entries") <= limit))
        .withColumn("total", F.sum("seen").over(per_table))
        .select("lang", "n", "gram", "seen", "total")
        .toArrow()
        .to_pydict()
    )
    languages = sorted(set(kept["lang"]))
    place = {lang: i for i, lang in enumerate(languages)}
    tables: list[dict[str, int]] = [{} for _ in range(settings.longest + 1)]
    totals = np.ones((settings.longest + 1, len(languages)))
    n_rows = 1
    for n, gram in zip(kept["n"], kept["gram"]):
        if gram not in tables[n]:
            tables[n][gram] = n_rows
            n_rows += 1
    logs = np.zeros((n_rows, len(languages)))
    for lang, n, gram, seen, total in zip(*(kept[c] for c in ("lang", "n", "gram", "seen", "total"))):
        totals[n, place[lang]] = total
        logs[tables[n][gram], place[lang]] = seen
    for n, known in enumerate(tables):
        rows_of_table = np.fromiter(known.values(), np.int64, len(known))
        below = np.log(totals[n] + settings.smoothing * max(1, len(known)))
        logs[rows_of_table] = np.log(logs[rows_of_table] + settings.smoothing) - below
    return Model(languages, tables, logs, settings)


class Scorer:
    """Scores texts of one task; a word's scores are worked out once and kept."""

    def __init__(self, model: Model):
        self.model = model
        self.places: dict[str, int] = {}
        self.scores = np.zeros((0, len(model.languages)))

    def evidence(self, words: list[str]) -> np.ndarray:
        """For each word its own row, or the mean of its longest known n-grams' rows."""
        known, *by_length = self.model.tables
        longest_first = [(n, table.get) for n, table in enumerate(by_length, 1)][::-1]
        rows: list[int] = []
        starts = []
        for word in words:
            starts.append(len(rows))
            if (row := known.get(word)) is not None:
                rows.append(row)
                continue
            for n, get in longest_first:
                text = marked(word, n)
                found = [r for i in range(len(text) - n + 1) if (r := get(text[i : i + n])) is not None]
                if found:
                    rows += found
                    break
            else:
                rows.append(0)
        sums = np.add.reduceat(self.model.logs[rows], starts, axis=0)
        return sums / np.diff([*starts, len(rows)])[:, None]

    def learn(self, words: set[str]) -> None:
        if len(self.places) > self.model.settings.cached_words:
            self.places = {}
            self.scores = self.scores[:0]
        if new := [w for w in words if w not in self.places]:
            self.places.update(zip(new, range(len(self.places), len(self.places) + len(new))))
            self.scores = np.vstack([self.scores, self.evidence(new)])

    def predict(self, texts: list[str | None]) -> Iterator[tuple[str, float]]:
        words = [words_of(text) if text else [] for text in texts]
        if self.model.languages:
            self.learn(set().union(*words))
        for found in words:
            if not found or not self.model.languages:
                yield UNDETERMINED, 0.0
                continue
            places = np.fromiter(map(self.places.__getitem__, found), np.int64, len(found))
            total = self.scores[places].sum(axis=0)
            best = int(total.argmax())
            yield self.model.languages[best], float(1 / np.exp(np.maximum(total - total[best], -700)).sum())


def predict(docs: DataFrame, model: Model, keep: tuple[str, ...] | None = None) -> DataFrame:
    """The rows of `docs` with `lang_pred` and `score`, the posterior of that language.

    NULL, empty and letterless texts get `und` and 0. Of languages that score the
    same the first by name is taken. Texts are read whole; equal rows get equal
    results. Input columns named as an output are replaced.
    """
    keep = tuple(c for c in keep or docs.columns if c not in ("lang_pred", "score"))
    # Plain values only: workers unpickle a broadcast without this package.
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.tables, model.logs))
    settings = model.settings

    def make():
        scorer = Scorer(Model(*shared.value, settings))
        return lambda texts: zip(*scorer.predict(texts))

    return map_rows(docs, ["text"], keep, "lang_pred string, score double", make)


def confident(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """Rows of `docs` whose language is determined with a score of `least` or more."""
    found = predict(docs, model)
    return found.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least)).select(*docs.columns)
