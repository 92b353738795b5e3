"""Language identification, word first with backoff to shorter and shorter n-grams.

A word that training has seen scores by its smoothed log frequency in each language.  An
unseen word falls back to its byte n-grams (marked at both ends): the longest length of
``GRAMS`` at which any of its n-grams is known decides, by the mean of their per-language
log frequencies; a word without any known n-gram adds nothing.  A text's language has the
largest sum; the score is the softmax over the sums per word, sharpened by the number of
words up to ``SHARP``.

Learned from at most ``MAX_DOCS`` documents with an id and a language outside the held-out fold (lowest
id hash): the n-grams of all their words, and per language its ``WORDS_PER_LANG`` most frequent words, so a
small language keeps its words beside a large one.  Every language of the sample is learned.

Defined results: a null text or one without a letter is ``und`` with score 0; a text whose
words are all unknown to the end gets the language most frequent in training; ties go to the
alphabetically first; repeated rows score alike; without labelled rows all is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm import text as X
from ledgerlens.llm.corpus import append, drop, held_out, lowest_hashed, table, written

GRAMS = (5, 4, 3, 2, 1)
MAX_DOCS = 20_000
WORDS_PER_LANG = 1 << 16
SHARP = 8.0
FOLDS, HELD_OUT = 3, 1
UNKNOWN = "und"


def grams(words: X.Words, which: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, hash) of the byte n-grams of the chosen words, each word marked at both ends."""
    start, size = words.start[which], words.end[which] - words.start[which]
    stretch = size + 2
    first = np.cumsum(stretch) - stretch
    marked = np.full(int(stretch.sum()), 257, np.uint64)
    marked[first] = 256
    marked[X.ragged(first + 1, size)] = words.data[X.ragged(start, size)]
    owner = np.repeat(np.arange(len(which)), stretch)
    if n == 1:  # a mark alone tells nothing
        inner = marked < 256
        return owner[inner], X.mix(marked[inner] + X.U64(1))
    h, at = X.window_hashes(X.mix(marked + X.U64(1)), owner, n)
    return owner[at], h


@dataclass
class Table:
    """Sorted hashes with one row of log frequencies per language."""

    key: np.ndarray
    logs: np.ndarray

    @classmethod
    def build(cls, key: np.ndarray, lang: np.ndarray, count: np.ndarray, n: int) -> Table:
        keys, row = np.unique(key, return_inverse=True)
        c = np.zeros((len(keys), n))
        np.add.at(c, (row, lang), count)
        return cls(keys, np.log((c + 0.1) / (c.sum(0) + 0.1 * len(keys))).astype(np.float32))

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of ``wanted`` are known, their rows)."""
        if not len(self.key):
            return np.zeros(0, np.int64), np.zeros((0, self.logs.shape[1]), np.float32)
        at = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
        known = np.flatnonzero(self.key[at] == wanted)
        return known, self.logs[at[known]]


@dataclass
class Model:
    langs: list[str] = field(default_factory=list)
    prior: np.ndarray | None = None
    words: Table | None = None
    grams: dict[int, Table] = field(default_factory=dict)

    def evidence(self, w: X.Words, which: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Per chosen word: its log frequencies, by word or by the longest known n-grams."""
        out = np.zeros((len(which), len(self.langs)), np.float64)
        known, rows = self.words.find(h)
        out[known] = rows
        left = np.setdiff1d(np.arange(len(which)), known, assume_unique=True)
        for n in GRAMS:
            if not len(left):
                break
            owner, gram = grams(w, which[left], n)
            hit, rows = self.grams[n].find(gram)
            hits = np.bincount(owner[hit], minlength=len(left))
            sums = np.stack([np.bincount(owner[hit], weights=rows[:, k], minlength=len(left)) for k in range(out.shape[1])], 1)
            done = hits > 0
            out[left[done]] = sums[done] / hits[done][:, None]
            left = left[~done]
        return out

    def predict(self, text: pa.Array) -> tuple[list[str], np.ndarray]:
        """(language, score) per row; rows without a letter are for the caller to mark."""
        w = X.words(text, X.NON_LETTERS)
        n = len(w.offsets) - 1
        if not self.langs:
            return [UNKNOWN] * n, np.zeros(n)
        h = X.hash_words(w)
        codes, values, first = X.distinct(h)
        each = self.evidence(w, first, values)
        total = np.stack([np.bincount(w.doc, weights=each[codes, k], minlength=n) for k in range(len(self.langs))], 1)
        total = total / np.maximum(w.per_doc, 1)[:, None]
        same = total.max(1, keepdims=True) - total.min(1, keepdims=True) < 1e-12
        total = np.where(same, self.prior, total)
        z = total * np.clip(w.per_doc, 1, SHARP)[:, None]
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        best = p.argmax(1)
        return [self.langs[k] for k in best], p[np.arange(n), best]


def fit(docs: DataFrame, max_docs: int = MAX_DOCS) -> Model:
    """Counts from the training documents; ``docs`` has doc_id, lang and text (in lower case)."""
    usable = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id", FOLDS, HELD_OUT))
    ids = lowest_hashed(usable.select("doc_id", "lang"), max_docs, "lang")
    langs = [(r.lang, r.n) for r in ids.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()]
    if not langs:
        return Model()
    names = sorted(x for x, _ in langs)
    sample = usable.join(F.broadcast(ids.select("doc_id", "lang").distinct()), ["doc_id", "lang"], "left_semi")

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {x: k for k, x in enumerate(names)}
        for part in X.slices(batches):
            lang = np.array([place.get(x, -1) for x in part.column("lang").to_pylist()])
            w = X.words(part.column("text"), X.NON_LETTERS)
            h, of = X.hash_words(w), lang[w.doc]
            codes, _, first = X.distinct(X.mix(h + X.mix(of.astype(np.uint64) + X.U64(2))))
            count = np.bincount(codes, minlength=len(first))
            keep = of[first] >= 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(w.take(first[keep]), pa.binary()), pa.array(of[first[keep]].astype(np.int32)), pa.array(count[keep])],
                ["word", "lang", "n"])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = X.words(batch.column("word"), np.zeros(256, bool))
            lang, n = (batch.column(c).to_numpy()[w.doc] for c in ("lang", "n"))
            for size in GRAMS:
                owner, gram = grams(w, np.arange(len(w.doc)), size)
                codes, _, first = X.distinct(X.mix(gram + X.mix(lang[owner].astype(np.uint64) + X.U64(2))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(first), size, np.int32)), pa.array(gram[first].view(np.int64)), pa.array(lang[owner][first], pa.int32()),
                     pa.array(np.bincount(codes, weights=n[owner], minlength=len(first)).astype(np.int64))], ["size", "gram", "lang", "n"])

    counts = written(sample.select("lang", "text").mapInArrow(tally, "word binary, lang int, n long")
                     .groupBy("word", "lang").agg(F.sum("n").alias("n")), "words")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))  # of a bounded sample
    frequent = counts.withColumn("place", place).filter(F.col("place") <= WORDS_PER_LANG).drop("place").toPandas()
    parts = counts.mapInArrow(split, "size int, gram long, lang int, n long").groupBy("size", "gram", "lang").agg(F.sum("n").alias("n")).toPandas()
    drop(counts)
    w = X.words(pa.array([bytes(x) for x in frequent.word], pa.binary()), np.zeros(256, bool))
    lang, n = frequent.lang.to_numpy()[w.doc], frequent.n.to_numpy()[w.doc].astype(float)
    by_gram = {}
    for size in GRAMS:
        of = parts[parts["size"] == size]
        by_gram[size] = Table.build(of.gram.to_numpy().view(np.uint64), of.lang.to_numpy(), of.n.to_numpy(float), len(names))
    share = np.array([dict(langs)[x] for x in names], float)
    return Model(names, np.log(share / share.sum()), Table.build(X.hash_words(w), lang, n, len(names)), by_gram)


def identify(docs: DataFrame, model: Model) -> tuple[DataFrame, str]:
    """``docs`` (text in lower case) with a struct of ``lang`` and ``score``; also the struct's name."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def measure(part: pa.RecordBatch) -> list[pa.Array]:
        lang, score = shared.value.predict(part.column("text"))
        return [pa.array(lang, pa.string()), pa.array(score)]

    return append(docs, measure, T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())]))


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("text", F.lower("text"))
    model = fit(docs.select("doc_id", "lang", "text"))
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    out, m = identify(docs.select("doc_id", "text", lettered.alias("lettered")), model)
    return out.select("doc_id", held_out("doc_id", FOLDS, HELD_OUT).alias("held_out"),
                      F.when(F.col("lettered"), F.col(f"{m}.lang")).otherwise(F.lit(UNKNOWN)).alias("lang_pred"),
                      F.when(F.col("lettered"), F.col(f"{m}.score")).otherwise(F.lit(0.0)).alias("score"))
