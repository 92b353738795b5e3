"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors of its features: every word, every byte n-gram
of lengths ``GRAMS`` of the marked word, and every pair of neighbouring words (a word that
follows itself is one and the same feature whatever the word), hashed into ``BUCKETS`` rows
of ``DIM`` numbers.  A softmax layer over the average gives the class.  Vectors and layer are
trained by numpy stochastic gradient descent, one labelled document a step.

The training sample is bounded by ``PER_CLASS`` documents of either class (lowest id hash
outside the held-out fold; whole texts, as hashed feature counts of at most ``BUCKETS``
entries); the class shares of all labels correct the sample's.

Defined results: null, empty or wordless texts have no feature and score the share of good
labels; repeated rows score alike; labels in conflict for one id are not used; without labels
of both classes every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm import text as X
from ledgerlens.llm.corpus import append, held_out, labelled_sample, one_label, table

BUCKETS = 1 << 16
DIM = 8
GRAMS = (3, 4)
PER_CLASS = 1500
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
EPOCHS = 6
RATE = 0.5


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> X.U64(64 - 16)).astype(np.int64) % BUCKETS


def word_features(w: X.Words, which: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) of the word itself and of its byte n-grams, for the words ``which`` with hashes ``h``."""
    start, size = w.start[which], w.end[which] - w.start[which]
    stretch = size + 2
    first = np.cumsum(stretch) - stretch
    marked = np.full(int(stretch.sum()), 257, np.uint64)
    marked[first] = 256
    marked[X.ragged(first + 1, size)] = w.data[X.ragged(start, size)]
    owner = np.repeat(np.arange(len(which)), stretch)
    marked = X.mix(marked + X.U64(1))
    words, buckets = [np.arange(len(which))], [_bucket(X.mix(h + X.U64(7)))]
    for n in GRAMS:
        gram, at = X.window_hashes(marked, owner, n)
        words.append(owner[at])
        buckets.append(_bucket(gram))
    return np.concatenate(words), np.concatenate(buckets)


_SAME = np.array([0x51ED270B7A3C9D11], np.uint64)


def pair_features(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position of the first word, bucket) of neighbouring words of one row."""
    at = np.flatnonzero(doc[1:] == doc[:-1])
    a, b = h[at], h[at + 1]
    return at, _bucket(np.where(a == b, _SAME, X.mix(a * X._BASE + b)))


@dataclass
class Model:
    """The trained softmax layer folded into one weight per feature, as the average is linear."""

    weight: np.ndarray
    bias: float = 0.0

    def score(self, text: pa.Array) -> np.ndarray:
        w = X.words(text)
        n = len(w.offsets) - 1
        h = X.hash_words(w)
        codes, values, first = X.distinct(h)
        word, bucket = word_features(w, first, values)
        total = np.bincount(word, weights=self.weight[bucket], minlength=len(first))[codes]
        count = np.bincount(word, minlength=len(first))[codes]
        at, pair = pair_features(h, w.doc)
        total[at] += self.weight[pair]
        count[at] += 1
        logit = np.bincount(w.doc, weights=total, minlength=n) / np.maximum(np.bincount(w.doc, weights=count, minlength=n), 1)
        return 1 / (1 + np.exp(-np.clip(logit + self.bias, -30, 30)))


def bags(docs: DataFrame) -> DataFrame:
    """(label, feature buckets, their shares) of every labelled text, as packed arrays."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in X.slices(batches):
            w = X.words(part.column("text"))
            h = X.hash_words(w)
            codes, values, first = X.distinct(h)
            word, bucket = word_features(w, first, values)
            order = np.argsort(word, kind="stable")
            bucket, sizes = bucket[order], np.bincount(word, minlength=len(first))
            starts = np.cumsum(sizes) - sizes
            at, pair = pair_features(h, w.doc)
            ids, shares = [], []
            bounds = np.searchsorted(w.doc, np.arange(part.num_rows + 1))
            pbounds = np.searchsorted(w.doc[at], np.arange(part.num_rows + 1))
            for i in range(part.num_rows):
                c = codes[bounds[i]: bounds[i + 1]]
                f = np.concatenate([bucket[X.ragged(starts[c], sizes[c])], pair[pbounds[i]: pbounds[i + 1]]])
                u, k = np.unique(f, return_counts=True)
                ids.append(u.astype(np.uint32).tobytes())
                shares.append((k / max(1, len(f))).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), pa.array(ids, pa.binary()),
                                              pa.array(shares, pa.binary())], ["doc_id", "label", "ids", "shares"])

    return docs.select("doc_id", F.col("label").cast("int").alias("label"), "text").mapInArrow(
        run, "doc_id long, label int, ids binary, shares binary")


def train(label: np.ndarray, ids: list[np.ndarray], shares: list[np.ndarray], seed: int = 7) -> np.ndarray:
    """Weight of every feature, by stochastic gradient descent on the softmax loss.

    A document's step on its vectors is scaled by its effective number of features, else the
    average over thousands of features would leave each of them almost where it was; and every
    step by the layer's norm, else a grown layer overshoots.
    """
    rng = np.random.default_rng(seed)
    vectors = (rng.random((BUCKETS, DIM), np.float32) - 0.5) / DIM
    layer = np.zeros((2, DIM), np.float32)
    steps, done = EPOCHS * len(label), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(label)):
            rate = RATE * (1 - done / steps) / (1 + float((layer * layer).sum()))
            done += 1
            x, s = ids[i], shares[i]
            if not len(x):
                continue
            mean = s @ vectors[x]
            z = layer @ mean
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label[i]] -= 1
            back = p @ layer
            layer -= rate * np.outer(p, mean)
            vectors[x] -= rate / float(s @ s) * np.outer(s, back)
    return vectors @ (layer[1] - layer[0])


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    seen = bags(labelled_sample(docs, labels, "quality", FOLDS, HELD_OUT, per_class)).toPandas().sort_values("doc_id")
    if seen.label.nunique() < 2:
        return Model(np.zeros(BUCKETS))
    label = seen.label.to_numpy()
    weight = train(label, [np.frombuffer(x, np.uint32).astype(np.int64) for x in seen.ids],
                   [np.frombuffer(x, np.float32) for x in seen.shares])
    prior = one_label(labels, "quality").filter(~held_out("doc_id", FOLDS, HELD_OUT)).agg(F.avg("label")).first()[0]
    own = float(label.mean())
    return Model(weight, float(np.log(prior / (1 - prior)) - np.log(own / (1 - own))))


def score(docs: DataFrame, model: Model) -> tuple[DataFrame, str]:
    """``docs`` with a struct column that holds ``score``; also the struct's name."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return append(docs, lambda part: [pa.array(shared.value.score(part.column("text")))],
                  T.StructType([T.StructField("score", T.DoubleType())]))


def quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out, m = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    s = F.col(f"{m}.score")
    return out.select("doc_id", held_out("doc_id", FOLDS, HELD_OUT).alias("held_out"), s.alias("score"),
                      (s >= THRESHOLD).cast("int").alias("predicted"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str, least: float = 0.5) -> DataFrame:
    """Pipeline stage: the documents likelier good than not, with the columns they came with."""
    out, m = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return out.filter(F.col(f"{m}.score") >= least).select([F.col(f"`{c}`") for c in docs.columns])
