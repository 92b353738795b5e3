"""Toxicity by class-conditional Kneser-Ney models.

Two models of how words are spelled, of toxic and of ordinary labelled documents.  A model gives every
letter (byte) of a word, and the word's end, a probability after the ``ORDER`` bytes before it in the word
(its start counts as one).  Each class discounts its own counts of a letter after a history and
gives what is left, and a fixed ``MASS`` of further counts, to the backoff; the backoff is *shared*: a
Kneser-Ney model one byte shorter whose counts are continuation counts, the number of different longer
histories of either class.  So after a rare history both models say nearly the same, while a stem that
one class keeps using stands out in every word made of it, also in words never seen whole.

A document is compared by two length-normalised numbers: the difference of its log-likelihoods per word, and
per word what single words differ by beyond ``EXCESS``.  A logistic map, fitted on numbers by models that
have not counted the document at hand (the documents are taken in ``PARTS``), turns them into a score.

All labelled documents outside the held-out fold are counted and calibrate the map; copies of a text count once.  Words
are runs of letters, ASCII letters in lower case.

The model is a table, trained in groups: everything that a gram's probability needs has the same shorter history.  Every
different word is spelled once and sums its grams' numbers, then every document sums its words'.  Both
sums take the most frequent ``FREQUENT`` keys from a table that every worker is sent, and join the others; which are
which changes no result.

Defined results: a null, empty or wordless text scores as differences of 0; repeated rows score alike; labels in
conflict for one id are not used; without labelled documents of both classes every score is the neutral 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm import text as X
from ledgerlens.llm.corpus import drop, fresh, held_out, labelled, one_label, table, written

#: Bytes of history.
ORDER = 6
#: Taken from each count, of a class and of the shared model.
DISCOUNT = 0.75
#: Counts' worth that the shared backoff adds to every history of a class.
MASS = 10.0
#: Symbols that the shared model backs off to, all alike.
ALPHABET = 200
#: What a word's log-likelihoods differ by beyond this is counted once more.
EXCESS = 3.0
FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
#: Parts of the labelled documents: each is compared by models that have not counted it, to fit the logistic map.
PARTS = 4
#: Grams or words, at most, that every worker is sent.
FREQUENT = 1 << 18
#: Grams that are trained together.
GROUP_GRAMS = 1 << 16
#: Text bytes whose words are counted at once.
COUNT_BYTES = 4 << 20
_EDGE = X.U64(0x9E6C63D0876A9A47)


def lower_ascii(column: pa.Array) -> pa.Array:
    """ASCII letters in lower case; other bytes as they are."""
    data, offsets = X.text_bytes(column)
    upper = (data >= 65) & (data <= 90)
    return X.binary_list(np.where(upper, data | 32, data), offsets)


@dataclass
class Spelling:
    """The symbols of a column's words, one after the other: hashes of history and of history with symbol, for both orders."""

    gram: np.ndarray
    history: np.ndarray
    short_gram: np.ndarray
    short_history: np.ndarray
    word: np.ndarray
    words: X.Words


def spelling(text: pa.Array) -> Spelling:
    """All words of a column."""
    w = X.words(lower_ascii(text), X.NON_LETTERS)
    return spelled(w, np.arange(len(w.doc)))


def spelled(w: X.Words, which: np.ndarray) -> Spelling:
    """The words ``which`` of ``w``; ``word`` of the result counts them from 0."""
    begin, end = w.start[which], w.end[which]
    size = end - begin + 1  # the word's end is a symbol of its own
    word = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(word)) - np.repeat(np.cumsum(size) - size, size) + begin[word]
    first = begin[word]
    h = short = np.zeros(len(word), np.uint64)
    for back in range(1, ORDER + 1):
        before = at - back
        h = h * X._BASE + np.where(before >= first, X._BYTE[w.data[np.maximum(before, 0)]], _EDGE) if len(word) else h
        if back == ORDER - 1:
            short = X.mix(h)
    h = X.mix(h + X.U64(1))
    symbol = np.where(at < end[word], X._BYTE[w.data[np.minimum(at, max(len(w.data) - 1, 0))]], X.U64(0)) if len(word) else np.zeros(0, np.uint64)
    return Spelling(X.mix(h + symbol), h, X.mix(short + symbol), short, word, w)


def _look(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values of the wanted keys, whether they are known); ``keys`` are sorted."""
    if not len(keys):
        return np.zeros(len(wanted)), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    known = keys[at] == wanted
    return np.where(known, values[at], 0.0), known


_NOTHING = np.zeros(0, np.uint64)


@dataclass
class Model:
    """Log-likelihood differences (toxic less ordinary) of known symbols after their history, and of any other symbol after a known history."""

    gram: np.ndarray = field(default_factory=lambda: _NOTHING)
    gram_llr: np.ndarray = field(default_factory=lambda: np.zeros(0))
    history: np.ndarray = field(default_factory=lambda: _NOTHING)
    history_llr: np.ndarray = field(default_factory=lambda: np.zeros(0))
    slope: np.ndarray = field(default_factory=lambda: np.zeros(2))
    bias: float = 0.0

    def differences(self, text: pa.Array) -> np.ndarray:
        """(rows, 2): per word the difference of the log-likelihoods, and the words' excesses."""
        w = X.words(lower_ascii(text), X.NON_LETTERS)
        n = len(w.offsets) - 1
        codes, _, first = X.distinct(X.hash_words(w))  # every different word is spelled once
        s = spelled(w, first)
        own, known = _look(self.gram, self.gram_llr, s.gram)
        llr = np.where(known, own, _look(self.history, self.history_llr, s.history)[0])
        of_word = np.bincount(s.word, weights=llr, minlength=len(first))[codes]
        per = np.maximum(w.per_doc, 1)
        return np.stack([np.bincount(w.doc, weights=x, minlength=n) / per for x in (of_word, np.maximum(of_word - EXCESS, 0))], 1)

    def score(self, text: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.differences(text) @ self.slope + self.bias, -30, 30)))


def train(counts: pd.DataFrame) -> Model:
    """The model of distinct grams: columns gram, history, short_gram, short_history (hashes), toxic, ordinary (counts).

    P(symbol | history, class) = (max(count - D, 0) + (D * kinds + MASS) * shared(symbol | short history)) / (total + MASS),
    with the class's counts, kinds of symbols and total after the history; a symbol not counted has only the shared part.
    """
    seen = counts[(counts.toxic + counts.ordinary) > 0]
    if seen.empty:
        return Model()
    # the shared model: continuation counts are numbers of distinct longer grams
    of, kind = pd.factorize(seen.short_gram.to_numpy())
    continued = np.bincount(of).astype(float)
    short = pd.Series(seen.short_history.to_numpy()).groupby(of).first().to_numpy()
    back, _ = pd.factorize(short)
    total, kinds = np.bincount(back, weights=continued), np.bincount(back).astype(float)
    shared = ((np.maximum(continued - DISCOUNT, 0) + DISCOUNT * kinds[back] / ALPHABET) / total[back])[of]
    after, histories = pd.factorize(seen.history.to_numpy())
    logs, left = [], []
    for n in (seen.toxic.to_numpy(float), seen.ordinary.to_numpy(float)):
        total, kinds = np.bincount(after, weights=n), np.bincount(after, weights=n > 0)
        given = DISCOUNT * kinds + MASS
        logs.append(np.log((np.maximum(n - DISCOUNT, 0) + given[after] * shared) / (total + MASS)[after]))
        left.append(np.log(given / (total + MASS)))
    grams = seen.gram.to_numpy()
    a, b = np.argsort(grams), np.argsort(histories)
    return Model(grams[a], (logs[0] - logs[1])[a], histories[b], (left[0] - left[1])[b])


def logistic(rows: DataFrame, share: float, own: float, steps: int = 60) -> tuple[np.ndarray, float]:
    """(slopes, bias) of the weighted fit to (label, mean, excess), by Newton's method with a small ridge on the slopes of the scaled inputs.

    Documents weigh as their class does among all labels: ``share`` of these is toxic, of the rows ``own``.
    """
    scale = np.array([x if x > 0 else 1.0 for x in rows.agg(F.stddev_pop("mean"), F.stddev_pop("excess")).first()])
    ridge = np.array([1e-2, 1e-2, 1e-6])
    w = np.zeros(3)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(12)
        for batch in batches:
            y, *x = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "mean", "excess"))
            a = np.stack([*(v / k for v, k in zip(x, scale, strict=True)), np.ones(len(y))], 1)
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            weight = np.where(y == 1, share / own, (1 - share) / (1 - own))
            total += np.concatenate([a.T @ (weight * (p - y)), ((a * (weight * p * (1 - p))[:, None]).T @ a).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in total], _SUMS)

    for _ in range(steps):
        total = np.array(rows.mapInArrow(sums, ", ".join(f"{c} double" for c in _SUMS)).agg(*[F.sum(c) for c in _SUMS]).first())
        step = np.linalg.solve(total[3:].reshape(3, 3) + np.diag(ridge), total[:3] + ridge * w)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return w[:-1] / scale, float(w[-1])


_SUMS = [f"s{i}" for i in range(12)]
_KEYS = ["gram", "history", "short_gram", "short_history"]
_CELLS = [f"n{p}_{c}" for p in range(PARTS) for c in (1, 0)]
#: Numbers by the models without one part, and by the model of all.
_NUMBERS = [f"l{p}" for p in range(PARTS + 1)]


def words_of(docs: DataFrame, cells: bool = False) -> DataFrame:
    """(word, spelt, n) of all different words: hash, bytes, occurrences; with ``cells`` also the occurrences by part and label."""
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in X.slices(batches, most=COUNT_BYTES):
            w = X.words(lower_ascii(batch.column("text")), X.NON_LETTERS)
            h = X.hash_words(w)
            cell = np.zeros(batch.num_rows, np.int64)
            if cells:
                cell = 2 * batch.column("part").to_numpy() + 1 - batch.column("label").to_numpy()
            codes, _, first = X.distinct(X.mix(h + X.mix(cell[w.doc].astype(np.uint64))) if cells else h)
            size = w.end[first] - w.start[first]
            spelt = X.binary_list(w.data[X.ragged(w.start[first], size)], np.concatenate([[0], np.cumsum(size)]))
            yield pa.RecordBatch.from_arrays([pa.array(h[first].view(np.int64)), spelt, pa.array(cell[w.doc[first]].astype(np.int32)),
                                              pa.array(np.bincount(codes, minlength=len(first)))], ["word", "spelt", "cell", "n"])

    found = docs.select("text", *(["part", "label"] if cells else [])).mapInArrow(tally, "word long, spelt binary, cell int, n long")
    by_cell = [F.sum(F.when(F.col("cell") == i, F.col("n")).otherwise(0)).alias(c) for i, c in enumerate(_CELLS)] if cells else []
    return found.groupBy("word", "spelt").agg(F.sum("n").alias("n"), *by_cell)


def _spell(batch: pa.RecordBatch) -> Spelling:
    """The words of a batch of :func:`words_of`."""
    data, offsets = X.text_bytes(batch.column("spelt"))
    return spelled(X.Words(data, offsets[:-1], offsets[1:], np.arange(batch.num_rows), offsets), np.arange(batch.num_rows))


def trained(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numbers of all grams, and of any other gram after a known history, by all models: (gram, l0, ...), (history, l0, ...)."""
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = _spell(batch)
            codes, _, first = X.distinct(s.gram)
            n = [np.bincount(codes, weights=batch.column(c).to_numpy()[s.word], minlength=len(first)).astype(np.int64) for c in _CELLS]
            yield pa.RecordBatch.from_arrays([*(pa.array(getattr(s, k)[first].view(np.int64)) for k in _KEYS), *(pa.array(x) for x in n)],
                                             [*_KEYS, *_CELLS])

    tallied = words.select("spelt", *_CELLS).mapInArrow(tally, ", ".join(f"{c} long" for c in [*_KEYS, *_CELLS]))
    counts = written(tallied.groupBy(*_KEYS).agg(*[F.sum(c).alias(c) for c in _CELLS]), "grams")
    groups = 1 + counts.count() // GROUP_GRAMS

    def train_group(group: pa.Table) -> pa.Table:
        keys = {k: group.column(k).to_numpy().view(np.uint64) for k in _KEYS}
        n = {c: group.column(c).to_numpy() for c in _CELLS}
        histories = np.unique(keys["history"])
        of_gram, of_history = [], []
        for out in range(PARTS + 1):
            toxic, ordinary = (sum(n[f"n{p}_{c}"] for p in range(PARTS) if p != out) for c in (1, 0))
            model = train(pd.DataFrame(keys | {"toxic": toxic, "ordinary": ordinary}))
            own, known = _look(model.gram, model.gram_llr, keys["gram"])
            of_gram.append(np.where(known, own, _look(model.history, model.history_llr, keys["history"])[0]))
            of_history.append(_look(model.history, model.history_llr, histories)[0])
        key = np.concatenate([keys["gram"], histories]).view(np.int64)
        numbers = {c: np.concatenate(x) for c, x in zip(_NUMBERS, zip(of_gram, of_history, strict=True), strict=True)}
        return pa.table({"is_gram": np.arange(len(key)) < len(keys["gram"]), "key": key} | numbers)

    grouped = counts.withColumn("group", F.pmod("short_history", F.lit(groups))).groupBy("group")
    out = written(grouped.applyInArrow(train_group, "is_gram boolean, key long, " + ", ".join(f"{c} double" for c in _NUMBERS)), "numbers")
    drop(counts)
    return (out.filter("is_gram").select(F.col("key").alias("gram"), *_NUMBERS),
            out.filter("not is_gram").select(F.col("key").alias("history"), *_NUMBERS))


def often(rows: DataFrame, most: int) -> tuple[pd.DataFrame, DataFrame | None]:
    """(``most`` rows at most, of greatest ``n``; the others): no other row has over ``2 / most`` of all."""
    level = F.floor(F.log2("n"))
    total, least = 0, 63
    levels = rows.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()
    for k, count in levels:
        total += count
        if total > most:
            break
        least = k
    else:
        return rows.toPandas(), None
    return rows.filter(level >= least).toPandas(), rows.filter(level < least)


def _sorted(rows: pd.DataFrame, key: str, numbers: list[str]) -> tuple[np.ndarray, np.ndarray]:
    keys = rows[key].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], rows[numbers].to_numpy(float)[order]


def _at(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places in the sorted keys; -1 where missing."""
    return _look(keys, np.arange(1, len(keys) + 1), wanted)[0].astype(np.int64) - 1


def word_numbers(words: DataFrame, grams: DataFrame, histories: DataFrame, numbers: list[str], frequent: int) -> DataFrame:
    """(word, n, numbers) of words (word, spelt, n): log-likelihood differences by the models of ``numbers``."""
    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = _spell(batch)
            codes, _, first = X.distinct(s.gram)
            yield pa.RecordBatch.from_arrays([pa.array(s.gram[first].view(np.int64)), pa.array(s.history[first].view(np.int64)),
                                              pa.array(np.bincount(codes, minlength=len(first)))], ["gram", "history", "n"])

    met = words.select("spelt").mapInArrow(spell, "gram long, history long, n long").groupBy("gram", "history").agg(F.sum("n").alias("n"))
    own, after = (t.select(t.columns[0], *[F.col(c).alias(f"{name}_{c}") for c in numbers]) for t, name in ((grams, "own"), (histories, "after")))
    known = written(met.join(own, "gram", "left").join(after, "history", "left").select(
        "gram", "n", *[F.coalesce(f"own_{c}", f"after_{c}", F.lit(0.0)).alias(c) for c in numbers]), "known")
    hot, rest = often(known, frequent)
    sent = words.sparkSession.sparkContext.broadcast(_sorted(hot, "gram", numbers))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = sent.value
        values = np.vstack([values, np.zeros((1, len(numbers)))])
        for batch in batches:
            s = _spell(batch)
            at = _at(keys, s.gram)
            sums = [np.bincount(s.word, weights=values[at, k], minlength=batch.num_rows) for k in range(len(numbers))]
            cold = np.flatnonzero(at < 0)
            bounds = np.searchsorted(s.word[cold], np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("n"), *(pa.array(x) for x in sums),
                 pa.ListArray.from_arrays(pa.array(bounds), pa.array(s.gram[cold].view(np.int64)))], ["word", "n", *numbers, "cold"])

    fields = ", ".join(f"{c} double" for c in numbers)
    base = written(words.select("word", "spelt", "n").mapInArrow(add, f"word long, n long, {fields}, cold array<long>"), "words")
    if rest is None:
        return base
    more = base.select("word", F.explode("cold").alias("gram")).join(rest.drop("n"), "gram")
    both = base.drop("cold").unionByName(more.select("word", F.lit(0).cast("long").alias("n"), *numbers))
    out = written(both.groupBy("word").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in numbers]), "words")
    drop(base, known)
    return out


def measured(docs: DataFrame, words: DataFrame, numbers: list[str], kept: list[str], frequent: int, part: str | None = None) -> DataFrame:
    """``docs``'s columns ``kept`` with a struct ``_m`` (or a fresh name, the last column) of the two differences, ``mean`` and ``excess``.

    ``part`` names the column with the place in ``numbers`` of the model to use (without: the first).
    """
    hot, rest = often(words.select("word", "n", *numbers), frequent)
    sent = docs.sparkSession.sparkContext.broadcast(_sorted(hot, "word", numbers))
    name = fresh("_m", kept)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = sent.value
        values = np.vstack([values, np.zeros((1, len(numbers)))])
        for batch in X.slices(batches):
            n = batch.num_rows
            w = X.words(lower_ascii(batch.column("text")), X.NON_LETTERS)
            own = batch.column("part").to_numpy()[w.doc]
            codes, different, _ = X.distinct(X.hash_words(w))
            at = _at(keys, different)
            number = values[at[codes], own]
            sums = [np.bincount(w.doc, weights=x, minlength=n) for x in (number, np.maximum(number - EXCESS, 0))]
            cold = np.flatnonzero(at[codes] < 0)
            bounds = np.searchsorted(w.doc[cold], np.arange(n + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("part"), pa.array(w.per_doc.astype(np.int64)), *(pa.array(x) for x in sums),
                 pa.ListArray.from_arrays(pa.array(bounds), pa.array(different[codes[cold]].view(np.int64)))],
                ["row", "part", "n_words", "mean", "excess", "cold"])

    row = F.struct(*[F.col(f"`{c}`") for c in kept]) if kept else F.struct(F.lit(1).alias("_"))
    rows = docs.select(row.alias("row"), (F.col(part) if part else F.lit(0)).cast("int").alias("part"), F.col("text"))
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("part", T.IntegerType()),
                           T.StructField("n_words", T.LongType()), T.StructField("mean", T.DoubleType()),
                           T.StructField("excess", T.DoubleType()), T.StructField("cold", T.ArrayType(T.LongType()))])
    base = rows.mapInArrow(add, schema)
    if rest is None:
        sums = base
    else:
        base = written(base.withColumn("uid", F.monotonically_increasing_id()), "measured")
        number = F.element_at(F.array(*numbers), F.col("part") + 1)
        more = base.select("uid", "part", F.explode("cold").alias("word")).join(rest, "word").groupBy("uid").agg(
            F.sum(number).alias("more"), F.sum(F.greatest(number - EXCESS, F.lit(0.0))).alias("further"))
        sums = base.join(more, "uid", "left").withColumn("mean", F.col("mean") + F.coalesce("more", F.lit(0.0))).withColumn(
            "excess", F.col("excess") + F.coalesce("further", F.lit(0.0)))
    per = F.greatest("n_words", F.lit(1))
    return sums.select(*[F.col(f"row.`{c}`") for c in kept], F.struct((F.col("mean") / per).alias("mean"), (F.col("excess") / per).alias("excess")).alias(name))


@dataclass
class Fitted:
    """Numbers of grams and histories by the model of all labelled documents, and the logistic map; no tables: nothing was learned."""

    grams: DataFrame | None = None
    histories: DataFrame | None = None
    slope: np.ndarray = field(default_factory=lambda: np.zeros(2))
    bias: float = 0.0


def fit(docs: DataFrame, labels: DataFrame, frequent: int = FREQUENT) -> Fitted:
    """Counts and calibration from all labelled documents outside the held-out fold."""
    y = one_label(labels, "toxic").filter(~held_out("doc_id", FOLDS, HELD_OUT))
    n1, n = y.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count("label")).first()
    if not 0 < n1 < n:
        return Fitted()
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(PARTS)).cast("int")
    texts = written(labelled(docs, labels, "toxic", FOLDS, HELD_OUT).select("text", F.col("label").cast("int").alias("label"), part.alias("part")),
                    "labelled")
    own = texts.agg(F.avg("label")).first()[0]
    if own is None or not 0 < own < 1:
        return Fitted()
    words = written(words_of(texts, cells=True), "counted")
    grams, histories = trained(words)
    numbers = word_numbers(words, grams, histories, _NUMBERS[:PARTS], frequent)
    m = measured(texts, numbers, _NUMBERS[:PARTS], ["label"], frequent, "part")
    compared = written(m.select("label", "_m.*"), "compared")
    drop(texts, words, numbers)
    slope, bias = logistic(compared, n1 / n, own)
    drop(compared)
    return Fitted(grams, histories, slope, bias)


def score(docs: DataFrame, model: Fitted, kept: list[str] | None = None, frequent: int = FREQUENT) -> DataFrame:
    """``docs`` (its columns ``kept``, or all) with a column ``score``; replaces nothing, its name must be free."""
    kept = docs.columns if kept is None else kept
    if model.grams is None:
        return docs.select(*[F.col(f"`{c}`") for c in kept], F.lit(0.5).alias("score"))
    words = written(words_of(docs), "counted")
    numbers = word_numbers(words, model.grams, model.histories, _NUMBERS[PARTS:], frequent)
    out = measured(docs, numbers, _NUMBERS[PARTS:], kept, frequent)
    drop(words)
    m = out.columns[-1]
    x = sum((F.col(f"{m}.{c}") * float(k) for c, k in zip(("mean", "excess"), model.slope, strict=True)), F.lit(model.bias))
    x = F.least(F.greatest(x, F.lit(-30.0)), F.lit(30.0))
    return out.select(*[F.col(f"`{c}`") for c in kept], (1 / (1 + F.exp(-x))).alias("score"))


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")), ["doc_id"])
    return scored.select("doc_id", held_out("doc_id", FOLDS, HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
