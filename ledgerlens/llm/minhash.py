"""Near-duplicate classes: improved consistent weighted sampling over TF-IDF word shingles.

1. One pass counts the document frequency of every ``SHINGLE``-word shingle of every document
   into a count-min sketch of a fixed size.  A shingle's weight is its count in the text times
   an idf that falls from 1 + ``IDF_SPAN`` for shingles in less than ``RARE`` of all documents to
   1 for those in all.  (The span is small on purpose: under a steep idf a large group of near
   copies would make its own shared shingles worthless, and its members dissimilar.)
2. One pass signs every text with ``ROWS * BANDS`` improved consistent weighted samples; two
   texts agree in a sample with a probability equal to their weighted Jaccard similarity.
   Equal texts (by digest) then count as one.
3. Texts that agree in all samples of a band share a bucket.  A bucket's members are compared
   with its leader, the member that shares most buckets with others (in a group of variants
   that is the text they vary), so a bucket of n texts that are alike gives n - 1 pairs, not
   n * n.  The members of buckets with more than one class then left are compared by an exact prefix
   join: the shingles of a text are put in order, those of fewest of these texts first.  Two texts
   of weights A and B with a similarity of t share a weight of t / (1 + t) * (A + B), all of it from
   their first common shingle on, so neither has less from there on.  That shingle lies in the first
   1 - t of a text's weight, and where both are of one weight in the first ninth (t = 0.8); texts
   with more of their own than that never meet over a template they have in common.
   Those that do meet in a shingle are compared in rounds: ``LEADERS`` of its members (times as many in each
   round) with all members of other classes, and leave, until what is left is of one class.  So
   no two texts of a bucket with a similarity of ``SIMILAR`` are missed.
4. Every pair is verified by the exact weighted Jaccard similarity of the whole texts, at
   ``SIMILAR``.
5. Connected texts form a class, named by the least document id in it (label propagation with
   pointer jumping; each round is written to the shared folder).

Words are runs of letters and digits in lower case; a text of fewer words than a shingle is
one shingle.  Defined results: a null text or one without a word is alike only to equal ones
(null counts as empty); repeated rows are copies; a class without any document id has the class
id null.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import text as X
from ledgerlens.llm.corpus import drop, fresh, table, written

SHINGLE = 5
SIMILAR = 0.8
ROWS, BANDS = 4, 12
SAMPLES = ROWS * BANDS
IDF_SPAN = 0.25
RARE = 1 / 256
SKETCH_ROWS, SKETCH_BITS = 2, 20
CHUNK = 1 << 13
SLOT_BITS = 14
SEED = 20_011
#: Rows of a list of digests and ids (some 50 bytes each) that may be broadcast.
BROADCAST_ROWS = 100_000
#: Share of a text's weight by which prefixes are longer than needed, so that rounding never shortens one.
MARGIN = 1e-9
#: Leaders of an undecided shingle in the first round, and how many times as many in each later one.
LEADERS = 8


def _shingles(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(row, shingle, count) of the distinct shingles of every row, by row; and the number of rows."""
    w = X.words(pc.utf8_lower(text), X.NON_ALNUM)
    n = len(w.offsets) - 1
    h = X.hash_words(w)
    grams, at = X.window_hashes(h, w.doc, SHINGLE)
    row = w.doc[at]
    per = w.per_doc
    few = np.flatnonzero((per > 0) & (per < SHINGLE))
    if len(few):  # a short text is one shingle
        first = np.cumsum(per) - per
        whole = np.zeros(len(few), np.uint64)
        for k in range(SHINGLE - 1):
            has = per[few] > k
            whole[has] = X.mix(whole[has] * X._BASE + h[first[few[has]] + k])
        grams, row = np.concatenate([grams, whole]), np.concatenate([row, few])
    codes, _, lead = X.distinct(X.mix(grams + X.mix(row.astype(np.uint64) + X.U64(1))))
    count = np.bincount(codes, minlength=len(lead))
    order = np.argsort(row[lead], kind="stable")
    lead, count = lead[order], count[order]
    return row[lead], grams[lead], count, n


def _cells(shingle: np.ndarray, k: int) -> np.ndarray:
    return (X.mix(shingle + X.U64(0x1000 + k)) >> X.U64(64 - SKETCH_BITS)).astype(np.int64)


def sketch(docs: DataFrame) -> tuple[np.ndarray, int]:
    """(count-min sketch of document frequencies, number of documents with a word).

    Every task sends its own sketch in compressed chunks; chunks are added up as they stream by.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, seen = np.zeros((SKETCH_ROWS, 1 << SKETCH_BITS), np.int32), 0
        for part in X.slices(batches):
            row, shingle, _, _ = _shingles(part.column("text"))
            seen += len(np.unique(row))
            for k in range(SKETCH_ROWS):
                cells[k] += np.bincount(_cells(shingle, k), minlength=1 << SKETCH_BITS).astype(np.int32)
        if seen:
            chunks = cells.reshape(-1, CHUNK)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(-1, len(chunks)), pa.int32()),
                 pa.array([zlib.compress(np.int64(seen).tobytes()), *(zlib.compress(c.astype(np.int64).tobytes(), 1) for c in chunks)], pa.binary())],
                ["chunk", "cells"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, cells in zip(batch.column("chunk").to_pylist(), batch.column("cells").to_pylist(), strict=True):
                x = np.frombuffer(zlib.decompress(cells), np.int64)
                sums[chunk] = sums[chunk] + x if chunk in sums else x
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())],
                                             ["chunk", "cells"])

    made = docs.select("text").mapInArrow(count, "chunk int, cells binary")
    rows = made.repartition("chunk").mapInArrow(add, "chunk int, cells binary").collect()
    by = {r.chunk: np.frombuffer(bytes(r.cells), np.int64) for r in rows}
    if not by:
        return np.zeros((SKETCH_ROWS, 1 << SKETCH_BITS), np.int64), 0
    chunks = (SKETCH_ROWS << SKETCH_BITS) // CHUNK
    return np.concatenate([by[k] for k in range(chunks)]).reshape(SKETCH_ROWS, -1), int(by[-1][0])


def idf_codes(cells: np.ndarray, documents: int) -> np.ndarray:
    """The idf of every cell as a byte: 255 parts of ``IDF_SPAN`` over 1."""
    share = np.clip(cells / max(documents, 1), RARE, 1)
    return np.round(255 * np.log(1 / share) / np.log(1 / RARE)).astype(np.uint8)


def _weights(shingle: np.ndarray, count: np.ndarray, codes: np.ndarray) -> np.ndarray:
    # the least frequency of a shingle's cells is the largest idf
    top = np.max([codes[k][_cells(shingle, k)] for k in range(SKETCH_ROWS)], axis=0) if len(shingle) else np.zeros(0)
    return (count * (1 + IDF_SPAN / 255 * top)).astype(np.float64)


@cache
def _draws() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gamma(2, 1) r, uniform beta and ln of Gamma(2, 1) c, by sample and slot of the shingle's hash."""
    rng = np.random.default_rng(SEED)
    shape = (SAMPLES, 1 << SLOT_BITS)
    gamma = lambda: -np.log((1 - rng.random(shape)) * (1 - rng.random(shape)))
    return gamma().astype(np.float32), rng.random(shape).astype(np.float32), np.log(gamma()).astype(np.float32)


def _signatures(row: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows with a shingle, their samples as 32-bit numbers)."""
    if not len(row):
        return np.zeros(0, np.int64), np.zeros((0, SAMPLES), np.uint32)
    starts = np.flatnonzero(np.diff(row, prepend=-1))
    sizes = np.diff(np.append(starts, len(row)))
    r, beta, log_c = _draws()
    log_w = np.log(weight).astype(np.float32)
    out = np.zeros((len(starts), SAMPLES), np.uint32)
    owner = np.repeat(np.arange(len(starts)), sizes)
    for k in range(SAMPLES):
        slot = ((shingle * X.U64(2 * k + 0x9E3779B97F4A7C15)) >> X.U64(64 - SLOT_BITS)).astype(np.int32)
        rk = r[k][slot]
        bk = beta[k][slot]
        t = np.floor(log_w / rk + bk)
        score = log_c[k][slot] - rk * (t - bk + 1)
        least = np.minimum.reduceat(score, starts)
        hit = np.flatnonzero(score == np.repeat(least, sizes))
        # shingles of one slot tie; the least name wins, in every text alike
        name = X.mix(shingle[hit] + X.mix(t[hit].astype(np.int64).astype(np.uint64) + X.U64(k)))
        first = np.flatnonzero(np.diff(owner[hit], prepend=-1))
        out[:, k] = (np.minimum.reduceat(name, first) >> X.U64(32)).astype(np.uint32)
    return row[starts], out


def signed(docs: DataFrame, codes: np.ndarray) -> DataFrame:
    """(doc_id, key, sig): digest of every row's text, and its packed samples (null without a word)."""
    shared = docs.sparkSession.sparkContext.broadcast(codes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in X.slices(batches):
            row, shingle, count, n = _shingles(part.column("text"))
            rows, sig = _signatures(row, shingle, _weights(shingle, count, shared.value), n)
            packed: list[bytes | None] = [None] * n
            for i, s in zip(rows.tolist(), sig, strict=True):
                packed[i] = s.tobytes()
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("key"), pa.array(packed, pa.binary())], ["doc_id", "key", "sig"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", digest("text").alias("key"), "text").mapInArrow(run, f"doc_id {kind}, key binary, sig binary")


def digest(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def _band(k: int) -> Column:
    return F.substring("sig", 4 * ROWS * k + 1, 4 * ROWS)


def stars(buckets: DataFrame) -> DataFrame:
    """(bucket, key, leader) of all members of buckets of two and more but the leaders themselves."""
    sizes = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = buckets.join(sizes, "bucket")
    central = shared.groupBy("key").agg(F.sum("n").alias("mates"))
    ranked = shared.select("bucket", "key").join(central, "key")
    leaders = ranked.groupBy("bucket").agg(F.max(F.struct("mates", "key")).alias("top")).select("bucket", F.col("top.key").alias("leader"))
    return shared.select("bucket", "key").join(leaders, "bucket").filter("key <> leader")


def undecided(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``members`` (bucket, key, ...) in buckets of more than one class, with ``label``; without a label, a text is its own."""
    rest = [c for c in members.columns if c not in ("bucket", "key", "label", "leads")]
    named = labels.select("key", "label")
    own = members.select("bucket", "key", *rest).join(named, "key", "left").select("bucket", "key", *rest, F.coalesce("label", "key").alias("label"))
    mixed = own.groupBy("bucket").agg(F.min("label").alias("least"), F.max("label").alias("most")).filter("least <> most").select("bucket")
    return own.join(mixed, "bucket", "left_semi")


def order_codes(cells: np.ndarray) -> np.ndarray:
    """The frequency of every cell as a byte: an eighth of a power of two a step."""
    return np.minimum(np.round(8 * np.log2(np.maximum(cells, 1))), 255).astype(np.uint8)


def prefixes(texts: DataFrame, codes: np.ndarray, order: np.ndarray) -> DataFrame:
    """(bucket, key, size, rest): the shingles (``bucket``) of each text's prefix, the text's weight, and its weight from that shingle on."""
    shared = texts.sparkSession.sparkContext.broadcast((codes, order))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, order = shared.value
        for part in X.slices(batches):
            row, shingle, count, n = _shingles(part.column("text"))
            weight = _weights(shingle, count, codes)
            rare = np.min([order[k][_cells(shingle, k)] for k in range(SKETCH_ROWS)], axis=0) if len(shingle) else np.zeros(0)
            at = np.lexsort((shingle, rare, row))
            row, shingle, weight = row[at], shingle[at], weight[at]
            size = np.bincount(row, weights=weight, minlength=n)
            start = np.concatenate([[0], np.cumsum(weight)])[:-1]
            rest = size[row] - (start - start[np.searchsorted(row, np.arange(n))[row]]) if len(row) else start
            keep = np.flatnonzero(rest >= (SIMILAR - MARGIN) * size[row])
            yield pa.RecordBatch.from_arrays(
                [pa.array(shingle[keep].view(np.int64)), part.column("key").take(pa.array(row[keep])), pa.array(size[row[keep]]), pa.array(rest[keep])],
                ["bucket", "key", "size", "rest"])

    return texts.select("key", "text").mapInArrow(run, "bucket long, key binary, size double, rest double")


def led(members: DataFrame, leaders: int) -> DataFrame:
    """``members`` with ``leads``: about ``leaders`` of a bucket lead, at least one, in buckets of no more all.

    Leaders are picked by a hash, so no bucket is sorted or counted off in one task.
    """
    picked = members.withColumn("h", F.xxhash64("bucket", "key"))
    sizes = picked.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.max("h").alias("top"))
    share = F.pmod("h", F.lit(1 << 31)) / F.lit(1 << 31)
    leads = (F.col("h") == F.col("top")) | (share * F.col("n") < leaders)
    return picked.join(sizes, "bucket").select(*members.columns, leads.alias("leads"))


def crossed(members: DataFrame) -> DataFrame:
    """Distinct (key, leader), key < leader, of each shingle's leaders and its members of other classes that may be similar.

    What two texts have in common from their first common shingle on is all they have in common; it is not
    more than either text's weight from there on, and must be t / (1 + t) of both weights for a similarity of t.
    """
    of = members.filter("leads").select("bucket", F.col("key").alias("leader"), F.col("label").alias("theirs"),
                                        F.col("size").alias("leader_size"), F.col("rest").alias("leader_rest"))
    enough = F.lit((SIMILAR / (1 + SIMILAR)) * (1 - MARGIN)) * (F.col("size") + F.col("leader_size"))
    met = members.join(of, (members["bucket"] == of["bucket"]) & (F.col("label") != F.col("theirs")) & (~F.col("leads") | (F.col("key") < F.col("leader")))
                       & (F.least("rest", "leader_rest") >= enough))
    return ordered(met)


def ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("key", "leader").alias("key"), F.greatest("key", "leader").alias("leader")).distinct()


def verified(pairs: DataFrame, texts: DataFrame, codes: np.ndarray) -> DataFrame:
    """(key, leader) of the distinct ``pairs`` whose whole texts are similar."""
    shared = pairs.sparkSession.sparkContext.broadcast(codes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in X.slices(batches, "text", "other"):
            like = _similar(part.column("text"), part.column("leader").dictionary_encode(), part.column("other"), shared.value)
            yield part.select(["key", "leader"]).filter(pa.array(like >= SIMILAR))

    mine = texts.select("key", "text")
    theirs = texts.select(F.col("key").alias("leader"), F.col("text").alias("other"))
    return pairs.join(mine, "key").join(theirs, "leader").select("key", "leader", "text", "other").mapInArrow(
        run, "key binary, leader binary")


def _similar(text: pa.Array, leader: pa.DictionaryArray, other: pa.Array, codes: np.ndarray) -> np.ndarray:
    """Weighted Jaccard similarity of each row's two texts; a leader's repeated text is read once."""
    row, shingle, count, n = _shingles(text)
    weight = _weights(shingle, count, codes)
    which = leader.indices.to_numpy()
    first = np.unique(which, return_index=True)[1]
    orow, oshingle, ocount, _ = _shingles(other.take(pa.array(first)))
    oweight = _weights(oshingle, ocount, codes)
    sizes = np.bincount(orow, minlength=len(first))
    starts = np.cumsum(sizes) - sizes
    at = X.ragged(starts[which], sizes[which])
    owner = np.repeat(np.arange(n), sizes[which])
    name = lambda s, r: X.mix(s + X.mix(r.astype(np.uint64) + X.U64(1)))
    mine, theirs = name(shingle, row), name(oshingle[at], owner)
    order = np.argsort(mine)
    mine, weight, row = mine[order], weight[order], row[order]
    place = np.minimum(np.searchsorted(mine, theirs), max(len(mine) - 1, 0))
    both = mine[place] == theirs if len(mine) else np.zeros(len(theirs), bool)
    common = np.bincount(owner[both], weights=np.minimum(weight[place[both]], oweight[at[both]]), minlength=n)
    union = np.bincount(row, weights=weight, minlength=n) + np.bincount(owner, weights=oweight[at], minlength=n) - common
    return np.where(union > 0, common / np.maximum(union, 1e-9), 0)


def components(edges: DataFrame) -> DataFrame:
    """(key, label) of every node of the edges (key, leader): the least key of its component.

    Each round takes the least label of the neighbours and then the label of that label, so
    rounds grow with the logarithm of a component's width; one number a round reaches the driver.
    """
    way = lambda a, b: F.struct(F.col(a).alias("key"), F.col(b).alias("near"))
    both = written(edges.select(F.inline(F.array(way("key", "leader"), way("leader", "key")))).distinct(), "edges")
    current = written(both.groupBy("key").agg(F.least("key", F.min("near")).alias("label")), "labels")
    while True:
        labels = current.select("key", "label")
        near = both.join(labels.select(F.col("key").alias("near"), F.col("label").alias("theirs")), "near").groupBy("key").agg(
            F.min("theirs").alias("theirs"))
        closer = labels.join(near, "key").select("key", F.col("label").alias("old"), F.least("label", "theirs").alias("label"))
        jump = labels.select(F.col("key").alias("label"), F.col("label").alias("beyond"))
        after = written(closer.join(jump, "label").select("key", "old", F.least("label", "beyond").alias("label")), "labels")
        drop(current)
        current = after
        if not after.filter("old <> label").limit(1).count():
            drop(both)
            return after


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (key, label) after more ``links`` (key, leader); a text without a label is a class of its own.

    Only classes that the links connect are followed; a label is the least key of its class, so the least label of
    connected classes is theirs.
    """
    named = labels.select("key", "label")
    mine = links.join(named, "key", "left").select(F.coalesce("label", "key").alias("one"), "leader")
    theirs = named.select(F.col("key").alias("leader"), "label")
    between = mine.join(theirs, "leader", "left").select(F.col("one").alias("key"), F.coalesce("label", "leader").alias("leader"))
    over = components(between.filter("key <> leader").distinct())
    moved = over.select(F.col("key").alias("label"), F.col("label").alias("now"))
    known = named.join(moved, "label", "left").select("key", F.coalesce("now", "label").alias("label"))
    out = written(known.union(over.join(named, "key", "left_anti").select("key", "label")), "labels")
    drop(over)
    return out


def classes(docs: DataFrame) -> DataFrame:
    """(key, doc_id, label, class_id) of every row of ``docs``: digest of its text, least digest and least id of its class."""
    codes = idf_codes(*sketch(docs))
    rows = written(signed(docs.select("doc_id", "text"), codes), "signed")
    texts = written(rows.groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig")), "distinct")
    wave = [F.xxhash64(F.lit(k), _band(k)) for k in range(BANDS)]
    buckets = written(texts.filter("sig is not null").select("key", F.explode(F.array(*wave)).alias("bucket")), "buckets")
    pairs = written(stars(buckets), "stars")
    drop(buckets)
    first = written(pairs.select("key", "leader").distinct(), "pairs")
    needed = _texts(docs, texts, first.select("key").union(first.select("leader")))
    edges = written(verified(first, needed, codes), "links")
    drop(needed)
    labels = components(edges)
    drop(edges)
    members = written(undecided(pairs.select("bucket", "key"), labels).select("key").distinct(), "members")
    drop(pairs)
    if members.limit(1).count():
        whole = _texts(docs, texts, members)
        order = order_codes(sketch(whole)[0])
        cells = written(prefixes(whole, codes, order), "prefixes")
        left = written(undecided(cells, labels), "left")
        drop(cells)
        tried, leaders = written(ordered(first), "tried"), LEADERS
        while left.limit(1).count():
            marked = written(led(left, leaders), "marked")
            again = written(crossed(marked).join(tried, ["key", "leader"], "left_anti"), "pairs")
            more = written(verified(again, whole, codes), "links")
            if more.limit(1).count():
                older, labels = labels, merged(labels, more)
                drop(older)
            rest = written(undecided(marked.filter("not leads"), labels), "left")
            both = written(tried.union(again), "tried")
            drop(left, marked, again, more, tried)
            left, tried, leaders = rest, both, leaders * LEADERS
        drop(whole, left, tried)
    drop(first, members)
    named = texts.select("key", "rep").join(labels.select("key", "label"), "key", "left")
    named = named.select("key", "rep", F.coalesce("label", "key").alias("label"))
    ids = named.groupBy("label").agg(F.min("rep").alias("class_id"))
    by_key = named.join(ids, "label").select("key", "label", "class_id")
    return rows.select("doc_id", "key").join(by_key, "key")


def _texts(docs: DataFrame, texts: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, text) of the digests in ``keys``, written."""
    needed = written(texts.join(keys.distinct(), "key").select(F.col("key").alias("of"), "rep"), "needed")
    # a short list goes to the texts, else the texts are shuffled to meet it
    needed = F.broadcast(needed) if needed.count() <= BROADCAST_ROWS else needed
    # the one row of each text's least id; ids spread a hot text's copies over the tasks
    rows = docs.select("doc_id", digest("text").alias("key"), "text")
    own = rows.join(needed, (F.col("key") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("rep")), "left_semi")
    return written(own.dropDuplicates(["key"]).select("key", "text"), "texts")


def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "class_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one row of every class, that of the least id, with the columns it came with."""
    keep = classes(docs.select("doc_id", "text")).filter(F.col("doc_id").eqNullSafe(F.col("class_id")))
    name, of, rep = (fresh(n, docs.columns) for n in ("_key", "_of", "_rep"))
    keep = keep.groupBy("label", "class_id").agg(F.min("key").alias("key")).select(F.col("key").alias(of), F.col("class_id").alias(rep))
    kept = docs.withColumn(name, digest("text")).join(
        keep, (F.col(name) == F.col(of)) & F.col("doc_id").eqNullSafe(F.col(rep)), "left_semi")
    return kept.dropDuplicates([name, "doc_id"]).drop(name)
