"""Stupid-backoff language-model scores of documents, computed relationally.

The model is the corpus itself: counts of all words and of all word pairs of all documents.
A word w after v scores

    count(v w) / count(v)             where the pair occurs ``SEEN`` times or more,
    BACKOFF * count(w) / N            elsewhere,

with N words in all.  A document's first word follows a mark that every document begins with.  All counts are exact.

Counts are joined to the n-grams where these meet by hash.  Every document's pairs are exploded into buckets, one
packed row for a bucket and a slice of texts, so a bucket's group holds both a count table and all occurrences that
need it.  There the occurrences are counted, joined with the counts, and summed per document; the partial sums of the
buckets are then summed.  The number of buckets follows the corpus's size (``BUCKET_PAIRS`` occurrences each), tasks
follow the buckets, and occurrences of one pair in one document travel once, with their number.

Words with at least a 1 / ``FREQUENT`` share of all (by the pigeonhole principle ``FREQUENT`` at most) are known to every
worker.  A pair of two such words goes to the bucket of the pair's hash.  A pair with a rarer word goes to the
bucket of that word, which so holds every occurrence of the word and with that its exact count; a pair of two rare
words goes to both, and each adds the part of the score that its word's count makes.  Hot pairs do not travel at all:
those over a 1 / ``FREQUENT`` share of some stretch of texts, added up, are again at most ``FREQUENT`` (and both their words are
known everywhere); they are counted exactly in a pass of their own and scored where they occur.  So ``FREQUENT`` bounds what
is sent to every worker and changes no result.

Defined results: a null, empty or wordless text has 0 words and a null score; every repeated
row is scored and counted by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import text as X
from ledgerlens.llm.corpus import table, written

BACKOFF = 0.4
SEEN = 2
FREQUENT = 1 << 20
BUCKET_PAIRS = 1 << 22
START = X.mix(np.array([0xB0], np.uint64))[0]


def _ngrams(text: pa.Array) -> tuple[X.Words, np.ndarray, np.ndarray, np.ndarray]:
    """(words, their hashes, hashes of the words before, hashes of the pairs)."""
    w = X.words(text)
    h = X.hash_words(w)
    before = np.where(np.diff(w.doc, prepend=-1) != 0, START, np.roll(h, 1))
    return w, h, before, X.mix(before * X._BASE + h)


def _tally(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes, values, _ = X.distinct(h)
    return values, np.bincount(codes, minlength=len(values))


def _merged(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    codes, keys, _ = X.distinct(np.concatenate([a[0], b[0]]))
    return keys, np.bincount(codes, weights=np.concatenate([a[1], b[1]]), minlength=len(keys)).astype(np.int64)


_NONE = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
WORD, PAIR = 0, 1
#: Words of a stretch of texts, whose frequent pairs are looked for.
STRETCH = 1 << 21


def counts(docs: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """(kind, key, n): exact counts of all words, and for pairs the counts of the stretches where they are frequent."""
    def rows(kind: int, table: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(table[0]), kind, np.int32)), pa.array(table[0].view(np.int64)), pa.array(table[1])],
                                          ["kind", "key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs, begun, size = _NONE, _NONE, 0, 0
        for part in X.slices(batches):
            w, h, _, pair = _ngrams(part.column("text"))
            begun += int((w.per_doc > 0).sum())
            words, pairs, size = _merged(words, _tally(h)), _merged(pairs, _tally(pair)), size + len(h)
            if size >= STRETCH:
                yield rows(WORD, words)
                yield rows(PAIR, _frequent(pairs, size, frequent))
                words, pairs, size = _NONE, _NONE, 0
        yield rows(WORD, _merged(words, (np.array([START]), np.array([begun]))))
        yield rows(PAIR, _frequent(pairs, size, frequent))

    return written(docs.select("text").mapInArrow(run, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")


def _frequent(table: tuple[np.ndarray, np.ndarray], size: int, frequent: int) -> tuple[np.ndarray, np.ndarray]:
    keep = table[1] > max(SEEN, size / frequent)
    return table[0][keep], table[1][keep]


def hot_pairs(docs: DataFrame, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted keys, exact counts) of the given pairs."""
    wanted = docs.sparkSession.sparkContext.broadcast(np.sort(keys))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(wanted.value), np.int64)
        for part in X.slices(batches):
            pair = _ngrams(part.column("text"))[3]
            at = _find(wanted.value, pair)
            n += np.bincount(at[at >= 0], minlength=len(n))
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(n[some])], ["at", "n"])

    found = docs.select("text").mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    n = np.zeros(len(keys), np.int64)
    n[found["at"].to_numpy()] = found["n"].to_numpy()
    return wanted.value, n


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places in the sorted keys; -1 where missing."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def _packed(keys: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bytes of every key, as rows."""
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]


def _unpacked(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.view("<u8").ravel()


#: Bytes of a hash that travel; the bucket adds bits of its own.
KEY_BYTES = 6
#: In a packed row of a rare word: the place of the other word in the table of frequent ones (``RARE`` without one), and the
#: high bit set where the rare word is the one before.
RARE = (1 << 31) - 1


_PACKED = "bucket int, first long, rows binary, sizes binary, keys binary, more binary, times binary, words binary"


def scores(docs: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """(doc_id, n_words, n_seen, log_score, mean_score) of every row: sums and mean of natural logarithms."""
    table_ = counts(docs, frequent)
    mark = int(START.view(np.int64))
    is_mark = (F.col("kind") == WORD) & (F.col("key") == mark)
    total = table_.filter((F.col("kind") == WORD) & ~is_mark).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # ``frequent`` words and pairs, and the mark, at most
    often = F.col("n") >= max(total / frequent, 1)
    top = table_.filter(is_mark | often & ((F.col("kind") == WORD) | (F.col("n") > SEEN))).toPandas()
    words = top[top.kind == WORD]
    keys, n = words.key.to_numpy().view(np.uint64), words.n.to_numpy()
    order = np.argsort(keys)
    hot, hot_n = hot_pairs(docs, top[top.kind == PAIR].key.to_numpy().view(np.uint64)) if total else _NONE
    model = docs.sparkSession.sparkContext.broadcast((keys[order], np.log(np.maximum(n[order], 1)), hot, np.log(np.maximum(hot_n, 1))))
    log_n = float(np.log(max(total, 1)))
    buckets = max(16, -(-int(total) // BUCKET_PAIRS))

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in X.slices(batches):
            yield _explode(part, *model.value, log_n, buckets)

    def count(group: pa.Table) -> pa.Table:
        return _count(group, model.value[1], log_n)

    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("uid"), "text")
    # as many tasks as buckets: of pairs, of documents, and twice as many of rare words, whose pairs may come twice
    packed = rows.mapInArrow(explode, _PACKED).repartition(4 * buckets, "bucket")
    parts = packed.groupBy("bucket").applyInArrow(count, "uid long, doc_id long, n_words long, n_seen long, log_score double")
    sums = parts.groupBy("uid").agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.sum("n_seen").alias("n_seen"),
                                    F.sum("log_score").alias("log_score"))
    some = F.col("n_words") > 0
    return sums.select("doc_id", "n_words", "n_seen", F.when(some, F.col("log_score")).alias("log_score"),
                       F.when(some, F.col("log_score") / F.col("n_words")).alias("mean_score"))


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return (((h >> X.U64(32)) * X.U64(buckets)) >> X.U64(32)).astype(np.int64)


def _explode(part: pa.RecordBatch, keys: np.ndarray, logs: np.ndarray, hot: np.ndarray, hot_logs: np.ndarray, log_n: float,
             buckets: int) -> pa.RecordBatch:
    """Packed rows of a slice of texts: one for each bucket that its pairs fall into, and one of the documents themselves."""
    n = part.num_rows
    w, h, before, pair = _ngrams(part.column("text"))
    at_w, at_v = _find(keys, h), _find(keys, before)
    known = (at_w >= 0) & (at_v >= 0)
    # of pairs of two frequent words: what they score unseen, and what a seen pair adds, but for its own log count
    unseen = np.where(known, np.log(BACKOFF) + logs[at_w] - log_n, 0.0)
    more = np.where(known, -logs[at_v] - unseen, 0.0)
    base = np.bincount(w.doc, weights=unseen, minlength=n)
    at = _find(hot, pair)
    is_hot = at >= 0
    if is_hot.any():
        base += np.bincount(w.doc[is_hot], weights=(more + hot_logs[at])[is_hot], minlength=n)
    hits = np.bincount(w.doc[is_hot], minlength=n)
    cold = np.flatnonzero(~is_hot)
    codes, _, lead = X.distinct(X.mix(pair[cold] + X.mix(w.doc[cold].astype(np.uint64) + X.U64(1))))
    times = np.bincount(codes, minlength=len(lead))
    lead = cold[lead]
    first = part.column("uid")[0].as_py()
    out: list[tuple] = []

    def pack(some: np.ndarray, bucket: np.ndarray, payload: np.ndarray, word: np.ndarray | None = None) -> None:
        order = np.lexsort((w.doc[lead[some]], bucket))
        some, bucket, payload = some[order], bucket[order], payload[order]
        doc, key, often = w.doc[lead[some]], _packed(pair[lead[some]], KEY_BYTES), times[some]
        word = None if word is None else _packed(word[order], KEY_BYTES)
        edge = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
        for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            own, sizes = np.unique(doc[lo:hi], return_counts=True)
            many = np.flatnonzero(often[lo:hi] > 1)
            out.append((int(bucket[lo]), own.astype("<u4").tobytes(), sizes.astype("<u4").tobytes(), key[lo:hi].tobytes(), payload[lo:hi].tobytes(),
                        np.stack([many, often[lo:hi][many]], 1).astype("<u4").tobytes(), None if word is None else word[lo:hi].tobytes()))

    both = np.flatnonzero(known[lead])
    pack(both, _bucket(pair[lead[both]], buckets), more[lead[both]].astype("<f8"))
    rare_w, rare_v = np.flatnonzero(at_w[lead] < 0), np.flatnonzero(at_v[lead] < 0)
    word = np.concatenate([h[lead[rare_w]], before[lead[rare_v]]])
    other = np.concatenate([at_v[lead[rare_w]], at_w[lead[rare_v]]])
    payload = np.where(other < 0, RARE, other) + (np.repeat([0, 1], [len(rare_w), len(rare_v)]) << 31)
    pack(np.concatenate([rare_w, rare_v]), 2 * buckets + _bucket(word, 2 * buckets), payload.astype("<u4"), word)

    ids = part.column("doc_id")
    given = np.stack([pc.fill_null(ids, 0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)], 1).astype("<i8")
    # beyond the buckets of pairs: the documents, with what needs no more counts
    out.append((buckets + first % buckets, given.tobytes(), w.per_doc.astype("<u4").tobytes(), hits.astype("<u4").tobytes(),
                base.astype("<f8").tobytes(), None, None))
    cols = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), [pa.int32(), *[pa.binary()] * 6], strict=True)]
    return pa.RecordBatch.from_arrays([cols[0], pa.array([first] * len(out), pa.int64()), *cols[1:]],
                                      ["bucket", "first", "rows", "sizes", "keys", "more", "times", "words"])


def _count(group: pa.Table, logs: np.ndarray, log_n: float) -> pa.Table:
    """Partial sums by document of one bucket."""
    firsts = group.column("first").to_numpy()
    take = lambda c, kind: [np.frombuffer(x, kind) for x in group.column(c).to_pylist()]
    if group.column("times").null_count:  # a group of documents
        ids = np.concatenate([x.reshape(-1, 2) for x in take("rows", "<i8")])
        n_words, hits, base = (np.concatenate(take(c, k)) for c, k in (("sizes", "<u4"), ("keys", "<u4"), ("more", "<f8")))
        uid = np.concatenate([f + np.arange(len(x) // 2) for f, x in zip(firsts, take("rows", "<i8"), strict=True)])
        doc = pa.array(ids[:, 0], pa.int64(), mask=ids[:, 1] > 0)
        return pa.table({"uid": uid, "doc_id": doc, "n_words": n_words.astype(np.int64), "n_seen": hits.astype(np.int64), "log_score": base})
    key = np.concatenate([_unpacked(x, KEY_BYTES) for x in group.column("keys").to_pylist()])
    sizes = np.concatenate(take("sizes", "<u4")).astype(np.int64)
    uid = np.concatenate([f + x.astype(np.int64) for f, x in zip(firsts, take("rows", "<u4"), strict=True)])
    times = np.ones(len(key), np.int64)
    at = 0
    for keys, odd in zip(group.column("keys").to_pylist(), take("times", "<u4"), strict=True):
        odd = odd.reshape(-1, 2)
        times[at + odd[:, 0]] = odd[:, 1]
        at += len(keys) // KEY_BYTES
    if group.column("words").null_count:
        count = _totals(key, times)
        seen = counted = count >= SEEN
        score = np.where(seen, np.concatenate(take("more", "<f8")) + np.log(count), 0.0)
    else:
        word = np.concatenate([_unpacked(x, KEY_BYTES) for x in group.column("words").to_pylist()])
        seen, counted, score = _rare(word, key, np.concatenate(take("more", "<u4")), times, logs, log_n)
    starts = np.cumsum(sizes) - sizes
    hits, sums = np.add.reduceat(np.where(counted, times, 0), starts), np.add.reduceat(times * score, starts)
    keep = (hits > 0) | (sums != 0)
    n = int(keep.sum())
    return pa.table({"uid": uid[keep], "doc_id": pa.nulls(n, pa.int64()), "n_words": pa.nulls(n, pa.int64()), "n_seen": hits[keep],
                     "log_score": sums[keep]})


def _totals(key: np.ndarray, times: np.ndarray) -> np.ndarray:
    """The sum of ``times`` over each row's key."""
    codes, values, _ = X.distinct(key)
    return np.bincount(codes, weights=times, minlength=len(values))[codes]


def _rare(word: np.ndarray, key: np.ndarray, payload: np.ndarray, times: np.ndarray, logs: np.ndarray,
          log_n: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(seen, seen and counted here, score) of the occurrences in a bucket of rare words.

    Every occurrence of a rare word is here as the later word of its pair (and, unless it ends a text, as the one
    before).  A pair of two rare words is also in the other's bucket: each adds its own word's part.
    """
    is_before, at = payload >> 31 == 1, (payload & RARE).astype(np.int64)
    two = at == RARE
    other = np.where(two, 0.0, logs[np.where(two, 0, at)])
    own = np.log(_totals(word, np.where(is_before, 0, times)))
    count = _totals(X.mix(word * X._BASE + (key << X.U64(1)) + is_before.astype(np.uint64)), times)
    seen, log_count = count >= SEEN, np.log(count)
    back = np.log(BACKOFF) - log_n
    as_later = np.where(seen, log_count - other, back + own)
    as_before = np.where(seen, np.where(two, 0.0, log_count) - own, np.where(two, 0.0, back + other))
    return seen, seen & ~(is_before & two), np.where(is_before, as_before, as_later)


def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scores(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_seen", F.round("log_score", 4).alias("log_score"), F.round("mean_score", 6).alias("mean_score"))


#: Same scores in DuckDB; a text's words are numbered, so that the pairs are neighbours.
SQL = f"""
with d as (select row_number() over () as uid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') ws from documents),
w as (select uid, unnest(ws) w, generate_subscripts(ws, 1) i from d),
p as (select uid, w, lag(w) over (partition by uid order by i) v from w),
n as (select count(*) n from w),
c1 as (select w, count(*) c from w group by w),
c0 as (select v, count(*) c from p group by v),
cv as (select w v, c from c1 union all select null, c from c0 where v is null),
c2 as (select v, w, count(*) c from p group by v, w),
s as (select p.uid, c2.c >= {SEEN} seen,
             case when c2.c >= {SEEN} then ln(c2.c) - ln(cv.c) else ln({BACKOFF}) + ln(c1.c) - ln(n) end x
      from p join c2 on p.v is not distinct from c2.v and p.w = c2.w join cv on p.v is not distinct from cv.v
      join c1 on p.w = c1.w cross join n)
select doc_id, len(ws)::bigint n_words, coalesce(k, 0)::bigint n_seen, round(t, 4) log_score, round(t / len(ws), 6) mean_score
from d left join (select uid, sum(x) t, sum(seen::int) k from s group by uid) using (uid)
"""
