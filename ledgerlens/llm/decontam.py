"""Benchmark decontamination: BM25 retrieval with block-max bounds, then overlap of question and answer.

The test items (cut into as few segments of about equal length as hold at most ``SEGMENT``
words each, so that none is a short rest) form an inverted index whose
impacts are BM25 weights divided by the segment's own full score, so a passage that holds a
whole segment scores 1.  Every passage of every document (``PASSAGE`` words, half overlapping,
so that a segment always lies whole in one) queries the index for *all* segments of a score of
at least ``SCORE``:

1. Terms are split as in WAND: the most frequent ones (in a 1 / ``DENSE`` share of the segments or more), which together
   give no segment more than half the threshold, cannot lift a segment over it.  Only the other, essential terms'
   postings are opened; a segment whose essential sum plus the largest share of frequent
   terms stays below the threshold is never looked at.
2. For the rest, the passage's frequent terms are bounded by their block maxima (blocks of
   ``BLOCK`` neighbouring segments); a pair whose bound stays below the threshold is dropped.
3. Survivors get their exact score.

A retrieved pair counts as a leak when both parts of the item, question and answer (its
last sentence, or its second half where it has one sentence only), overlap with the passage
or, where the item has several segments, with all passages of the document together that
were retrieved for them:
at least ``OVERLAP`` of either part's word trigrams (single words where a part is shorter; an
empty part asks for nothing) occur in the passage.  Words are runs of letters and digits in lower case.
An item of fewer than ``SHORT`` words is asked for as a whole, all its words in a row; one of fewer than ``GRAM`` words
is an expression of the language rather than a test, and only a document of nothing but these words leaks it.

All tests run against shards of about ``SHARD`` segments, one after the other; an index of
that size is what a worker holds, however many items there are.

Defined results: null or empty texts and items match nothing; repeated documents each give
their rows, repeated items (same id, same text) count once; a null item id is reported as
null; the best passage wins, of equal ones the first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ledgerlens.llm import text as X
from ledgerlens.llm.corpus import append, table

SCORE = 0.6
OVERLAP = 0.6
SEGMENT = 64
PASSAGE = 128
BLOCK = 16
SHARD = 20_000
GRAM = 3
SHORT = 2 * GRAM
#: A frequent term's weights are kept as a dense row, at most ``DENSE * SEGMENT`` rows by the number of postings.
DENSE = 16
K1, B = 1.2, 0.75


@dataclass
class Segment:
    item: int | None
    words: np.ndarray
    #: Parts of the whole item; the same for all its segments.
    question: np.ndarray
    answer: np.ndarray
    #: Number of the item's text among those given, and of its segments.
    text: int = 0
    parts: int = 1


def _grams(h: np.ndarray) -> np.ndarray:
    """Distinct word trigrams, or words where there are fewer than three."""
    return np.unique(X.window_hashes(h, np.zeros(len(h), np.int64), GRAM)[0] if len(h) >= GRAM else h)


def _run(h: np.ndarray) -> np.ndarray:
    """What a short item asks for, as an array of one hash."""
    if not len(h):
        return h
    run = X.window_hashes(h, np.zeros(len(h), np.int64), len(h))[0]
    return X.mix(run + X.U64(1)) if len(h) < GRAM else run


def _held(span: np.ndarray, whole: bool) -> np.ndarray:
    """What a passage holds: words, trigrams, the runs that short items ask for; ``whole``: it is its whole document."""
    own = np.zeros(len(span), np.int64)
    runs = [X.window_hashes(span, own, k)[0] for k in range(GRAM, SHORT)]
    return np.concatenate([span, *runs, *([_run(span)] if whole and len(span) < GRAM else [])])


def segments(ids: list, texts: list[str]) -> list[Segment]:
    """Segments of at most ``SEGMENT`` words, of one length but for a word; with question and answer part of their items."""
    out = []
    for place, (item, text) in enumerate(zip(ids, texts, strict=True)):
        w = X.words(pc.utf8_lower(pa.array([text])), X.NON_ALNUM)
        h = X.hash_words(w)
        n = len(h)
        ends = np.array([i for i, b in enumerate(w.data) if b in b".!?\n"], np.int64)
        # the last sentence end that leaves words on both sides
        inner = [k for k in np.searchsorted(w.start, ends).tolist() if 0 < k < n]
        cut = inner[-1] if inner else (n + 1) // 2
        question, answer = (_run(h), h[:0]) if n < SHORT else (_grams(h[:cut]), _grams(h[cut:]))
        parts = -(-n // SEGMENT)
        for k in range(parts):
            out.append(Segment(item, h[n * k // parts: n * (k + 1) // parts], question, answer, place, parts))
    return out


class Index:
    """Impacts by term: postings of essential terms, dense rows and block maxima of the frequent ones."""

    def __init__(self, given: list[Segment], score: float = SCORE) -> None:
        self.segments, self.least = given, score
        n = len(given)
        seg = np.repeat(np.arange(n), [len(s.words) for s in given])
        pair, tf = np.unique(np.stack([np.concatenate([s.words for s in given]), seg.astype(np.uint64)], 1), axis=0, return_counts=True)
        self.terms, term = np.unique(pair[:, 0], return_inverse=True)
        seg = pair[:, 1].astype(np.int64)
        df = np.bincount(term, minlength=len(self.terms))
        size = np.array([len(s.words) for s in given])
        weight = np.log(1 + (n - df + 0.5) / (df + 0.5))[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[seg] / size.mean()))
        weight /= np.bincount(seg, weights=weight, minlength=n)[seg]
        # frequent terms: as many as give no segment over half the threshold
        by_term = np.argsort(term, kind="stable")
        first = np.cumsum(df) - df
        share = np.zeros(n)
        frequent = np.zeros(len(self.terms), bool)
        for t in np.argsort(-df, kind="stable"):
            if df[t] * DENSE < n:
                break  # rarer ones are cheaper as postings
            rows = by_term[first[t]: first[t] + df[t]]
            if (share[seg[rows]] + weight[rows]).max() <= score / 2:
                share[seg[rows]] += weight[rows]
                frequent[t] = True
        self.top_share = float(share.max())
        self.row = np.full(len(self.terms), -1)
        self.row[frequent] = np.arange(frequent.sum())
        self.dense = np.zeros((int(frequent.sum()), n))
        dense = frequent[term]
        self.dense[self.row[term[dense]], seg[dense]] = weight[dense]
        blocks = -(-n // BLOCK)
        padded = np.pad(self.dense, ((0, 0), (0, blocks * BLOCK - n)))
        self.block_max = padded.reshape(len(self.dense), blocks, BLOCK).max(2)
        order = np.lexsort((seg[~dense], term[~dense]))
        self.posting_seg = seg[~dense][order]
        self.posting_weight = weight[~dense][order]
        held = np.bincount(term[~dense], minlength=len(self.terms))
        self.first = np.cumsum(held) - held
        self.held = held

    def retrieve(self, window: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, segment, score) of all pairs at or over the threshold; the input are distinct (window, term) pairs, by window."""
        n = len(self.segments)
        essential = self.row[term] < 0
        w, t = window[essential], term[essential]
        hit = X.ragged(self.first[t], self.held[t])
        key = np.repeat(w, self.held[t]) * n + self.posting_seg[hit]
        pairs, place = np.unique(key, return_inverse=True)
        part = np.bincount(place, weights=self.posting_weight[hit], minlength=len(pairs))
        eps = 1e-6
        keep = part + self.top_share >= self.least - eps
        pairs, part = pairs[keep], part[keep]
        of, seg = pairs // n, pairs % n
        # the passage's frequent terms, for each surviving pair
        fw, fr = window[~essential], self.row[term[~essential]]
        lo, hi = np.searchsorted(fw, of), np.searchsorted(fw, of, side="right")
        rows = fr[X.ragged(lo, hi - lo)]
        owner = np.repeat(np.arange(len(of)), hi - lo)
        bound = part + np.bincount(owner, weights=self.block_max[rows, seg[owner] // BLOCK], minlength=len(of))
        alive = bound >= self.least - eps
        exact = part + np.bincount(owner[alive[owner]], weights=self.dense[rows[alive[owner]], seg[owner[alive[owner]]]], minlength=len(of))
        exact = np.round(exact, 6)
        done = alive & (exact >= self.least)
        return of[done], seg[done], exact[done]

    def leaks(self, text: pa.Array) -> list[tuple[int, int | None, int, float, float, float]]:
        """(row, item, first word of the passage, score, question overlap, answer overlap), best passage of each (row, item)."""
        w = X.words(pc.utf8_lower(text), X.NON_ALNUM)
        if not len(w.doc):
            return []
        h = X.hash_words(w)
        per = w.per_doc
        base = np.cumsum(per) - per
        half = (np.arange(len(h)) - base[w.doc]) // (PASSAGE // 2)
        windows = np.maximum(1, -(-per // (PASSAGE // 2)) - 1)  # of each row
        wbase = np.cumsum(windows) - windows
        at = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
        in_index = np.flatnonzero(self.terms[at] == h)
        t, d, hf = at[in_index], w.doc[in_index], half[in_index]
        later, earlier = hf < windows[d], hf > 0
        window = np.concatenate([(wbase[d] + hf)[later], (wbase[d] + hf - 1)[earlier]])
        pair = np.unique(window * len(self.terms) + np.concatenate([t[later], t[earlier]]))
        of, seg, score = self.retrieve(pair // len(self.terms), pair % len(self.terms))
        best: dict[tuple[int, int | None], tuple] = {}
        # of items of several segments: all passages of a row
        whole: dict[tuple[int, int], list[tuple]] = {}
        owner = np.searchsorted(wbase, of, side="right") - 1

        def judge(row: int, part: Segment, x: float, first: int, held: np.ndarray) -> None:
            q, a = (float(np.isin(g, held).mean()) if len(g) else 1.0 for g in (part.question, part.answer))
            if q >= OVERLAP and a >= OVERLAP:
                found = (-x, first, q, a)
                key = (row, part.item)
                best[key] = min(best.get(key, found), found)

        for win, s, x, row in zip(of.tolist(), seg.tolist(), score.tolist(), owner.tolist(), strict=True):
            first = (win - int(wbase[row])) * (PASSAGE // 2)
            span = h[base[row] + first: base[row] + min(first + PASSAGE, per[row])]
            held = _held(span, len(span) == per[row])
            part = self.segments[s]
            if part.parts == 1:
                judge(row, part, x, first, held)
            else:
                whole.setdefault((row, part.text), []).append((-x, first, s, held))
        for (row, _), hits in whole.items():
            x, first, s, _ = min(hits, key=lambda hit: hit[:3])
            judge(row, self.segments[s], -x, first, np.concatenate([hit[3] for hit in hits]))
        return [(row, item, first, -x, q, a) for (row, item), (x, first, q, a) in best.items()]


def _shards(spark: SparkSession, items: DataFrame) -> Iterator[Index]:
    """Indexes of about ``SHARD`` segments each; items are read shard by shard, not all at once."""
    items = items.select("item_id", "text").filter(F.col("text").isNotNull()).distinct()
    words = F.size(F.split("text", r"[^\p{L}\p{N}]+"))
    count = items.agg(F.sum(F.greatest(F.lit(1), F.ceil(words / SEGMENT)))).first()[0] or 0
    parts = max(1, -(-int(count) // SHARD))
    for k in range(parts):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k).orderBy("item_id", "text").collect()
        if made := segments([r.item_id for r in own], [r.text for r in own]):
            yield Index(made)


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, passage, score, question_overlap, answer_overlap): a row per document and leaked item."""
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType
    of_item = to_arrow_type(kind)
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id {kind.simpleString()}, passage long, score double, question_overlap double, answer_overlap double"
    rows = docs.select("doc_id", "text")
    found = []
    for index in _shards(spark, items):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for part in X.slices(batches):
                hits = shared.value.leaks(part.column("text"))
                if hits:
                    row, item, first, score, q, a = zip(*hits, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id").take(pa.array(row)), pa.array(item, of_item), pa.array(first, pa.int64()),
                         pa.array(score), pa.array(q), pa.array(a)],
                        ["doc_id", "item_id", "passage", "score", "question_overlap", "answer_overlap"])

        found.append(rows.mapInArrow(run, schema))
    return reduce(DataFrame.unionAll, found) if found else spark.createDataFrame([], schema)


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that hold no test item, with the columns they came with."""
    out = docs
    for index in _shards(spark, table(spark, sf_dir, "benchmark")):
        shared = spark.sparkContext.broadcast(index)

        def leaked(part: pa.RecordBatch, shared=shared) -> list[pa.Array]:
            mask = np.zeros(part.num_rows, bool)
            mask[[row for row, *_ in shared.value.leaks(part.column("text"))]] = True
            return [pa.array(mask)]

        out, m = append(out, leaked, T.StructType([T.StructField("leaked", T.BooleanType())]))
        out = out.filter(~F.col(f"{m}.leaked")).drop(m)
    return out


_WORDS = r"regexp_extract_all(lower({}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

#: The same in DuckDB, by plain joins of passages and segments on their terms.
SQL = rf"""
with t as (select row_number() over () iid, * from (select distinct item_id, text from benchmark where text is not null)),
iw as (select iid, unnest(ws) w, generate_subscripts(ws, 1) - 1 i from (select iid, {_WORDS.format('text')} ws from t)),
cuts as (select iid, k from (
    select iid, j, n, sum(len({_WORDS.format('p')})) over (partition by iid order by j) k
    from (select iid, unnest(ps) p, generate_subscripts(ps, 1) j, len(ps) n from (select iid, string_split_regex(text, '[.!?
]') ps from t))) x
    where j < n),
nn as (select iid, count(*) n, ceil(count(*) / {SEGMENT})::bigint parts, string_agg(w, ' ' order by i) run from iw group by iid),
sw as (select iid, i, w, n, ((i + 1) * parts - 1) // n seg from iw join nn using (iid)),
s as (select iid, n, coalesce((select max(k) from cuts c where c.iid = nn.iid and k > 0 and k < n), (n + 1) // 2) cut from nn where n >= {SHORT}),
part as (select iid, 'q' part, 0 a, cut z from s union all select iid, 'a', cut, n from s),
three as (select iid, i, w, concat_ws(' ', w, lead(w, 1) over v, lead(w, 2) over v) g from iw window v as (partition by iid order by i)),
grams as (select distinct part.iid, part, case when z - a < {GRAM} then w else g end gram
          from part join three on part.iid = three.iid and i >= a and i < z and (z - a < {GRAM} or i + {GRAM} <= z)
          union all select iid, 'q', case when n < {GRAM} then '^' || run || '$' else run end from nn where n < {SHORT}),
tf as (select iid, seg, w, count(*) tf from sw group by all),
size as (select iid, seg, count(*) n from sw group by all),
df as (select w, count(*) df from tf group by w),
impact as (select tf.iid, tf.seg, tf.w, ln(1 + (c - df + 0.5) / (df + 0.5)) * tf * {K1 + 1} / (tf + {K1} * ({1 - B} + {B} * size.n / m)) x
           from tf join df using (w) join size using (iid, seg), (select count(*) c, avg(n) m from size)),
weight as (select iid, seg, w, x / sum(x) over (partition by iid, seg) x from impact),
d as (select row_number() over () uid, doc_id, {_WORDS.format('text')} ws from documents where text is not null),
dw as (select uid, unnest(ws) w, generate_subscripts(ws, 1) - 1 i, greatest(1, ceil(len(ws) / {PASSAGE / 2})::bigint - 1) windows, len(ws) n from d),
win as (select uid, w, i, n, i // {PASSAGE // 2} - k win from dw, (values (0), (1)) x(k) where i // {PASSAGE // 2} - k between 0 and windows - 1),
hit as (select h.*, case when parts = 1 then win else -1 end own
        from (select uid, win, iid, seg, round(sum(x), 6) score from (select distinct uid, win, w from win) join weight using (w)
              group by all having round(sum(x), 6) >= {SCORE}) h join nn using (iid)),
held as (select distinct uid, win, unnest([w, case when w3 is not null then concat_ws(' ', w, w2, w3) end,
                                           case when w4 is not null then concat_ws(' ', w, w2, w3, w4) end,
                                           case when w5 is not null then concat_ws(' ', w, w2, w3, w4, w5) end,
                                           case when i = 0 and n < {GRAM} then '^' || concat_ws(' ', w, w2) || '$' end]) gram
         from (select uid, win, i, n, w, lead(w, 1) over v w2, lead(w, 2) over v w3, lead(w, 3) over v w4, lead(w, 4) over v w5
               from win semi join hit using (uid, win) window v as (partition by uid, win order by i))),
got as (select distinct h.uid, h.own, h.iid, gram from hit h join held using (uid, win)),
share as (select h.uid, h.own, h.iid, part, count(got.gram) / count(*) x
          from (select distinct uid, own, iid from hit) h join grams using (iid)
          left join got on got.uid = h.uid and got.own = h.own and got.iid = h.iid and got.gram = grams.gram group by all),
judged as (select h.*, coalesce(max(x) filter (part = 'q'), 1) q, coalesce(max(x) filter (part = 'a'), 1) a
           from (from hit qualify row_number() over (partition by uid, own, iid order by score desc, win, seg) = 1) h
           left join share using (uid, own, iid) group by all)
select doc_id, item_id, (win * {PASSAGE // 2})::bigint passage, score, q question_overlap, a answer_overlap
from judged join d using (uid) join t using (iid) where q >= {OVERLAP} and a >= {OVERLAP}
qualify row_number() over (partition by uid, item_id order by score desc, win, q, a) = 1
"""
