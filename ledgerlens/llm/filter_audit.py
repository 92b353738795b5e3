"""Filter interaction audit by contractions of a contingency tensor.

Five filters judge every document; what a filter removes depends on the filters that ran before it.
Instead of running the 120 orders, one pass counts the documents of every part (language) by the
32 combinations of failed filters.  A part's counts are a 2 x 2 x 2 x 2 x 2 tensor, an axis a
filter (0 passes, 1 fails), and every figure of every step of every order is a contraction of that
tensor: each axis takes *pass*, *fail* or *all*, and ``einsum`` does all steps at once.

1. One pass over the whole texts gives each row its failures A to D and a digest of its text.
   Rows alike in id, text and part count together from here on.
2. E (an equal text under a smaller id, anywhere in the table) needs the least id of every text:
   an aggregate with partial minima, met by (digest, id), so a text's many copies spread by id.
3. The text's digest is dropped, rows of one id and one set of failures are added up, then meet the labels.
4. Counts by part and failures, 32 rows a part at most, go into the contraction, a part at a time.

Defined results: null and empty text are the same empty text; a null language and an empty one are the
part ''; a row without id never fails E, is no smaller id for others, and has no label; repeated rows
count each, with no copy among themselves; a document is good or toxic if any of its label rows says
so; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import text as X
from ledgerlens.llm.corpus import table, written

FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT_PCT, MOST_CAPITALS_PCT = 200, 50, 3
SYMBOLS = X.separators(b"#$%&*|")

PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)
#: (filter_order, step) of all steps of all orders, in order.
STEPS = [("".join(order), step) for order in permutations(FILTERS) for step in range(1, len(FILTERS) + 1)]
FIGURES = "kept removed redundant unique_fails good_lost toxic_lost shapley"
AUDIT = "part string, filter_order string, step int, " + ", ".join(f"{n} long" for n in FIGURES.split())


def _failures(text: pa.Array) -> np.ndarray:
    """Per row the failed filters A to D, as bits 0 to 3."""
    w = X.words(text)
    n_words = w.per_doc
    _, _, first = X.distinct(X.mix(X.hash_words(w) + X.mix(w.doc.astype(np.uint64) + X.U64(1))))
    n_distinct = np.bincount(w.doc[first], minlength=len(n_words))

    def count(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])[w.offsets]
        return np.diff(sums)

    data = w.data
    failed = [n_words < LEAST_WORDS, 100 * n_distinct < LEAST_DISTINCT_PCT * n_words,
              100 * count((data >= 65) & (data <= 90)) > MOST_CAPITALS_PCT * count((data & 0xC0) != 0x80), count(SYMBOLS[data]) > 0]
    return sum(f.astype(np.int32) << k for k, f in enumerate(failed))


def failures(docs: DataFrame) -> DataFrame:
    """(doc_id, part, failed, n): rows counted by id, part and failed filters (bits 0 to 4 for A to E)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in X.slices(batches):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("part"), part.column("key"), pa.array(_failures(part.column("text")), pa.int32())],
                ["doc_id", "part", "key", "failed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    key = F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    measured = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), key.alias("key"), "text").mapInArrow(
        run, f"doc_id {kind}, part string, key binary, failed int")
    rows = written(measured.groupBy("doc_id", "part", "key", "failed").agg(F.count(F.lit(1)).alias("n")), "failures")
    least = rows.filter("doc_id is not null").groupBy("key").agg(F.min("doc_id").alias("doc_id")).withColumn("least", F.lit(True))
    later = F.col("doc_id").isNotNull() & F.col("least").isNull()
    return (rows.join(least, ["key", "doc_id"], "left")
            .select("doc_id", "part", (F.col("failed") + F.when(later, 1 << 4).otherwise(0)).alias("failed"), "n")
            .groupBy("doc_id", "part", "failed").agg(F.sum("n").alias("n")))


def tensors(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, cells): the non-zero cells of each part as structs of failed, n, good and toxic."""
    says = lambda name: F.max(F.coalesce(F.col(name) == 1, F.lit(False))).alias(f"is_{name}")
    marked = labels.filter("doc_id is not null").groupBy("doc_id").agg(says("quality"), says("toxic")).filter("is_quality or is_toxic")
    of = lambda mark: F.sum(F.when(F.col(mark), F.col("n")).otherwise(0))
    cells = failed.join(marked, "doc_id", "left").groupBy("part", "failed").agg(
        F.sum("n").alias("n"), of("is_quality").alias("good"), of("is_toxic").alias("toxic"))
    return cells.groupBy("part").agg(F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("cells"))


def _selectors() -> dict[str, np.ndarray]:
    """Per figure (filters, steps, 2): what each axis takes at every step of every order."""
    out: dict[str, list] = {"kept": [], "removed": [], "failing": [], "unique_fails": []}
    for order, step in STEPS:
        own, before = order[step - 1], order[: step - 1]
        out["kept"].append([PASS if f in before + own else ALL for f in FILTERS])
        out["removed"].append([FAIL if f == own else PASS if f in before else ALL for f in FILTERS])
        out["failing"].append([FAIL if f == own else ALL for f in FILTERS])
        out["unique_fails"].append([FAIL if f == own else PASS for f in FILTERS])
    return {k: np.array(v, np.int64).transpose(1, 0, 2) for k, v in out.items()}


_SELECT = _selectors()
_OWN = np.array([FILTERS.index(order[step - 1]) for order, step in STEPS])


def contract(counts: np.ndarray) -> dict[str, np.ndarray]:
    """Figures by step (as ``STEPS``) from counts of shape (3, 2, 2, 2, 2, 2): all, good and toxic documents."""
    take = lambda name, of: np.einsum("nabcde,sa,sb,sc,sd,se->ns", counts[of], *_SELECT[name], optimize=True)
    kept, failing, unique = (take(n, slice(1))[0] for n in ("kept", "failing", "unique_fails"))
    removed, good, toxic = take("removed", slice(3))
    shapley = np.zeros(len(FILTERS), np.int64)
    np.add.at(shapley, _OWN, removed)
    return dict(zip(FIGURES.split(), (kept, removed, failing - removed, unique, good, toxic, shapley[_OWN]), strict=True))


def _tensor(cells: list) -> np.ndarray:
    flat = np.zeros((3, 1 << len(FILTERS)), np.int64)
    for c in cells:
        flat[:, c["failed"]] = c["n"], c["good"], c["toxic"]
    # bit k is the axis of filter k: the highest bit comes first in memory
    return flat.reshape(3, *[2] * len(FILTERS)).transpose(0, 5, 4, 3, 2, 1)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part of ``docs`` (doc_id, text, lang), order of the filters and step, with the counts of that step."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, cells in zip(batch["part"], batch["cells"], strict=True):
                yield pd.DataFrame({"part": part, "filter_order": [o for o, _ in STEPS], "step": [s for _, s in STEPS], **contract(_tensor(cells))})

    return tensors(failures(docs), labels).mapInPandas(run, AUDIT)


def filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), table(spark, sf_dir, "labels"))


SQL = rf"""
with d as (select doc_id, coalesce(text, '') t, coalesce(lang, '') part, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') ws
           from documents),
f as (select part,
             (len(ws) < {LEAST_WORDS})::int + 2 * (100 * len(list_distinct(ws)) < {LEAST_DISTINCT_PCT} * len(ws))::int
             + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {MOST_CAPITALS_PCT} * length(t))::int
             + 8 * regexp_matches(t, '[#$%&*|]')::int + 16 * coalesce(min(doc_id) over (partition by t) < doc_id, false)::int failed,
             coalesce(doc_id in (select doc_id from labels where quality = 1 and doc_id is not null), false)::int good,
             coalesce(doc_id in (select doc_id from labels where toxic = 1 and doc_id is not null), false)::int toxic
      from d),
m as (select part, failed, count(*) n, sum(good) good, sum(toxic) toxic from f group by all),
l(x, bit) as (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o as (select a.x || b.x || c.x || d.x || e.x filter_order from l a, l b, l c, l d, l e
      where a.bit + b.bit + c.bit + d.bit + e.bit = 31 and a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s as (select filter_order, step, bit own,
             coalesce((select sum(bit) from l where position(x in filter_order) < step), 0)::int before
      from o, generate_series(1, 5) g(step), l where x = substr(filter_order, step::int, 1)),
r as (select part, filter_order, step::int step, own,
             sum(n * (failed & (before | own) = 0)::int)::bigint kept,
             sum(n * (failed & before = 0 and failed & own > 0)::int)::bigint removed,
             sum(n * (failed & before > 0 and failed & own > 0)::int)::bigint redundant,
             sum(n * (failed = own)::int)::bigint unique_fails,
             sum(good * (failed & before = 0 and failed & own > 0)::int)::bigint good_lost,
             sum(toxic * (failed & before = 0 and failed & own > 0)::int)::bigint toxic_lost
      from s, m group by all)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) over (partition by part, own)::bigint shapley from r
"""
