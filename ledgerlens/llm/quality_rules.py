"""Quality rules with risk-controlled cutoffs.

Every rule compares an integer ratio of a document's counts with a cutoff.  Cutoffs are not
set by hand: on labelled documents exact binomial tests decide, per stratum (language),
which cutoffs of a fixed grid reject good documents (``quality`` = 1) at a rate below a risk.

* A rule's cutoffs are tested from loose to sharp until one fails (a fixed sequence, which needs no
  correction); the last that passed is used, none where the first fails.  The error probability
  ``DELTA`` is divided by the number of sequences: rules x (labelled strata + 1).
* A stratum's risk is the least of ``RISKS`` that its number of labels can prove at all, so it
  does not depend on what the rules do.  Strata with too few labels for any are tested together, as one
  pool; what is proven then holds for the pool as a whole.
* So with probability 1 - DELTA every stratum of its own, and the pool, keep at least
  1 - len(RULES) * risk of their good documents that pass the base rule.  Column ``guarantee`` of the
  query says which a row has: ``own``, ``pool``, or ``none`` (no label of its language: base rule alone).

Defined results: null or empty text has no words and fails the base rule; rows of a null language are
the stratum ``OTHER``; repeated rows are judged each by itself; without labels no cutoff is certified
and only the base rule rejects.  Labels in conflict for one id are not used.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm import text as X
from ledgerlens.llm.corpus import append, one_label, table, written

RISKS = (0.005, 0.01, 0.02, 0.05)
DELTA = 0.05
OTHER = "*"
SYMBOLS = X.separators(b"#*$%&|<>")
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PCT = 20

#: rule -> (measure, out of, sign, cutoffs from sharp to loose).  Rejected: 100 * measure
#: over cutoff * out-of (sign 1) or under it (sign -1).
RULES = {
    "symbols": ("n_symbols", "n_words", 1, (5, 10, 20, 35, 50, 80, 120, 200)),
    "duplicate_lines": ("n_dup_lines", "n_lines", 1, (5, 10, 20, 30, 50, 70)),
    "repeated_words": ("n_repeat_words", "n_words", 1, (2, 5, 10, 15)),
    "short_words": ("word_chars", "n_words", -1, (400, 350, 300, 250, 200)),
    "long_words": ("word_chars", "n_words", 1, (700, 800, 1000, 1500, 2500)),
}

MEASURES = T.StructType([T.StructField(n, T.LongType()) for n in
                         ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")])


def _repeats(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Of each element: how often its (row, hash) occurs."""
    codes, values, _ = X.distinct(X.mix(h + X.mix(doc.astype(np.uint64) + X.U64(1))))
    return np.bincount(codes, minlength=len(values))[codes]


def _measure(part: pa.RecordBatch) -> list[pa.Array]:
    w = X.words(part.column("text"))
    n = part.num_rows
    data, bounds = w.data, w.offsets
    owner = np.repeat(np.arange(n), np.diff(bounds))
    inside = ~X.BLANKS[data] & ((data & 0xC0) != 0x80)
    count = lambda mask: np.bincount(owner[mask], minlength=n)
    # lines: between newlines and row bounds, with at least one word
    breaks = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate([bounds[:-1], breaks + 1]))
    end = np.sort(np.concatenate([breaks, bounds[1:]]))
    first_word = np.searchsorted(w.start, start)
    worded = first_word < np.searchsorted(w.start, end)
    start, end = start[worded], end[worded]
    row = np.searchsorted(bounds, start, side="right") - 1
    lines = np.bincount(row, minlength=n)
    keys = X.mix(X.hash_ranges(data, start, end) + X.mix(row.astype(np.uint64) + X.U64(1)))
    _, _, first = X.distinct(keys)
    dup = lines - np.bincount(row[first], minlength=n)
    # words inside windows that occur twice or more
    wh, at = X.window_hashes(X.hash_words(w), w.doc, WINDOW)
    at = at[_repeats(wh, w.doc[at]) > 1]
    cover = np.zeros(len(w.doc) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + WINDOW, -1)
    repeat = np.bincount(w.doc[np.cumsum(cover[:-1]) > 0], minlength=n)
    return [pa.array(x.astype(np.int64)) for x in (w.per_doc, count(inside), count(SYMBOLS[data]), dup, repeat, lines)]


def measures(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with the struct of counts; also the struct's column name."""
    return append(docs, _measure, MEASURES)


def base_failed(m: str) -> Column:
    c = lambda n: F.col(f"{m}.{n}")
    return (c("n_words") < MIN_WORDS) | (100 * c("n_repeat_words") > MAX_REPEAT_PCT * c("n_words"))


def rejects(m: str, rule: str, cutoff: Column | int) -> Column:
    what, of, sign, _ = RULES[rule]
    value, limit = 100 * F.col(f"{m}.{what}"), F.lit(cutoff) * F.col(f"{m}.{of}")
    return value > limit if sign > 0 else value < limit


def at_most(n: int, k: int, p: float) -> float:
    """P(Binomial(n, p) <= k), summed exactly in logs."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
            for i in range(k + 1)]
    top = max(logs)
    return math.exp(top) * math.fsum(math.exp(x - top) for x in logs)


def certified(n: int, k: int, risk: float, level: float) -> bool:
    """Whether k rejections of n good documents prove, at ``level``, a rate below ``risk``.

    This is the exact (Clopper-Pearson) upper bound below ``risk``, as P(X <= k) at ``risk`` is under ``level``.
    """
    return n > 0 and k < n * risk and at_most(n, k, risk) <= level


def provable(n: int, level: float) -> float | None:
    """The least of ``RISKS`` that n good documents can prove at ``level``, if none of them is rejected."""
    return next((r for r in RISKS if n * math.log1p(-r) <= math.log(level)), None)


@dataclass(frozen=True)
class Certified:
    """Cutoffs of one group of strata, and what they guarantee."""

    guarantee: str
    risk: float | None
    cutoffs: dict[str, int]


def sharpest(n: int, rejected: dict[str, int], risk: float | None, level: float) -> dict[str, int]:
    """{rule: cutoff}: the last of each rule's cutoffs, from loose to sharp, that is certified with all before it."""
    out = {}
    for rule, (_, _, _, grid) in RULES.items():
        for cutoff in reversed(grid):
            if risk is None or not certified(n, rejected[f"{rule}_{cutoff}"], risk, level):
                break
            out[rule] = cutoff
    return out


def measured(docs: DataFrame) -> tuple[DataFrame, str]:
    """(doc_id, lang, counts) of every row; also the counts' name."""
    counted, m = measures(docs.select("doc_id", "text", "lang"))
    return counted.select("doc_id", "lang", m), m


def cutoffs(counted: DataFrame, m: str, labels: DataFrame, delta: float = DELTA) -> dict[str, Certified]:
    """What is certified for each labelled stratum, from the good labelled documents of :func:`measured`.

    One row of counts per labelled language reaches the driver.
    """
    good = one_label(labels, "quality").filter("label = 1").select("doc_id")
    held = counted.filter(~base_failed(m)).join(good, "doc_id", "left_semi")
    sums = [F.sum(rejects(m, r, c).cast("long")).alias(f"{r}_{c}") for r, (_, _, _, grid) in RULES.items() for c in grid]
    rows = [r.asDict() for r in held.groupBy(F.coalesce("lang", F.lit(OTHER)).alias("stratum")).agg(F.count(F.lit(1)).alias("n"), *sums).collect()]
    level = delta / (len(RULES) * (len(rows) + 1))
    out, thin = {}, []
    for x in rows:
        risk = provable(x["n"], level)
        if risk is None:
            thin.append(x)
        else:
            out[x["stratum"]] = Certified("own", risk, sharpest(x["n"], x, risk, level))
    if thin:
        pool = {k: sum(x[k] for x in thin) for k in thin[0] if k != "stratum"}
        risk = provable(pool["n"], level)
        shared = Certified("pool" if risk else "none", risk, sharpest(pool["n"], pool, risk, level))
        out |= {x["stratum"]: shared for x in thin}
    return out


def verdict(m: str, chosen: dict[str, Certified]) -> Column:
    """True for documents that the base rule and their stratum's certified cutoffs keep."""
    lang = F.coalesce(F.col("lang"), F.lit(OTHER))
    groups: dict[tuple, list[str]] = {}
    for stratum, c in sorted(chosen.items()):
        groups.setdefault(tuple(sorted(c.cutoffs.items())), []).append(stratum)
    failed = F.lit(False)
    for found, strata in groups.items():
        for r, c in found:
            failed = failed | (lang.isin(strata) & rejects(m, r, c))
    return ~base_failed(m) & ~failed


def guarantee(chosen: dict[str, Certified]) -> Column:
    """What the cutoffs of a row's stratum guarantee: own, pool or none."""
    lang = F.coalesce(F.col("lang"), F.lit(OTHER))
    of = lambda kind: lang.isin([s for s, c in sorted(chosen.items()) if c.guarantee == kind])
    return F.when(of("own"), "own").when(of("pool"), "pool").otherwise("none")


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the counts are written once: the tests and the verdicts read them
    counted, m = measured(table(spark, sf_dir, "documents"))
    counted = written(counted, "counted")
    chosen = cutoffs(counted, m, table(spark, sf_dir, "labels"))
    return counted.select("doc_id", *[f"{m}.{f.name}" for f in MEASURES][:5], base_failed(m).alias("base_failed"),
                          verdict(m, chosen).alias("kept"), F.col("lang").alias("stratum"), guarantee(chosen).alias("guarantee"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that the rules keep, with the columns they came with."""
    chosen = cutoffs(*measured(docs), table(spark, sf_dir, "labels"))
    out, m = measures(docs)
    return out.filter(verdict(m, chosen)).select([F.col(f"`{c}`") for c in docs.columns])


def _sql() -> str:
    """The same verdicts in DuckDB, with the binomial tail written out."""
    tests = ", ".join(f"('{r}', {k}, {c}, {sign}, '{what}', '{of}')" for r, (what, of, sign, grid) in RULES.items() for k, c in enumerate(grid))
    value = lambda col: "case " + col + "".join(f" when '{f.name}' then {f.name}" for f in MEASURES) + " end"
    word = r"[^\x20\x09-\x0D]"
    risks = ", ".join(f"({r})" for r in RISKS)
    return rf"""
with d as (select row_number() over () as uid, doc_id, coalesce(text, '') t, lang from documents),
w as (select uid, unnest(ws) w, generate_subscripts(ws, 1) i from (select uid, regexp_extract_all(t, '{word}+') ws from d)),
g as (select uid, i, lead(w, 4) over v as last,
             concat_ws(' ', w, lead(w, 1) over v, lead(w, 2) over v, lead(w, 3) over v, lead(w, 4) over v) gram
      from w window v as (partition by uid order by i)),
r as (select uid, i from g where last is not null qualify count(*) over (partition by uid, gram) > 1),
cover as (select uid, count(distinct i + k) n from (select uid, i, unnest(range({WINDOW})) k from r) group by uid),
l as (select uid, count(*) n, count(*) - count(distinct line) dup
      from (select uid, unnest(string_split(t, chr(10))) line from d) where regexp_matches(line, '{word}') group by uid),
s as (select uid, count(*) n, sum(length(w)) chars from w group by uid),
c as (select d.uid, d.doc_id, d.lang, coalesce(s.n, 0)::bigint n_words, coalesce(s.chars, 0)::bigint word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint n_symbols, coalesce(l.dup, 0)::bigint n_dup_lines,
             coalesce(cover.n, 0)::bigint n_repeat_words, coalesce(l.n, 0)::bigint n_lines
      from d left join s using (uid) left join l using (uid) left join cover using (uid)),
m as (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words base_failed from c),
t(rule, place, cutoff, sign, what, of) as (values {tests}),
tested as (select m.*, t.*, case when sign > 0 then 100 * ({value('what')}) > cutoff * ({value('of')})
                                 else 100 * ({value('what')}) < cutoff * ({value('of')}) end rejected from m cross join t),
good as (select doc_id from labels where doc_id is not null and quality in (0, 1) group by doc_id having min(quality) = 1),
held as (select *, coalesce(lang, '{OTHER}') own from tested where doc_id in (select doc_id from good) and not base_failed),
one as (select own, rule, place, count(*) n, sum(rejected::int) k from held group by all),
level as (select {DELTA} / ({len(RULES)} * (count(distinct own) + 1)) least from one),
proof as (select own, n, (select min(r) from (values {risks}) x(r) where n * ln(1 - r) <= ln(least)) risk
          from (select own, max(n) n from one group by own), level),
pool as (select n, (select min(r) from (values {risks}) x(r) where n * ln(1 - r) <= ln(least)) risk
         from (select sum(n) n from proof where risk is null) z, level where n is not null),
groups as (select own, 'own' kind, own as grp, risk from proof where risk is not null
           union all select p.own, case when pool.risk is null then 'none' else 'pool' end, null, pool.risk from proof p, pool where p.risk is null),
tally as (select grp, g.risk, rule, place, sum(n) n, sum(k) k from one join groups g using (own) group by all),
failed as (select grp, rule, max(place) place from tally, level
           where not coalesce(k < n * risk and list_sum(list_transform(range(0, k::bigint + 1),
                 lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(risk) + (n - i) * ln(1 - risk)))) <= least, false)
           group by grp, rule),
sure as (select y.grp, y.rule, min(y.place) place from tally y left join failed f on f.grp is not distinct from y.grp and f.rule = y.rule
         where f.place is null or y.place > f.place group by all),
out as (select distinct uid from tested t join groups g on g.own = coalesce(t.lang, '{OTHER}')
        join sure s on s.grp is not distinct from g.grp and s.rule = t.rule and s.place = t.place where rejected)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and uid not in (select uid from out) kept, lang stratum, coalesce(g.kind, 'none') guarantee
from m left join groups g on g.own = coalesce(lang, '{OTHER}')
"""


SQL = _sql()
