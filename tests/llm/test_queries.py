"""The contracts of the registered queries on the small corpus, and on empty tables."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from ledgerlens.llm.queries import oracle_sql, queries
from tests.llm.conftest import corpus, fold

DOCS, _, ITEMS = corpus()
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows(df) -> list:
    return df.collect()


def ids(found) -> Counter:
    return Counter(r.doc_id for r in found)


#: Queries whose rows are not documents have tests of their own.
OTHERS = {"op4_decontamination", "op11_filter_audit", "op12_best_fit_packing", "op13_centroid_clusters"}
PER_ROW = [n for n in queries() if n not in OTHERS]


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_for_every_document(spark, small, name):
    assert ids(rows(queries()[name](spark, small))) == Counter(d[0] for d in DOCS)


@pytest.mark.parametrize("name", [*queries(), "pipeline"])
def test_empty_tables(spark, nothing, name):
    run = corpus_pipeline.run if name == "pipeline" else queries()[name]
    out = run(spark, nothing)
    assert out.columns and rows(out) == []


def test_bpe_equals_the_library(spark, small):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for d in DOCS:
        t = library.encode_ordinary(d[1] or "")
        want[(d[0], len(t), hashlib.sha256(np.array(t, "<u4").tobytes()).hexdigest(), hashlib.sha256((d[1] or "").encode()).hexdigest())] += 1
    assert Counter(tuple(r)[:4] for r in rows(queries()["op2_byte_bpe"](spark, small))) == want


def test_language(spark, small):
    by = {r.doc_id: r for r in rows(queries()["op5_language_id"](spark, small)) if r.doc_id is not None}
    truth = {d[0]: d[2] for d in DOCS if d[2] and d[0] is not None and d[0] < 240}
    assert np.mean([by[i].lang_pred == x for i, x in truth.items()]) > 0.97
    for d in DOCS:
        if d[0] is not None:
            r = by[d[0]]
            lettered = any(c.isalpha() for c in d[1] or "")
            assert (r.lang_pred in ("de", "en")) == lettered and (r.lang_pred == "und") != lettered
            assert 0 <= r.score <= 1 and r.held_out == (fold(d[0], 3) == 1)


@pytest.mark.parametrize(("name", "folds", "out", "truth"), [
    ("op6_quality_model", 4, 2, lambda i: int(i % 8 != 3)), ("op9_toxicity", 3, 1, lambda i: int(i % 5 == 0))])
def test_classifiers(spark, small, name, folds, out, truth):
    found = rows(queries()[name](spark, small))
    held = [r for r in found if r.doc_id is not None and r.doc_id < 240 and r.held_out]
    assert all(r.held_out == (fold(r.doc_id, folds) == out) for r in found if r.doc_id is not None)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in found)
    assert np.mean([r.predicted == truth(r.doc_id) for r in held]) > 0.9


def test_sharding(spark, small):
    found = rows(queries()["op8_sharding"](spark, small))
    sizes = Counter((r.doc_id, r.size, r.text_crc32) for r in found)
    assert sizes == Counter((d[0], len((d[1] or "").encode()) + 8, zlib.crc32((d[1] or "").encode())) for d in DOCS)
    slots: dict[int, list] = {}
    for r in found:
        assert r.law == "key" and 0 <= r.shard < 24 and r.grown_shard in (r.shard, 24)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def counted(text: str | None) -> tuple[int, int, int, int, int]:
    text = text or ""
    words = WORD.findall(text)
    seen, dup, at = set(), 0, {}
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    for i in range(len(words) - 4):
        at.setdefault(tuple(words[i:i + 5]), []).append(i)
    repeat = {j for places in at.values() if len(places) > 1 for i in places for j in range(i, i + 5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeat)


def test_quality_rules(spark, small):
    found = rows(queries()["op10_quality_rules"](spark, small))
    want = Counter((d[0], *counted(d[1])) for d in DOCS)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found) == want
    for r in found:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_decontamination(spark, small):
    found = rows(queries()["op4_decontamination"](spark, small))
    assert {(r.doc_id, r.item_id) for r in found} == {(244, 2), (245, 3)}
    assert all(r.score > 0.99 and r.question_overlap == r.answer_overlap == 1 for r in found)


def test_near_dedup(spark, small):
    by: dict = {}
    for r in rows(queries()["op1_near_dedup"](spark, small)):
        by.setdefault(r.doc_id, set()).add(r.class_id)
    one = lambda i: next(iter(by[i]))
    assert one(240) == one(241) == one(242) == one(1) == 1 and one(243) == one(2) == 2
    assert by[None] == {8, 246}  # without an id: a copy of 8, and a null text among the empty ones
    assert one(246) == one(247) == 246
    assert len({one(i) for i in range(240)}) == 240


@pytest.mark.parametrize("name", oracle_sql())
def test_query_equals_its_sql(spark, small, name):
    db = duckdb.connect()
    for table in ("documents", "labels", "benchmark", "embeddings"):
        db.execute(f"create view {table} as select * from read_parquet('{small}/{table}.parquet/*.parquet')")
    found = db.execute(oracle_sql()[name])
    columns = [c[0] for c in found.description]
    out = queries()[name](spark, small)
    assert sorted(columns) == sorted(out.columns)
    assert Counter(tuple(r) for r in rows(out.select(columns))) == Counter(map(tuple, found.fetchall()))


def test_pipeline(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    reached = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small)
        assert docs.columns == spark.read.parquet(f"{small}/documents.parquet").columns
        docs = corpus_pipeline.written(docs, name)
        reached[name] = ids(rows(docs))
    good = {i for i in range(240) if i % 8 != 3}
    junk = set(range(240)) - good
    assert not junk & set(reached["quality_model"]) and len(good & set(reached["quality_model"])) >= 0.95 * len(good)
    assert all(n == 1 for n in reached["near_dedup"].values()) and not {240, 241, 242, 243} & set(reached["near_dedup"])
    assert set(reached["near_dedup"]) - set(reached["decontamination"]) <= {244, 245}
    assert not {244, 245} & set(reached["decontamination"])
    out = rows(corpus_pipeline.run(spark, small))
    assert ids(out) == reached["decontamination"]
    text = {d[0]: d[1] for d in DOCS}
    assert all(r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest() and r.n_tokens == len(r.ids) for r in out)
