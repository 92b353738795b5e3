"""The filter audit against filters that really run in all 120 orders."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np

from ledgerlens.llm import filter_audit as A
from tests.llm.conftest import corpus, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def failed(text: str, copy: bool) -> set[str]:
    words = WORD.findall(text)
    return {f for f, bad in (("A", len(words) < 200), ("B", 100 * len(set(words)) < 50 * len(words)),
                             ("C", 100 * len(re.findall("[A-Z]", text)) > 3 * len(text)), ("D", bool(re.search(r"[#$%&*|]", text))), ("E", copy)) if bad}


def brute(docs: list, labels: list) -> Counter:
    least: dict = {}
    for i, t, *_ in docs:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    good = {i for i, q, *_ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t, *_ in labels if t == 1 and i is not None}
    parts = defaultdict(list)
    for i, t, lang, *_ in docs:
        parts[lang or ""].append((i, failed(t or "", i is not None and least[t or ""] < i)))
    rows, shapley = [], Counter()
    for part, members in parts.items():
        for order in permutations("ABCDE"):
            alive = members
            for step, f in enumerate(order, 1):
                gone = [m for m in alive if f in m[1]]
                alive = [m for m in alive if f not in m[1]]
                fails = [m for m in members if f in m[1]]
                shapley[part, f] += len(gone)
                rows.append((part, "".join(order), step, len(alive), len(gone), len(fails) - len(gone), sum(m[1] == {f} for m in members),
                             sum(m[0] in good for m in gone), sum(m[0] in toxic for m in gone)))
    return Counter((*r, shapley[r[0], r[1][r[2] - 1]]) for r in rows)


def test_audit_equals_running_the_filters(spark, small):
    docs, labels, _ = corpus()
    found = A.filter_audit(spark, small)
    assert found.columns == ["part", "filter_order", "step", *A.FIGURES.split()]
    want = brute(docs, labels)
    assert Counter(tuple(r) for r in found.collect()) == want
    assert {r[0] for r in want} == {"", "de", "en"}


def test_copies_null_texts_and_clashing_names(spark):
    import random

    rng = random.Random(2)
    long = prose(rng, [f"w{i}" for i in range(300)], 240)
    docs = [(5, long, "en"), (5, long, "en"), (9, long, "fr"), (2, None, ""), (3, "", None), (None, long, "en"), (None, None, None), (1, long.upper(), "en"),
            (7, "a " * 400, "fr"), (8, f"{long} #", "fr")]
    labels = [(9, 1, 0), (9, 0, 1), (5, 1, None), (None, 1, 1), (3, None, 1)]
    frame = spark.createDataFrame([(*d, "k", 1, 2, "p", 0) for d in docs],
                                  "doc_id long, text string, lang string, `key` string, failed int, n int, part string, least int")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert Counter(tuple(r) for r in A.audit(frame, marks).collect()) == brute(docs, labels)


def test_contraction_of_every_cell():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 50, (3, 2, 2, 2, 2, 2))
    made = A.contract(counts)
    at = A.STEPS.index(("CAEBD", 3))
    assert made["kept"][at] == counts[0, 0, :, 0, :, 0].sum()
    assert made["removed"][at] == counts[0, 0, :, 0, :, 1].sum()
    assert made["redundant"][at] == counts[0, ..., 1].sum() - counts[0, 0, :, 0, :, 1].sum()
    assert made["unique_fails"][at] == counts[0, 0, 0, 0, 0, 1]
    assert made["toxic_lost"][at] == counts[2, 0, :, 0, :, 1].sum()
    # every document that fails some filter is removed once in each order
    assert sum(made["removed"]) == 120 * (counts[0].sum() - counts[0, 0, 0, 0, 0, 0])
