"""Stupid-backoff scores against a dictionary form, whatever share of the words is known to every worker."""

from __future__ import annotations

import math
import re
from collections import Counter

import pytest

from ledgerlens.llm import lm
from tests.llm.conftest import corpus

DOCS, _, _ = corpus()
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _by_dictionary(texts: list[str | None]) -> list[tuple[int, int, float | None]]:
    """(words, seen, sum of logarithms) of every text."""
    split = [WORD.findall(t or "") for t in texts]
    one, two = Counter(), Counter()
    for words in split:
        one.update([None, *words] if words else [])
        two.update(zip([None, *words], words, strict=False))
    total = sum(n for w, n in one.items() if w is not None)
    out = []
    for words in split:
        pairs = list(zip([None, *words], words, strict=False))
        seen = [two[p] >= lm.SEEN for p in pairs]
        logs = [math.log(two[p] / one[p[0]]) if s else math.log(lm.BACKOFF * one[p[1]] / total) for p, s in zip(pairs, seen, strict=True)]
        out.append((len(words), sum(seen), sum(logs) if words else None))
    return out


def _found(spark, texts: list[str | None], frequent: int) -> dict:
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return {r.doc_id: (r.n_words, r.n_seen, r.log_score, r.mean_score) for r in lm.scores(df, frequent).collect()}


def _same(found: dict, want: list) -> None:
    assert len(found) == len(want)
    for i, (words, seen, score) in enumerate(want):
        assert found[i][:2] == (words, seen)
        if score is None:
            assert found[i][2:] == (None, None)
        else:
            assert found[i][2] == pytest.approx(score, abs=1e-6) and found[i][3] == pytest.approx(score / words, abs=1e-9)


@pytest.mark.parametrize("frequent", [1, 12, 200, lm.FREQUENT])
def test_equal_to_a_dictionary_form(spark, small, frequent):
    """With 1 or 12 nearly all words are rare: in one place, in both, twice in a row, at either end of a text."""
    texts = [d[1] for d in DOCS] + ["odd odd odd odd", "odd", "", None, "odd pair", "odd pair the", "the odd", "solo", "odd\todd  solo"]
    _same(_found(spark, texts, frequent), _by_dictionary(texts))


def test_unrelated_text_changes_no_seen_pair(spark, small):
    """Ten times as much of other text: what was seen scores as before, what was not moves by the corpus's size alone."""
    part = ["red fox red fox jumps", "a red fox jumps over", "one lone word"]
    more = [" ".join(f"w{(i * 7 + k) % 50}" for k in range(60)) for i in range(20)]
    found = _found(spark, part + more, 8)
    _same(found, _by_dictionary(part + more))
    alone = _by_dictionary(part)
    total = sum(len(WORD.findall(t)) for t in part)
    grown = total + 60 * 20
    for i, (words, seen, score) in enumerate(alone):
        drift = (words - seen) * math.log(total / grown)
        begun = sum(1 for _ in part) / (len(part) + len(more))  # the mark's count grew with the documents
        first_seen = Counter(WORD.findall(t)[0] for t in part)[WORD.findall(part[i])[0]] >= lm.SEEN
        assert found[i][2] == pytest.approx(score + drift + (math.log(begun) if first_seen else 0.0), abs=1e-6)
