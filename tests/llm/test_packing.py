"""Packing: tokens by the library, gapless sequences, and few of them."""

from __future__ import annotations

import base64
import json
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlens.llm import packing as P
from tests.llm.conftest import corpus

SPEC = open(public_tokenizers.path(P.TOKENIZER), encoding="utf-8").read()


def check(rows: list, capacity: int) -> int:
    """Every sequence is gapless from 0 and within capacity; the number of sequences."""
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for members in by.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_pieces_equal_the_library(spark, small):
    docs, _, _ = corpus()
    library = Tokenizer.from_str(SPEC)
    want = Counter()
    for d in docs:
        ids = library.encode(d[1] or "", add_special_tokens=False).ids + [2]
        first = len(ids) % 1024 or 1024
        bounds = [0, *range(first, len(ids) + 1, 1024)] if len(ids) > 1024 else [0, len(ids)]
        for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            want[(d[0], k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    found = P.best_fit_packing(spark, small)
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows = found.collect()
    assert Counter(tuple(r)[:5] for r in rows) == want
    total = sum(r.length for r in rows)
    assert check(rows, 1024) <= -(-total // 1024) + 1


def fewest(lengths: list[int], capacity: int) -> int:
    """Best fit decreasing, an item at a time."""
    gaps: list[int] = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
        gaps.append((min(fits) if fits else capacity) - n)
    return len(gaps)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=120), st.sampled_from([60, 61, 64]))
def test_plan_places_every_piece_once(lengths, capacity):
    counts = Counter(lengths)
    made = P.plan(counts, capacity)
    filled = defaultdict(list)
    for length, n in counts.items():
        sequence, offset = made.place(np.full(n, length), np.arange(n))
        for s, o in zip(sequence.tolist(), offset.tolist(), strict=True):
            filled[s].append((o, length))
    assert set(filled) == set(range(made.sequences))
    for members in filled.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity and sum(3 * n > capacity for _, n in members) <= 2
    # never more than a sequence in fifty over the plain algorithm
    assert made.sequences <= fewest(lengths, capacity) + 1 + len(lengths) // 50


def test_large_pieces_alone_are_matched_best():
    # nothing but large pieces: two a sequence at most, and as many pairs as there can be
    made = P.plan({40: 10, 60: 10, 35: 3, 65: 2, 34: 1}, 100)
    assert made.sequences == 13
    assert P.plan({34: 7}, 100).sequences == 4 and P.plan({100: 5}, 100).sequences == 5 and P.plan({}, 100).sequences == 0


def test_one_length_of_many_pieces(spark):
    """A hot length is numbered by blocks of tasks; ranks have no gap and no double."""
    docs = spark.range(0, 30_000, 1, 5).selectExpr("if(id % 3 = 0, null, id) doc_id", "if(id % 50 = 0, null, 'one two three') text", "id length", "'x' nth")
    cut = P.pieces(docs, SPEC)
    found, made = P.packed(cut)
    rows = found.collect()
    assert len(rows) == 30_000 and check(rows, 1024) == made.sequences == -(-sum(r.length for r in rows) // 1024)


ODD = ["word " * 500, " lead", "a  b\n c d e'll f \u00a0 g\u2003h \x1f i \x85 j " * 60, "日本語 x y " * 400, "x" * 5000, "", " ", "it 's <|endoftext|> 's",
       "tab\t end \n", "ß'S é 1 2  3 ٣ ½ \U0001f600 \U0001f600\u200b z \u180e q"]


def test_stretches_encode_as_the_whole_text(monkeypatch):
    library = Tokenizer.from_str(SPEC)
    library.encode_special_tokens = True
    for stretch in (1 << 18, 50):
        monkeypatch.setattr(P.stretches, "__defaults__", (stretch,))
        encoder = P.Encoder(SPEC, 2)
        for texts in (ODD, [" ".join(ODD)], ["".join(f"{t} " for t in ODD)]):
            assert "".join(P.stretches(texts[0])) == texts[0]
            ids, bounds = encoder.encode(texts)
            for t, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True):
                assert ids[a:b].tolist() == library.encode(t, add_special_tokens=False).ids + [2]


def test_vocabulary_is_one_of_ranks():
    """Merges come in the order of the ids they make, which is what the quicker library goes by."""
    model = json.loads(SPEC)["model"]
    made = [model["vocab"]["".join(pair if isinstance(pair, list) else pair.split(" "))] for pair in model["merges"]]
    assert made == sorted(made) and len(set(made)) == len(made) == len(model["vocab"]) - 256
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        assert P.ranks(model["vocab"]) == {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"], max_codepoint=0x24f) | st.characters(exclude_categories=["Cs"]) | st.sampled_from(" \n\t\u00a0ab'1s.")))
def test_any_text_encodes_as_the_library_does(text):
    library = P._encoder(SPEC, 2)
    assert library.encode([text])[0].tolist() == library.library.encode(text, add_special_tokens=False).ids + [2]


def test_cuts():
    assert P.cuts(1) == [0, 1] and P.cuts(1024) == [0, 1024] and P.cuts(1025) == [0, 1, 1025] and P.cuts(2048) == [0, 1024, 2048]
