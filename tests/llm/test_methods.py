"""Every method against a brute-force form of itself, without Spark where it needs none."""

from __future__ import annotations

import base64
import hashlib
import math
from collections import Counter
import random
import re
import tracemalloc
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from ledgerlens.llm import bpe, decontam, langid, minhash, quality_model, quality_rules, toxicity, wordpiece
from ledgerlens.llm import text as X
from ledgerlens.llm.sharding import jump, shard


# ---------------------------------------------------------------- words and hashes

def test_words_never_span_rows():
    rows = ["ab c", None, "", "d", "", "", "ef  g", " h", "i "]
    w = X.words(pa.array(rows))
    assert [(int(d), x.decode()) for d, x in zip(w.doc, w.take(np.arange(len(w.doc))), strict=True)] == [
        (i, x) for i, t in enumerate(rows) for x in (t or "").split()]
    assert w.per_doc.tolist() == [len((t or "").split()) for t in rows]
    sliced = pa.array(["skip me", *rows]).slice(1)
    assert (X.hash_words(X.words(sliced)) == X.hash_words(w)).all()


def test_hashes_depend_on_the_bytes_alone():
    a, b = X.words(pa.array(["one two", "two three " * 50])), X.words(pa.array(["three", "one  two"]))
    ha, hb = X.hash_words(a), X.hash_words(b)
    assert (ha[0], ha[1], ha[3]) == (hb[1], hb[2], hb[0]) and len(set(ha.tolist())) == 3
    many = X.hash_words(X.words(pa.array([" ".join(f"w{i}" for i in range(200_000))])))
    assert len(set(many.tolist())) == 200_000


def test_ranges_are_hashed_and_taken_in_runs(monkeypatch):
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 1 << 21).astype(np.uint8)
    bounds = np.unique(np.append(rng.integers(0, len(data), len(data) // 5), [0, len(data)]))
    start, end = np.append(bounds[:-1], 7), np.append(bounds[1:], 7)  # the last one is empty
    tracemalloc.start()
    hashes = X.hash_ranges(data, start, end)
    taken = X.take_ranges(data, start, end - start)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24 << 20
    assert (taken == data).all() and not len(X.take_ranges(data, start[:0], start[:0]))
    monkeypatch.setattr(X, "WIDE", 1 << 30)
    assert (hashes == X.hash_ranges(data, start, end)).all()
    monkeypatch.setattr(X, "WIDE", 3)
    assert (hashes[-200:] == X.hash_ranges(data, start[-200:], end[-200:])).all()


def test_stages_lower_the_rows_of_a_batch(spark):
    import corpus_pipeline

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    docs = spark.createDataFrame([(1, "a text", "en", "web")], "doc_id long, text string, lang string, source string")
    try:
        for given, want in ((10_000, corpus_pipeline.BATCH_ROWS), (0, corpus_pipeline.BATCH_ROWS), (50, 50)):
            spark.conf.set(name, given)
            dict(corpus_pipeline.STAGES)["byte_bpe"](spark, docs, "")
            assert int(spark.conf.get(name)) == want
    finally:
        spark.conf.set(name, before)


def test_slices_cover_all_rows():
    batch = pa.record_batch({"text": ["x" * k for k in range(50)] + [None]})
    parts = list(X.slices(iter([batch, batch.slice(0, 0)]), most=100))
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch])) and len(parts) > 5


# ---------------------------------------------------------------- 1 near-dedup

def _texts(rng: random.Random, n: int, edits: int) -> list[str]:
    base = [f"w{rng.randrange(400)}" for _ in range(n)]
    other = list(base)
    for _ in range(edits):
        other[rng.randrange(n)] = f"v{rng.randrange(9999)}"
    return [" ".join(base), " ".join(other)]


def _weighted(text: str, codes: np.ndarray) -> dict[int, float]:
    _, s, c, _ = minhash._shingles(pa.array([text]))
    return dict(zip(s.tolist(), minhash._weights(s, c, codes).tolist(), strict=True))


def _jaccard(a: dict, b: dict) -> float:
    keys = a.keys() | b.keys()
    return sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / sum(max(a.get(k, 0), b.get(k, 0)) for k in keys)


@pytest.fixture(scope="module")
def codes() -> np.ndarray:
    cells = np.random.default_rng(1).integers(0, 900, (minhash.SKETCH_ROWS, 1 << minhash.SKETCH_BITS))
    return minhash.idf_codes(cells, 1000)


def test_exact_similarity_is_the_weighted_jaccard(codes):
    rng = random.Random(2)
    pairs = [_texts(rng, rng.choice([3, 6, 40, 300]), rng.choice([0, 1, 5])) for _ in range(60)] + [["", "a"], ["a b", "a b"], ["", ""]]
    left, right = [p[0] for p in pairs], [p[1] for p in pairs]
    got = minhash._similar(pa.array(left), pa.array([x.encode() for x in right], pa.binary()).dictionary_encode(), pa.array(right), codes)
    want = [_jaccard(a, b) if (a := _weighted(x, codes)) and (b := _weighted(y, codes)) else 0 for x, y in pairs]
    assert np.allclose(got, want)


def test_samples_agree_as_often_as_texts_are_similar(codes):
    rng = random.Random(3)
    pairs = [_texts(rng, 200, e) for e in (1, 3, 8, 20) for _ in range(60)]
    flat = [t for p in pairs for t in p]
    row, s, c, n = minhash._shingles(pa.array(flat))
    _, sig = minhash._signatures(row, s, minhash._weights(s, c, codes), n)
    agree = (sig[0::2] == sig[1::2]).mean(1)
    true = np.array([_jaccard(_weighted(a, codes), _weighted(b, codes)) for a, b in pairs])
    assert abs((agree - true).reshape(4, 60).mean(1)).max() < 0.03


def test_idf_falls_with_frequency():
    c = minhash.idf_codes(np.array([[1, 4, 100, 500, 1000]]), 1000)[0].tolist()
    assert c == sorted(c, reverse=True) and c[0] == 255 and c[-1] == 0


def test_groups_of_variants_and_chains(spark):
    rng = random.Random(4)
    docs, want = [], {}
    for g in range(6):  # an original and variants that resemble it more than one another
        base = [f"w{rng.randrange(3000)}" for _ in range(160)]
        for k in range(25):
            t = list(base)
            if k:
                for _ in range(2):
                    t[rng.randrange(160)] = f"v{rng.randrange(9999)}"
            docs.append((100 * g + k, " ".join(t)))
            want[100 * g + k] = 100 * g
    docs += [(9000 + i, " ".join(f"z{rng.randrange(5000)}" for _ in range(100))) for i in range(100)]
    want |= {9000 + i: 9000 + i for i in range(100)}
    frame = spark.createDataFrame(rng.sample(docs, len(docs)), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in minhash.classes(frame).collect()} == want


def test_twins_within_a_templated_family(spark):
    rng = random.Random(6)
    base = [f"w{rng.randrange(9999)}" for _ in range(400)]
    edit = lambda t, places, tag: [f"{tag}{i}" if i in places else x for i, x in enumerate(t)]
    docs = []
    for g in range(60):  # families of one template at about 0.75, of twins at 0.8 and more
        one = edit(base, {*rng.sample(range(400), 6)}, f"a{g}x")
        docs += [(2 * g, " ".join(one)), (2 * g + 1, " ".join(edit(one, {*rng.sample(range(400), 7)}, f"b{g}x")))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in minhash.classes(frame).collect()}
    seen = minhash.idf_codes(*minhash.sketch(frame))
    weights = [_weighted(t, seen) for _, t in docs]
    want = list(range(120))
    for i in range(120):  # brute force; classes are named by their least member
        for j in range(i):
            if _jaccard(weights[i], weights[j]) >= minhash.SIMILAR:
                want = [min(want[i], want[j]) if x in (want[i], want[j]) else x for x in want]
    assert len(set(want)) > 50 and want[1::2] == want[::2]
    assert found == dict(enumerate(want))


def test_stage_keeps_one_row_of_every_class(spark, tmp_path):
    text = [" ".join(f"{c}{i}" for i in range(30)) for c in "abcd"]
    docs = [(None, text[0], 1), (None, text[1], 2), (None, text[1], 3), (7, text[2], 4), (7, text[2], 5), (5, text[2], 6), (None, text[3], 7), (9, text[3], 8)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, _of int")
    kept = minhash.stage(spark, frame, str(tmp_path))
    assert kept.columns == frame.columns
    assert sorted((r.doc_id or 0, r.text[0]) for r in kept.collect()) == [(0, "a"), (0, "b"), (5, "c"), (9, "d")]


@pytest.mark.parametrize("seed, nodes, first, later", [(1, 60, 30, 20), (2, 40, 5, 40), (3, 30, 40, 0), (4, 30, 0, 25)])
def test_merged_labels_equal_the_components_of_all_links(spark, seed, nodes, first, later):
    rng = random.Random(seed)
    links = [tuple(sorted(rng.sample(range(nodes), 2))) for _ in range(first + later)]
    frame = lambda x: spark.createDataFrame([(b"%03d" % a, b"%03d" % b) for a, b in x], "key binary, leader binary")
    named = lambda df: {bytes(r.key): bytes(r.label) for r in df.collect()}
    after = named(minhash.merged(minhash.components(frame(links[:first])), frame(links[first:])))
    assert after == named(minhash.components(frame(links)))
    group = {i: {i} for i in range(nodes)}
    for a, b in links:
        whole = group[a] | group[b]
        group.update(dict.fromkeys(whole, whole))
    assert after == {b"%03d" % i: b"%03d" % min(g) for i, g in group.items() if len(g) > 1}


def test_components_of_long_chains(spark):
    key = lambda i: i.to_bytes(4, "big")
    edges = [(key(i), key(i + 1)) for i in range(60)] + [(key(100), key(200)), (key(300), key(200))]
    found = minhash.components(spark.createDataFrame(edges, "key binary, leader binary")).collect()
    assert {bytes(r.key): bytes(r.label) for r in found} == {key(i): key(0) for i in range(61)} | {key(i): key(100) for i in (100, 200, 300)}


# ---------------------------------------------------------------- 2 byte-level BPE

@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path(bpe.VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encode_equals_the_library_and_round_trips(spark, library):
    rng = random.Random(5)
    texts = [None, "", "don't I'll 'tis '' 've!", "x" * 5000, "".join(rng.choice("abcdefgh") for _ in range(2000)), "   \n\n  hi   ",
             "<|endoftext|>", "😀😀 日本語テキスト ١٢٣ ½", "\u0000a\tb\r\n c", "a\x1cb\x85c d", "=" * 700]
    texts += ["".join(rng.choice(" '\t\n　abé1２½!?😀ñß's'll") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    path = public_tokenizers.path(bpe.VOCABULARY)
    out, m = bpe.encode(docs, path, public_tokenizers.PATTERN)
    for r in bpe.decode(out.select("doc_id", f"{m}.*"), path).collect():
        t = texts[r.doc_id] or ""
        assert list(r.ids) == library.encode_ordinary(t) and bytes(r.decoded) == t.encode()
    unknown = spark.createDataFrame([(1, [10**8])], "doc_id long, ids array<int>")
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(unknown, path).collect()


def test_pieces_that_come_again_are_encoded_once(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBER", 20)
    codec = bpe.Codec(bpe.Vocabulary.read(public_tokenizers.path(bpe.VOCABULARY)))
    encoded, encode = Counter(), codec.encode
    monkeypatch.setattr(codec, "encode", lambda pieces: (encoded.update(pieces), encode(pieces))[1])
    for k in range(12):
        pieces = ["hello", "", " wörld"] + [f"odd{chr(97 + k)}{chr(97 + j)}" for j in range(9)]
        batch = pa.RecordBatch.from_arrays([pa.array([pieces, [], pieces[::-1]])], ["pieces"])
        for ids, want in zip(bpe._encode_slice(batch, codec, True).field("ids").to_pylist(), batch.column("pieces").to_pylist(), strict=True):
            assert ids == [t for x in want for t in library.encode_ordinary(x)]
        assert len(codec.known) <= 20 + len(pieces)
    assert encoded[b"hello"] == encoded[" wörld".encode()] == 1 and set(encoded.values()) == {1}
    assert codec.decode(np.zeros(0, np.int32), np.zeros(3, np.int64))[1].tolist() == [0, 0, 0]


# ---------------------------------------------------------------- 4 decontamination

def test_retrieval_finds_every_segment_over_the_threshold():
    rng = random.Random(6)
    vocab = [f"t{i}" for i in range(120)] + ["the", "of", "and"] * 40
    items = [" ".join(rng.choice(vocab) for _ in range(rng.randint(3, 60))) for _ in range(70)]
    index = decontam.Index(decontam.segments(list(range(70)), items))
    docs = [" ".join(rng.sample(vocab, 60) + items[rng.randrange(70)].split()[: rng.randint(2, 60)]) for _ in range(40)]
    terms = {int(t): i for i, t in enumerate(index.terms)}
    full = np.zeros((len(index.terms), len(index.segments)))
    for t in range(len(index.terms)):
        if index.row[t] >= 0:
            full[t] = index.dense[index.row[t]]
        for k in range(index.first[t], index.first[t] + index.held[t]):
            full[t, index.posting_seg[k]] = index.posting_weight[k]
    assert np.allclose(full.sum(0), 1, atol=1e-5)
    window, term, want = [], [], set()
    for w, d in enumerate(docs):
        own = sorted({terms[int(h)] for h in X.hash_words(X.words(pa.array([d]), X.NON_ALNUM)) if int(h) in terms})
        window += [w] * len(own)
        term += own
        want |= {(w, s) for s, x in enumerate(full[own].sum(0)) if x >= decontam.SCORE}
    of, seg, score = index.retrieve(np.array(window), np.array(term))
    assert set(zip(of.tolist(), seg.tolist(), strict=True)) == want and want
    assert np.allclose(score, [full[[t for w, t in zip(window, term, strict=True) if w == o], s].sum() for o, s in zip(of, seg, strict=True)], atol=1e-5)


def test_items_of_many_segments_and_shared_words_alone(spark):
    rng = random.Random(7)
    long_item = " ".join(f"q{rng.randrange(900)}" for _ in range(200)) + "."
    items = spark.createDataFrame([(1, long_item), (2, "what is the name of the river? the blue nile.")], "item_id long, text string")
    noise = " ".join(f"n{rng.randrange(900)}" for _ in range(300))
    docs = spark.createDataFrame([(10, f"{noise} {long_item}"), (11, f"{noise} What is the name of the river?  The Blue Nile!"),
                                  (12, f"{noise} what is the name of the river? no idea"), (13, "the river is blue, the name of the nile is what")],
                                 "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontam.leaks(docs, items).collect()} == {(10, 1), (11, 2)}


def test_the_rest_of_a_long_item_does_not_match_alone(spark):
    rng = random.Random(8)
    item = {n: " ".join(f"q{n}x{rng.randrange(900)}" for _ in range(n - k)) + " river" * (k > 0) + " name" * (k > 1) + "."
            for n, k in ((64, 1), (65, 1), (66, 2), (130, 2))}
    items = spark.createDataFrame(list(item.items()), "item_id long, text string")
    noise = lambda: " ".join(f"n{rng.randrange(900)}" for _ in range(rng.randint(40, 200)))
    clean = [(i, f"{noise()} the name of the river {noise()}") for i in range(20)]
    half = [(100 + n, f"{noise()} {' '.join(t.split()[: n // 2])} {noise()}") for n, t in item.items()]
    full = [(200 + n, f"{noise()} {t} {noise()}") for n, t in item.items()]
    docs = spark.createDataFrame(clean + half + full, "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontam.leaks(docs, items).collect()} == {(200 + n, n) for n in item}


# ---------------------------------------------------------------- 5, 6, 9 models

def test_unseen_words_fall_back_to_the_longest_known_ngrams():
    words = X.words(pa.array(["garten straße", "garden street"]), X.NON_LETTERS)
    h = X.hash_words(words)
    lang, n = words.doc.astype(int), np.ones(4)
    by = {}
    for size in langid.GRAMS:
        owner, gram = langid.grams(words, np.arange(4), size)
        by[size] = langid.Table.build(gram, lang[owner], n[owner], 2)
    model = langid.Model(["de", "en"], np.log([0.6, 0.4]), langid.Table.build(h, lang, n, 2), by)
    assert model.predict(pa.array(["gartens", "streets of", "garten", "日本", ""]))[0] == ["de", "en", "de", "de", "de"]


def test_features_of_a_word_and_of_repeats():
    w = X.words(pa.array(["ab ab ab", "x y"]))
    h = X.hash_words(w)
    word, _ = quality_model.word_features(w, np.array([0]), h[:1])
    assert len(word) == 1 + 2 + 1  # the word, <ab ab> and <ab>
    at, bucket = quality_model.pair_features(h, w.doc)
    assert at.tolist() == [0, 1, 3] and bucket[0] == bucket[1] != bucket[2]


def _spelled(text: str) -> list[list[tuple]]:
    """Per word the (history, symbol) pairs: up to ORDER bytes before, padded at the word's start, and the next byte or the end."""
    out = []
    for word in re.findall(rb"(?:[a-z]|[\x80-\xff])+", text.encode().lower()):
        padded = [None] * toxicity.ORDER + list(word)
        out.append([(tuple(padded[i: i + toxicity.ORDER]), word[i] if i < len(word) else "end") for i in range(len(word) + 1)])
    return out


def test_kneser_ney_equals_dictionaries():
    rng = random.Random(3)
    stems = ["ach", "lich", "vor", "über", "tan", "é"]
    made = lambda extra, n: [" ".join(rng.choice(stems + extra) + rng.choice(stems) for _ in range(12)) for _ in range(n)]
    texts = {"toxic": made(["BOCO", "boco", "réu"], 9), "ordinary": made(["sol", "mar"], 14)}
    n = {c: Counter(x for t in ts for w in _spelled(t) for x in w) for c, ts in texts.items()}
    grams = set(n["toxic"]) | set(n["ordinary"])
    shorter = Counter((h[1:], x) for h, x in grams)
    d, mass = toxicity.DISCOUNT, toxicity.MASS

    def shared(h, x):
        after = {y: k for (g, y), k in shorter.items() if g == h[1:]}
        return (max(after.get(x, 0) - d, 0) + d * len(after) / toxicity.ALPHABET) / sum(after.values())

    def chance(c, h, x):
        after = {y: k for (g, y), k in n[c].items() if g == h}
        given = (d * len(after) + mass) / (sum(after.values()) + mass)
        if (h, x) not in grams:
            return given  # both classes hand on to the same shared estimate
        return max(after.get(x, 0) - d, 0) / (sum(after.values()) + mass) + given * shared(h, x)

    def compared(text):
        words = [sum(math.log(chance("toxic", h, x) / chance("ordinary", h, x)) for h, x in w if any(g == h for g, _ in grams)) for w in _spelled(text)]
        return [sum(words) / max(len(words), 1), sum(max(x - toxicity.EXCESS, 0) for x in words) / max(len(words), 1)]

    s = toxicity.spelling(pa.array(texts["toxic"] + texts["ordinary"]))
    frame = pd.DataFrame({k: getattr(s, k) for k in toxicity._KEYS})
    toxic = s.words.doc[s.word] < 9
    model = toxicity.train(frame.assign(toxic=toxic.astype(int), ordinary=(~toxic).astype(int)).groupby(toxicity._KEYS, as_index=False).sum())
    tried = [*texts["toxic"][:3], *texts["ordinary"][:3], "bocotan Bocolich", "unseen words überall", "", "12 !", "é", None]
    want = np.array([compared(t or "") for t in tried])
    assert np.allclose(model.differences(pa.array(tried, pa.string())), want, atol=1e-9)
    assert want[6, 1] > 0 and (want[8:10] == 0).all()
    # a history's shared estimates, discounted mass included, are probabilities
    for h in list({h for h, _ in grams})[:20]:
        assert sum(shared(h, x) for g, x in grams if g[1:] == h[1:] and g == h) <= 1 + 1e-9
    assert toxicity.train(frame.iloc[:0].assign(toxic=0, ordinary=0)).score(pa.array(["x"])).tolist() == [0.5]


def test_toxicity_counts_all_labelled_documents(spark):
    rng = random.Random(4)
    made = lambda stems, n: [" ".join(rng.choice(stems) + rng.choice(["", "tan", "lich", "al"]) for _ in range(30)) for _ in range(n)]
    texts = made(["boco", "réu"], 12) + [f"{t} {'abcdefghij'[k // 10]}{'klmnopqrst'[k % 10]}own" for k, t in enumerate(made(["sol", "mar"], 90))]
    y = [1] * 12 + [0] * 90
    docs = spark.createDataFrame([*enumerate([*texts, "bocolich marown", "", None]), (None, "sol")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, x) for i, x in enumerate(y)], "doc_id long, toxic int")
    learned = [i for i in range(len(y)) if zlib.crc32(str(i).encode()) % 3 != 1]
    assert sum(1 - y[i] for i in learned) > 3 * sum(y[i] for i in learned)  # more than a sample of three to one had
    s = toxicity.spelling(pa.array([texts[i] for i in learned]))
    frame, label = pd.DataFrame({k: getattr(s, k) for k in toxicity._KEYS}), np.array([y[i] for i in learned])[s.words.doc[s.word]]
    want = toxicity.train(frame.assign(toxic=label, ordinary=1 - label).groupby(toxicity._KEYS, as_index=False).sum())
    model = toxicity.fit(docs, labels)
    for table, keys, numbers in ((model.grams, want.gram, want.gram_llr), (model.histories, want.history, want.history_llr)):
        found = table.toPandas()
        found, own = found[found.columns[0]].to_numpy().view(np.uint64), found[toxicity._NUMBERS[-1]].to_numpy()
        order = np.argsort(found)
        assert (found[order] == keys).all() and np.allclose(own[order], numbers)
    want.slope, want.bias = model.slope, model.bias
    for frequent in (toxicity.FREQUENT, 20, 0):  # what is sent to the workers changes no score
        other = toxicity.fit(docs, labels, frequent)
        assert np.allclose(other.slope, model.slope) and np.isclose(other.bias, model.bias)
        got = toxicity.score(docs, model, frequent=frequent).collect()
        assert len(got) == 106
        assert np.allclose([r.score for r in got], want.score(pa.array([r.text for r in got], pa.string())))


def test_seventy_languages_are_all_learned_beside_a_large_one(spark):
    rng = random.Random(12)
    letters = "abcdefghijklmnopqrstuvwxyz"
    own = {f"l{k:02d}": ["".join(rng.choice(letters) for _ in range(rng.randint(4, 9))) for _ in range(40)] for k in range(70)}
    docs = [(len(own) * 12 * 9 + i, " ".join("".join(rng.choice(letters) for _ in range(6)) for _ in range(40)), "big") for i in range(900)]
    docs += [(100 * k + j, " ".join(rng.choice(ws) for _ in range(30)), lang) for k, (lang, ws) in enumerate(own.items()) for j in range(12)]
    docs += [(None, "word of nobody", "none")] * 50
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = langid.fit(frame)
    assert model.langs == sorted([*own, "big"])
    seen = frame.filter("doc_id is not null").toPandas()
    found, score = model.predict(pa.array(seen.text))
    right = (np.array(found) == seen.lang.to_numpy())
    assert right[(seen.lang != "big").to_numpy()].mean() > 0.98 and set(found) >= set(own)


def test_word_first_backoff_equals_dictionaries(spark):
    """A word's evidence: its own smoothed log frequency, else the mean over its longest known n-grams."""
    docs = [(3 * i, t, lang) for i, (t, lang) in enumerate([("der garten der", "de"), ("the garden", "en"), ("den garten", "de"), ("then gardens", "en")] * 3)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = langid.fit(frame)
    train = [(t, lang) for i, t, lang in docs if zlib.crc32(str(i).encode()) % 3 != 1]
    count = Counter((w, lang) for t, lang in train for w in t.split())
    parts = lambda w, n: [f"<{w}>"[i: i + n] for i in range(len(w) + 3 - n)] if n > 1 else list(w)
    tables = [count]
    for n in langid.GRAMS:
        tables.append(Counter())
        for (w, lang), c in count.items():
            for g in parts(w, n):
                tables[-1][g, lang] += c

    def log(table, key):
        keys = {k for k, _ in table}
        return [math.log((table[key, x] + 0.1) / (sum(c for (_, y), c in table.items() if y == x) + 0.1 * len(keys))) for x in model.langs]

    tried = ["garten", "gartens", "the", "xyz", "9d", "q"]
    w = X.words(pa.array(tried), X.BLANKS)
    got = model.evidence(w, np.arange(len(tried)), X.hash_words(w))
    for word, row in zip(tried, got, strict=True):
        want = [0.0] * len(model.langs)
        if any(k == word for k, _ in count):
            want = log(count, word)
        else:
            for n, table in zip(langid.GRAMS, tables[1:], strict=True):
                known = [g for g in parts(word, n) if any(k == g for k, _ in table)]
                if known:
                    want = np.mean([log(table, g) for g in known], 0)
                    break
        assert np.allclose(row, want, atol=1e-5), word


# ---------------------------------------------------------------- 7 token counts

def _greedy(symbols: tuple, pieces: set) -> int:
    n = i = 0
    while i < len(symbols):
        j = next((j for j in range(len(symbols), i, -1) if symbols[i:j] in pieces), None)
        if j is None:
            return 1
        i, n = j, n + 1
    return n


def test_automaton_counts_greedy_pieces():
    rng = random.Random(9)
    for _ in range(200):
        pieces = {tuple(rng.choice(b"abc") for _ in range(rng.randint(1, 5))) + ((wordpiece.END,) if rng.random() < 0.4 else ()) for _ in range(rng.randint(1, 25))}
        words = [bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 12))) for _ in range(40)]
        end = np.cumsum([len(w) for w in words])
        got = wordpiece.Automaton.build(sorted(pieces)).counts(np.frombuffer(b"".join(words), np.uint8), end - [len(w) for w in words], end)
        assert got.tolist() == [_greedy((*w, wordpiece.END), pieces) for w in words]


# ---------------------------------------------------------------- 8 sharding

def _jump(key: int, n: int) -> int:
    b, j, key = -1, 0, key % 2**64
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("n", [1, 2, 24, 25, 1000])
def test_jump_equals_the_published_loop(spark, n):
    keys = [*range(300), -1, -(2**63), 2**63 - 1, 2**40 + 7]
    rows = spark.createDataFrame([(k,) for k in keys], "k long").select("k", jump(F.col("k"), n).alias("s")).collect()
    assert all(r.s == _jump(r.k, n) for r in rows)


def test_hot_id_is_laid_out_in_chunks(spark):
    docs = spark.range(20_000).select(F.when(F.col("id") < 9000, 5).otherwise(F.col("id")).alias("doc_id"), F.lit("t").alias("text"))
    rows = shard(docs).collect()
    assert len(rows) == 20_000
    for s in range(24):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))


def test_different_texts_of_a_hot_id_do_not_fill_one_window(spark):
    ids = [None if i % 3 == 0 else 5 if i % 3 == 1 else i for i in range(6000)]
    docs = spark.createDataFrame([(d, f"text {i % 5000}") for i, d in enumerate(ids)], "doc_id long, text string")
    found = shard(docs)
    by_checksum = [x for x in re.findall(r"windowspecdefinition\((.*?)specifiedwindowframe", found._jdf.queryExecution().optimizedPlan().toString())
                   if "text_crc32" in x]
    assert by_checksum and not any(re.search(r"doc_id#\w+ ASC", x) for x in by_checksum)  # an id's rows are never one window's
    rows = found.collect()
    block = lambda r: hashlib.md5(str("" if r.doc_id is None else r.doc_id).encode()).hexdigest()[:3]
    for s in {r.shard for r in rows}:  # brute force: one sort of the whole shard
        own = sorted((r for r in rows if r.shard == s), key=lambda r: (block(r), r.doc_id is not None, r.doc_id or 0, r.text_crc32, r.size))
        assert [r.slot for r in sorted(own, key=lambda r: r.slot)] == list(range(len(own)))
        assert [(r.doc_id, r.text_crc32, r.size) for r in sorted(own, key=lambda r: r.slot)] == [(r.doc_id, r.text_crc32, r.size) for r in own]


# ---------------------------------------------------------------- 10 quality rules

def test_binomial_tail_is_exact():
    for n, k, p in ((10, 3, 0.2), (400, 0, 0.005), (400, 5, 0.005), (3, 3, 0.5)):
        want = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert math.isclose(quality_rules.at_most(n, k, p), want, rel_tol=1e-9)


def _judged(spark, groups):
    """(documents, labels): per (language, n, labelled bad-looking good ones) n documents of plain words, labelled good; languages in capitals have no labels."""
    docs, labels, i = [], [], 0
    for lang, n, bad in groups:
        for k in range(n):
            text = " ".join(["word"] * 3 + [f"w{i}x{j}" for j in range(30)]) + (" ### ### ###" if k < bad else "")
            docs.append((i, text, lang))
            if lang is None or lang.islower():
                labels.append((i, 1, 0))
            i += 1
    docs += [(i, "word " * 2 + " ".join(f"w{j}" for j in range(30)) + "".join(f" #{j}##" for j in range(20)), lang) for i, lang in enumerate([g[0] for g in groups], 10**6)]
    return spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_cutoffs_need_proof(spark):
    of = lambda *groups: quality_rules.cutoffs(*quality_rules.measured(_judged(spark, groups)[0]), _judged(spark, groups)[1])
    few, many, rejecting = (of(("en", n, bad))["en"] for n, bad in ((60, 0), (1200, 0), (1200, 60)))
    assert few == quality_rules.Certified("none", None, {})
    assert (many.guarantee, many.risk, many.cutoffs["symbols"]) == ("own", 0.005, 5)  # nobody is rejected by the sharpest cutoff
    assert rejecting.cutoffs["symbols"] == 35  # 5 % would be by any below, however few by those beyond


def test_strata_have_guarantees_of_their_own_or_of_a_pool(spark, tmp_path):
    import duckdb

    groups = (("de", 420, 0), ("fr", 70, 0), ("es", 60, 0), (None, 20, 0), ("SW", 300, 0))
    docs, labels = _judged(spark, groups)
    chosen = quality_rules.cutoffs(*quality_rules.measured(docs), labels)
    assert {k: (v.guarantee, v.risk) for k, v in chosen.items()} == {
        "de": ("own", 0.02), "fr": ("pool", 0.05), "es": ("pool", 0.05), quality_rules.OTHER: ("pool", 0.05)}
    assert all(v.cutoffs["symbols"] == 5 for v in chosen.values())
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    found = quality_rules.quality_rules(spark, str(tmp_path))
    rows = {r.doc_id: r for r in found.collect()}
    assert [(rows[10**6 + k].kept, rows[10**6 + k].guarantee) for k in range(5)] == [(False, "own"), *[(False, "pool")] * 3, (True, "none")]
    assert sum(r.kept for r in rows.values()) == 871
    db = duckdb.connect()
    for t in ("documents", "labels"):
        db.execute(f"create view {t} as select * from read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    out = db.execute(quality_rules.SQL)
    columns = [c[0] for c in out.description]
    assert Counter(map(tuple, out.fetchall())) == Counter(map(tuple, found.select(columns).collect()))
