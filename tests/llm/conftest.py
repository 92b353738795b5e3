"""Small corpora with every oddity that the operators define a result for."""

from __future__ import annotations

import random
import zlib

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, shard int, label string"
LABELS = "doc_id long, quality int, toxic int, text string"
ITEMS = "item_id long, text string, doc_id long"
VECTORS = "vec_id long, embedding array<float>, label int"

EN = "the of and to in with that for was this from river stone market garden winter letter".split()
DE = "der die und den von mit ist nicht schloss garten winter brief straße über mädchen".split()
BAD = ["idiot", "clown"]


def prose(rng: random.Random, words: list[str], n: int) -> str:
    return " ".join(rng.choice(words) + rng.choice(["", "", "er", "ly", "ing", "ta", "on"]) for _ in range(n))


def corpus(seed: int = 5) -> tuple[list, list, list]:
    """(documents, labels, items): good and junk, clean and toxic, two languages, copies, leaks and odd rows."""
    rng = random.Random(seed)
    docs, labels = [], []
    items = [(i, f"{prose(rng, EN, 20)}. {prose(rng, EN, 12)}.", None) for i in range(6)] + [(7, None, 1), (None, "", 2), (0, None, 3)]
    for i in range(240):
        lang = ("en", "de")[i % 2]
        words = prose(rng, EN if lang == "en" else DE, rng.randint(30, 90)).split()
        quality, toxic = int(i % 8 != 3), int(i % 5 == 0)
        if toxic:
            for _ in range(max(2, len(words) // 20)):
                words[rng.randrange(len(words))] = rng.choice(BAD)
        if not quality:
            words = [f"{w}{rng.choice(['%%%', '$$$', '***'])}" for w in words]
        docs.append((i, " ".join(words), lang, f"src{i % 3}", len(words), 0.5, 1, "x"))
        labels.append((i, quality, toxic, None))
    for k, i in enumerate((240, 241, 242)):  # near copies of document 1, one word changed
        words = docs[1][1].split() * 1
        words[3 + k] = "changed"
        docs.append((i, " ".join(words), "de", "src0", 0, None, None, None))
    docs.append((243, docs[2][1], None, None, None, None, None, None))  # an exact copy
    docs.append((244, f"{prose(rng, EN, 40)} {items[2][1]} {prose(rng, EN, 40)}", "en", None, None, None, None, None))  # a leak
    docs.append((245, f"{prose(rng, DE, 150)} {items[3][1].upper().replace(' ', '!! ')}", "de", None, None, None, None, None))
    odd = [None, "", " \n\t ", "x", "12 34 !!", "日本語 テキスト", "a" * 3000, prose(rng, EN, 20_000), "\n".join(["same line here"] * 20)]
    docs += [(246 + k, t, None, "odd", None, None, None, None) for k, t in enumerate(odd)]
    docs += [docs[7], docs[7], (None, docs[8][1], "en", None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    labels += [(3, 1, 0, None), (3, 0, 0, None), (None, 1, 1, None), (9_999, 1, 1, None), (5, None, None, None)]
    return docs, labels, items


@pytest.fixture(scope="session")
def small(spark, tmp_path_factory) -> str:
    """A folder with the small corpus as Parquet."""
    folder = tmp_path_factory.mktemp("corpus")
    docs, labels, items = corpus()
    vectors = [(i, [((i * 7 + k * k) % 23) / 11 - 1 for k in range(64)], 0) for i in range(60)] + [(None, [0.5] * 64, 1), (70, None, 1)]
    for name, rows, schema in (("documents", docs, DOCS), ("labels", labels, LABELS), ("benchmark", items, ITEMS), ("embeddings", vectors, VECTORS)):
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def nothing(spark, tmp_path_factory) -> str:
    """A folder with empty tables."""
    folder = tmp_path_factory.mktemp("empty")
    for name, schema in (("documents", DOCS), ("labels", LABELS), ("benchmark", ITEMS), ("embeddings", VECTORS)):
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def fold(doc_id: int | None, folds: int) -> int | None:
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % folds
