"""Test items of every length: the operator and its SQL agree, short items leave clean documents alone."""

from __future__ import annotations

import random
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa

from ledgerlens.llm import decontam
from tests.llm.conftest import EN, prose


def _items(rng: random.Random) -> dict[int, str]:
    made = {n: " ".join(f"q{n}x{rng.randrange(500)}" for _ in range(n)) + "." for n in (6, 7, 64, 65, 66, 129, 200)}
    two_parts = {300 + n: f"{prose(rng, EN, n)}? {prose(rng, EN, 5)}. {prose(rng, EN, 2)}!" for n in (20, 90)}
    return made | two_parts | {1: "River", 2: "Yes. No", 3: "in the garden", 5: "Who wrote the winter letter?", 0: "", -1: "..."}


def _documents(rng: random.Random, items: dict[int, str]) -> tuple[list[tuple[int, str | None]], set[tuple[int, int]]]:
    noise = lambda a=40, b=200: prose(rng, EN, rng.randint(a, b))
    clean = [(i, f"{noise()} yes the river, no garden in winter: a letter wrote the who {noise()}") for i in range(30)]
    clean += [(40, "yes yes no"), (41, "no yes"), (42, "the river"), (43, "in garden the"), (44, "letter the winter wrote who"), (45, None), (46, "")]
    leaks = [(50, "river!", 1), (51, "Yes, no.", 2), (52, f"{noise()} IN the - garden {noise()}", 3),
             (53, f"{noise()} who wrote the winter letter {noise()}", 5), (54, "in the garden", 3)]
    leaks += [(1000 + n, f"{noise()} {t.upper()} {noise()}", n) for n, t in items.items() if n >= 6]
    half = [(2000 + n, f"{noise()} {' '.join(t.split()[: n // 2])} {noise()}") for n, t in items.items() if 6 <= n < 300]
    return clean + half + [x[:2] for x in leaks], {(d, i) for d, _, i in leaks}


def test_items_of_every_length_and_their_sql(spark, tmp_path):
    rng = random.Random(3)
    items = _items(rng)
    texts, want = _documents(rng, items)
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    tests = spark.createDataFrame([*items.items(), (65, items[65]), (None, items[7])], "item_id long, text string")
    found = [tuple(r) for r in decontam.leaks(docs, tests).collect()]
    assert {x[:2] for x in found if x[1] is not None} == want and {x[0] for x in found if x[1] is None} == {1007}
    db = duckdb.connect()
    for name, df in (("documents", docs), ("benchmark", tests)):
        df.write.parquet(f"{tmp_path}/{name}")
        db.execute(f"create view {name} as select * from read_parquet('{tmp_path}/{name}/*.parquet')")
    rounded = lambda rows: Counter((*r[:3], *(round(x, 6) for x in r[3:])) for r in rows)
    assert rounded(db.execute(decontam.SQL).fetchall()) == rounded(found)


def test_an_index_stays_small_with_rare_shared_words():
    """Words that a few items share are postings; dense rows do not grow with the items."""
    def dense(n: int) -> tuple[int, int]:
        rng = np.random.default_rng(n)
        items = [" ".join(f"w{w}" for w in rng.zipf(1.3, 40) % 50_000) for _ in range(n)]
        index = decontam.Index(decontam.segments(list(range(n)), items))
        assert {s.item for s in index.segments} == set(range(n))
        hits = index.leaks(pa.array([items[7], items[n - 1]]))
        assert {(row, item) for row, item, *_ in hits} >= {(0, 7), (1, n - 1)}
        return len(index.dense), index.dense.nbytes

    (few, _), (many, size) = dense(400), dense(3200)
    assert many <= few + 20 <= decontam.DENSE * decontam.SEGMENT and size < 30 << 20
