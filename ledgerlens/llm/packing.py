"""Best-fit packing of tokenized documents into sequences, by large-item matching.

A sequence has room for ``CAPACITY`` tokens.  A document is its tokens and an end token; only a longer
one is cut, into full pieces and one shorter first piece.  Pieces of one length are interchangeable, so
the packing is decided on the *counts* of the lengths, at most ``CAPACITY`` numbers, whatever the table's size:

1. Pieces above a third of the capacity go at most twice into a sequence.  From the longest down, each
   is matched with the longest other one that still fits.
2. Smaller lengths, from the longest down, go where they fit best: into the sequences of the smallest gap
   that holds them, as many as fit, or into new ones when no gap does.

Both steps work on runs of sequences with one gap, so the plan is a table of a few thousand rows: the
pieces of a length with ranks from a to b lie in the sequences from c on.  Spark does the rest: tasks
tokenize the whole texts and number their pieces by length; the numbers of a task's pieces before
are a prefix sum over small counts; the plan is looked up by length and rank.  No group is sorted
or gathered, however many pieces have one length.

Defined results: a null or empty text is the end token alone; a document whose tokens fill a sequence is
not cut; repeated rows are packed each, rows without id too; an empty table gives no row.  A special
token's string in a text is ordinary text.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm import text as X
from ledgerlens.llm.corpus import table, written

TOKENIZER = "byte_bpe_50k.json"
CAPACITY = 1024
END = 2
#: Pieces of one task and length that share a row of counts.
BLOCK = 4096
#: Characters of a text taken apart at once, as far as it has places that part tokens safely.
STRETCH = 1 << 18
#: A blank between two characters that are none begins a token's text, whatever stands farther off.
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Characters beyond Latin scripts, on whose classes the two libraries' Unicode tables might differ.
_OTHER = re.compile(r"[^\x00-\u024f]")


def ranks(vocabulary: dict[str, int]) -> dict[bytes, int]:
    """A byte-level vocabulary's tokens as bytes: printable Latin-1 stands for itself, other bytes for U+0100 and on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in own)}
    return {bytes(byte[c] for c in token): i for token, i in vocabulary.items()}


class Encoder:
    """Ids as the ``tokenizers`` library gives them for the JSON ``spec``, with an end token after every text.

    That library would need most of the time here.  Its vocabulary is one of ranks, so the quicker
    ``tiktoken`` finds the same ids; texts with other than Latin scripts go to ``tokenizers`` itself.
    """

    def __init__(self, spec: str, end: int) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        self.library.encode_special_tokens = True
        model = json.loads(spec)["model"]
        self.quick = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(model["vocab"]), special_tokens={})
        self.end = np.array([end], "<u4")

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): text i and its end token are ``ids[bounds[i]:bounds[i + 1]]``."""
        found, size = [], []
        for text in texts:
            parts = [self._ids(s) for s in stretches(text)]
            found += [*parts, self.end]
            size.append(sum(map(len, parts)) + 1)
        return np.concatenate(found).astype("<u4"), np.concatenate([[0], np.cumsum(size, dtype=np.int64)])

    def _ids(self, text: str) -> np.ndarray:
        if not text.isascii() and _OTHER.search(text):
            return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        return self.quick.encode_to_numpy(text, disallowed_special=())


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def _encoder(spec: str, end: int) -> Encoder:
    """The worker's encoder; kept while tasks ask for the same one."""
    if (spec, end) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[spec, end] = Encoder(spec, end)
    return _ENCODERS[spec, end]


def stretches(text: str, size: int = STRETCH) -> list[str]:
    """``text`` in stretches of about ``size`` characters that the tokenizer takes apart alike."""
    out, start = [], 0
    while len(text) - start > size and (cut := _CUT.search(text, start + size)):
        out.append(text[start: cut.start()])
        start = cut.start()
    return [*out, text[start:]]


def cuts(n: int, capacity: int = CAPACITY) -> list[int]:
    """Bounds of a document's pieces: full ones but for a shorter first."""
    return [0, *range(n - capacity * ((n - 1) // capacity), n + 1, capacity)]


def pieces(docs: DataFrame, spec: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, task, nth) of ``docs`` (doc_id, text), written; ``nth`` numbers a task's pieces of one length."""
    shared = docs.sparkSession.sparkContext.broadcast(spec)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        encoder = _encoder(shared.value, end)
        for part in X.slices(batches):
            row, piece, start, length, crc = [], [], [], [], []
            ids, bounds = encoder.encode([t or "" for t in part.column("text").to_pylist()])
            blob = memoryview(ids.tobytes())
            for i, (first, last) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                at = cuts(last - first, capacity)
                for k, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)):
                    row.append(i), piece.append(k), start.append(a), length.append(b - a)
                    crc.append(zlib.crc32(blob[4 * (first + a): 4 * (first + b)]))
            size = np.array(length)
            order = np.argsort(size, kind="stable")
            tally = np.bincount(size, minlength=capacity + 1)
            nth = np.empty(len(size), np.int64)
            nth[order] = np.arange(len(size)) - np.repeat(np.cumsum(tally) - tally, tally) + np.repeat(seen, tally)
            seen += tally
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(size),
                 pa.array(crc, pa.int64()), pa.array(np.full(len(size), task), pa.int32()), pa.array(nth)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"])

    return written(docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, task int, nth long"), "pieces")


@dataclass
class Plan:
    """Where the pieces of a length lie: those ranked from ``first`` on fill sequences from ``sequence`` on, ``each`` of them a sequence, at ``offset``."""

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    sequences: int

    def __post_init__(self) -> None:
        order = np.lexsort((self.first, self.length))
        for name in ("length", "first", "sequence", "each", "offset"):
            setattr(self, name, getattr(self, name)[order])
        self._start = (self.length << 44) + self.first

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of pieces by length and rank among the pieces of that length."""
        at = np.searchsorted(self._start, (length << 44) + rank, side="right") - 1
        past = rank - self.first[at]
        return self.sequence[at] + past // self.each[at], self.offset[at] + past % self.each[at] * length


class _Packer:
    """Runs of sequences by their gap."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.sequences = capacity, 0
        self.ranked: dict[int, int] = {}
        self.rows: list[tuple[int, int, int, int, int]] = []
        self.runs: dict[int, list[tuple[int, int]]] = {}
        self.gaps: list[int] = []

    def new(self, n: int) -> tuple[int, int]:
        self.sequences += n
        return self.sequences - n, n

    def put(self, run: tuple[int, int], gap: int, length: int, each: int) -> int:
        """``each`` pieces into every sequence of the run; the gap that is left."""
        rank = self.ranked.get(length, 0)
        self.rows.append((length, rank, run[0], each, self.capacity - gap))
        self.ranked[length] = rank + run[1] * each
        return gap - each * length

    def keep(self, run: tuple[int, int], gap: int) -> None:
        if run[1] and gap:
            if gap not in self.runs:
                insort(self.gaps, gap)
            self.runs.setdefault(gap, []).append(run)

    def take(self, least: int) -> tuple[tuple[int, int], int] | None:
        """A run of the smallest gap of ``least`` or more."""
        at = bisect_left(self.gaps, least)
        if at == len(self.gaps):
            return None
        gap = self.gaps[at]
        run = self.runs[gap].pop()
        if not self.runs[gap]:
            del self.runs[gap], self.gaps[at]
        return run, gap

    def match(self, counts: dict[int, int]) -> None:
        """Large lengths, at most two a sequence."""
        left = sorted(n for n in counts if 3 * n > self.capacity)
        n = {x: counts[x] for x in left}
        while left:
            a = left[-1]
            at = bisect_left(left, min(a, self.capacity - a) + 1) - 1
            b = left[at] if at >= 0 else None
            if b == a and n[a] == 1:
                b = left[at - 1] if at else None
            each = 2 if b == a else 1
            run = self.new(n[a] // 2 if b == a else n[a] if b is None else min(n[a], n[b]))
            gap = self.put(run, self.capacity, a, each)
            if b is not None and b != a:
                gap = self.put(run, gap, b, 1)
            self.keep(run, gap)
            for x in {a, b} - {None}:
                n[x] -= run[1] * each
                if not n[x]:
                    left.remove(x)

    def fill(self, length: int, n: int) -> None:
        """Small pieces of one length into the smallest gaps that hold them."""
        while n:
            run, gap = self.take(length) or (None, self.capacity)
            each = gap // length
            if run is None:
                run = self.new(-(-n // each))
            whole = min(run[1], n // each)
            if whole:
                self.keep((run[0], whole), self.put((run[0], whole), gap, length, each))
                n -= whole * each
                run = (run[0] + whole, run[1] - whole)
            if n and n < each and run[1]:
                self.keep((run[0], 1), self.put((run[0], 1), gap, length, n))
                n, run = 0, (run[0] + 1, run[1] - 1)
            self.keep(run, gap)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """The packing of ``counts[length]`` pieces of each length."""
    packer = _Packer(capacity)
    packer.match(counts)
    for length in sorted((x for x in counts if 3 * x <= capacity), reverse=True):
        packer.fill(length, counts[length])
    columns = np.array(packer.rows, np.int64).reshape(-1, 5).T
    return Plan(*columns, packer.sequences)


def packed(cut: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, Plan]:
    """(the pieces of :func:`pieces` with ``sequence_id`` and ``offset``, the plan).

    The driver sees one count per length.
    """
    block = F.floor(F.col("nth") / BLOCK)
    cells = written(cut.groupBy("length", "task", block.alias("block")).agg(F.count(F.lit(1)).alias("n")), "cells")
    made = plan({r.length: r.n for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect()}, capacity)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task", "block").rowsBetween(Window.unboundedPreceding, -1))
    ranked = cut.withColumn("block", block).join(
        cells.select("length", "task", "block", F.coalesce(before, F.lit(0)).alias("before")), ["length", "task", "block"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth") % BLOCK).alias("rank"))
    shared = cut.sparkSession.sparkContext.broadcast(made)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = shared.value.place(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *map(pa.array, at)], [*names, "sequence_id", "offset"])

    kind = cut.schema["doc_id"].dataType.simpleString()
    return ranked.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"), made


def best_fit_packing(spark: SparkSession, sf_dir: str, file: str = TOKENIZER) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path(file), encoding="utf-8") as f:
        spec = f.read()
    return packed(pieces(table(spark, sf_dir, "documents").select("doc_id", "text"), spec))[0]
