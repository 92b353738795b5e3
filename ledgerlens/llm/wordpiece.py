"""Greedy word-piece counts by a linear longest-match automaton.

The vocabulary is a trie.  Every node carries a failure link and the number of pieces that
greedy longest matching has surely cut off when it follows that link (both precomputed), so a
word is counted in one walk over its bytes, without going back and without building a piece:
where a node has no edge for the next byte, the walk adds the node's popped count and goes on
at its link.  The trie is sent to the workers (it is bounded by the vocabulary); a task walks
all distinct words of a batch together, one byte a step.

Words come from the tokenizer's own pattern over the text in lower case (Spark); a word-end
mark closes each, so pieces at a word's end differ from the same bytes inside.

Defined results: a null or empty text has 0 words and 0 tokens; a word with a byte that no
piece can start is one (unknown) token; repeated rows count alike.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import text as X
from ledgerlens.llm.corpus import table

VOCABULARY = "word_bpe_49k.json"
#: Fixed value: the pattern of that vocabulary's tokenizer (white space dropped).
PATTERN = r"(?U)'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
END = 256
_SYMBOLS = 257


def byte_of_char() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies write for bytes."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def read(path: str) -> list[tuple[int, ...]]:
    """Pieces as symbol tuples: bytes, and ``END`` where a piece closes its word; special tokens are left out."""
    with open(path, encoding="utf-8") as f:
        given = json.load(f)
    special = {t["content"] for t in given["added_tokens"]}
    suffix, to_byte = given["model"]["end_of_word_suffix"], byte_of_char()
    pieces = []
    for token in given["model"]["vocab"]:
        if token not in special:
            body, ends = (token[: -len(suffix)], (END,)) if token.endswith(suffix) else (token, ())
            pieces.append((*(to_byte[c] for c in body), *ends))
    return pieces


@dataclass
class Automaton:
    """Sorted edges (node * 257 + symbol -> node), failure links (-1: none) and popped counts; node 0 is the root."""

    edge: np.ndarray
    child: np.ndarray
    link: np.ndarray
    popped: np.ndarray

    @classmethod
    def build(cls, pieces: list[tuple[int, ...]]) -> Automaton:
        children: list[dict[int, int]] = [{}]
        final = [False]
        for piece in pieces:
            node = 0
            for symbol in piece:
                if symbol not in children[node]:
                    children[node][symbol] = len(children)
                    children.append({})
                    final.append(False)
                node = children[node][symbol]
            final[node] = node > 0
        link, popped = [-1] * len(children), [0] * len(children)
        level = [0]
        while level:  # breadth first: links and counts of shorter prefixes come first
            ahead = []
            for parent in level:
                for symbol, node in children[parent].items():
                    ahead.append(node)
                    if final[node]:
                        link[node], popped[node] = 0, 1
                        continue
                    count, at = popped[parent], link[parent]
                    while at >= 0 and symbol not in children[at]:
                        count, at = count + popped[at], link[at]
                    if at >= 0:
                        link[node], popped[node] = children[at][symbol], count
            level = ahead
        edges = np.array([(n * _SYMBOLS + s, c) for n, kids in enumerate(children) for s, c in kids.items()], np.int64).reshape(-1, 2)
        edges = edges[edges[:, 0].argsort()]
        return cls(edges[:, 0].copy(), edges[:, 1].copy(), np.array(link), np.array(popped))

    def counts(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Greedy pieces of every word (a byte range), closed by the word-end mark."""
        size = end - start
        order = np.argsort(-size, kind="stable")
        start, size = start[order], size[order]
        n = len(start)
        node, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
        unknown = np.zeros(n, bool)
        longest = int(size[0]) if n else 0
        alive = np.searchsorted(-size, -np.arange(longest + 1), side="right")  # words of at least so many bytes
        for k in range(longest + 1):
            # words of k bytes and more take their next byte; the mark follows the last
            at = np.arange(alive[k])
            symbol = np.full(len(at), END)
            more = np.flatnonzero(size[at] > k)
            symbol[more] = data[start[more] + k]
            self._step(at, symbol, node, total, unknown)
        while len(at := np.flatnonzero((node > 0) & ~unknown)):
            total[at] += self.popped[node[at]]
            node[at] = self.link[node[at]]
            unknown[at[node[at] < 0]] = True
        out = np.empty(n, np.int64)
        out[order] = np.where(unknown, 1, total)
        return out

    def _step(self, at: np.ndarray, symbol: np.ndarray, node: np.ndarray, total: np.ndarray, unknown: np.ndarray) -> None:
        going = ~unknown[at]
        at, symbol = at[going], symbol[going]
        while len(at):
            key = node[at] * _SYMBOLS + symbol
            place = np.minimum(np.searchsorted(self.edge, key), len(self.edge) - 1)
            there = self.edge[place] == key
            node[at[there]] = self.child[place[there]]
            at, symbol = at[~there], symbol[~there]
            total[at] += self.popped[node[at]]
            node[at] = self.link[node[at]]
            lost = node[at] < 0
            unknown[at[lost]] = True
            at, symbol = at[~lost], symbol[~lost]


def count(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_tokens) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(Automaton.build(read(path)))
    rows = docs.select("doc_id", F.regexp_extract_all(F.lower(text), F.lit(PATTERN), F.lit(0)).alias("words"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in X.list_slices(batch, "words"):
                words, bounds = X.list_bounds(part.column("words"))
                data, at = X.text_bytes(words)
                codes, _, first = X.distinct(X.hash_ranges(data, at[:-1], at[1:]))
                pieces = shared.value.counts(data, at[first], at[first + 1])[codes]
                sums = np.concatenate([[0], np.cumsum(pieces)])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(bounds)), pa.array(np.diff(sums[bounds]))], ["doc_id", "n_words", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, n_tokens long")


def token_counts(spark: SparkSession, sf_dir: str, file: str = VOCABULARY) -> DataFrame:
    import public_tokenizers

    return count(table(spark, sf_dir, "documents"), public_tokenizers.path(file))
