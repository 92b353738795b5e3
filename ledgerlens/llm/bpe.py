"""Byte-level BPE encoding and decoding with recursive DuckDB queries inside each partition.

Spark splits every text with the tokenizer's pattern; a partition's distinct pieces become
rows of (word, position, token).  A recursive query joins neighbouring tokens to the merge
table and contracts, in every word at once, the leftmost pair of least rank, until no word
has a pair left.  Decoding goes the other way: token rows join the vocabulary and an ordered
aggregation puts the bytes of a word together.  The pieces' ids and bytes are then laid out
in each text's order.

Pieces of over ``LONG`` bytes would take a step for every merge, so for them a step merges all
non-overlapping occurrences of the least pair, from the left.  That is the same contraction
wherever no longer token over the merged one has a lesser rank (``safe``); elsewhere the step
takes the leftmost pair alone.  Their recursion stops after at most ``STEPS`` steps and goes on from the
state reached; shorter pieces go into a query as many as their squared lengths allow.  So no
query keeps more than about ``KEPT_ROWS`` rows, and DuckDB writes nothing to a local disk.

A worker remembers up to ``REMEMBER`` pieces from task to task, then goes on with those that came up more than once.  The vocabulary (tens of
thousands of short tokens, read once by the driver) is sent to the workers.

Defined results: a null or empty text has no token; repeated rows encode alike; special
tokens' strings are ordinary text.  ``decode`` of null ids gives null, of an unknown id fails.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm import text as X
from ledgerlens.llm.corpus import fresh, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
LONG = 256
STEPS = 64
#: Rows that one recursive query may keep: every step keeps the words that it still contracts.
KEPT_ROWS = 500_000
#: Pieces that a worker remembers.
REMEMBER = 200_000
#: Pieces laid out at once.
SLICE_PIECES = 1 << 18

#: Position of the pair and of its right token travel below the rank in one number.
_CONTRACT = """
with recursive s(w, p, t, n, q, step) as (
  select w, p, t, n, q, 0 from pieces
 union all
  select w, p, t, lead(t, 1, -1) over v, lead(p, 1, -1) over v, step from (
    select s.w, s.p, case when s.p = (b.k >> 9) & 511 then (b.k >> 18)::int else t end t, step + 1 step
    from s join (select w, min((m::bigint << 18) | (p::bigint << 9) | q) k
                 from s join merges on t = l and n = r group by w) b using (w)
    where s.p <> b.k & 511)
  window v as (partition by w order by p)
)
select s.w, s.t from s join (select w, max(step) step from s group by w) z using (w, step) order by s.w, s.p
"""

_CONTRACT_LONG = """
with recursive s(w, p, t, step) as (
  select w, p, t, 0 from state
 union all
  select w, (row_number() over (partition by w order by p) - 1)::int, t, step from (
    select s.w, s.p, coalesce(c.m, s.t) t, s.step + 1 step, lag(c.m) over (partition by s.w order by s.p) eaten
    from (select distinct w from (select w, t l, lead(t) over (partition by w order by p) r from s) join merges using (l, r)) b
    join s using (w)
    left join (
      select w, p, m from (
        select w, p, m, (p - min(p) over (partition by w, island)) % 2 = 0 and (safe or p = min(p) over (partition by w)) chosen
        from (select w, p, m, safe, p - row_number() over (partition by w order by p) island
              from (select w, p, t l, lead(t) over (partition by w order by p) r from s) join merges using (l, r)
              qualify m = min(m) over (partition by w)))
      where chosen) c on c.w = s.w and c.p = s.p
    where s.step < {steps}
  ) where eaten is null
)
select s.w, s.p, s.t, s.step from s join (select w, max(step) step from s group by w) z using (w, step) order by s.w, s.p
"""

_DECODE = "select d, unhex(string_agg(h, '' order by p)) b, count(*) n from ids join vocabulary using (t) group by d order by d"


@dataclass(frozen=True)
class Vocabulary:
    """Tokens' bytes by rank; ranks are the ids."""

    tokens: tuple[bytes, ...]
    ids: tuple[int, ...]

    @cached_property
    def digest(self) -> str:
        """Of all tokens and ids."""
        return hashlib.sha256(repr((self.tokens, self.ids)).encode()).hexdigest()

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, "rb") as f:
            rows = [line.split() for line in f if line.strip()]
        return cls(tuple(base64.b64decode(a) for a, _ in rows), tuple(int(b) for _, b in rows))


class Codec:
    """The vocabulary's tables in a private DuckDB of the worker, and the pieces it remembers."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        rank = dict(zip(vocabulary.tokens, vocabulary.ids, strict=True))
        self.byte = np.array([rank[bytes([b])] for b in range(256)], np.int32)
        pairs = np.array([(rank[b[:k]], rank[b[k:]], i) for b, i in rank.items() for k in range(1, len(b))
                          if b[:k] in rank and b[k:] in rank] or np.zeros((0, 3)), np.int32)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        self._table("pairs", l=pairs[:, 0], r=pairs[:, 1], m=pairs[:, 2])
        self.db.execute("""create table merges as select l, r, m, m < coalesce(least_over, 2147483647) as safe from pairs
            left join (select part, min(m) least_over from (select l part, m from pairs union all select r, m from pairs)
                       group by part) o on o.part = pairs.m""")
        self.db.execute("drop table pairs")
        self._table("vocabulary", t=np.array(vocabulary.ids, np.int32), h=np.array([b.hex() for b in vocabulary.tokens]))
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)  # sorted hashes of the remembered pieces
        self.place = np.zeros(0, np.int64)  # their places in the lists below
        self.id_bounds, self.byte_bounds = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.ids, self.bytes = np.zeros(0, np.int32), np.zeros(0, np.uint8)
        self.uses = np.zeros(0, np.int32)  # slices that had the piece, by place

    def _keep(self, most: int) -> None:
        """Forget all pieces but the ``most`` used ones of those that came up more than once; count their uses anew."""
        again = np.flatnonzero(self.uses > 1)
        kept = np.sort(again[np.argsort(-self.uses[again], kind="stable")[:most]])
        at = np.full(len(self.uses), -1, np.int64)
        at[kept] = np.arange(len(kept))
        place = at[self.place]
        self.known, self.place = self.known[place >= 0], place[place >= 0]
        n, size = np.diff(self.id_bounds)[kept], np.diff(self.byte_bounds)[kept]
        self.ids, self.bytes = X.take_ranges(self.ids, self.id_bounds[kept], n), X.take_ranges(self.bytes, self.byte_bounds[kept], size)
        self.id_bounds, self.byte_bounds = (np.concatenate([[0], np.cumsum(x)]) for x in (n, size))
        self.uses = np.zeros(len(kept), np.int32)

    def _table(self, name: str, **columns: np.ndarray) -> None:
        self.db.register("given", pa.table({k: pa.array(v) for k, v in columns.items()}))
        self.db.execute(f"create or replace table {name} as select * from given")
        self.db.unregister("given")

    @staticmethod
    def _spans(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = np.array([len(x) for x in pieces], np.int64)
        end = np.cumsum(size)
        return np.frombuffer(b"".join(pieces), np.uint8), end - size, end

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): the ids of piece i are ``ids[offsets[i]:offsets[i + 1]]``."""
        size = np.array([len(x) for x in pieces], np.int64)
        short, long = np.flatnonzero(size <= LONG), np.flatnonzero(size > LONG)
        parts = [run([pieces[i] for i in group], group) for which, run, rows in
                 ((short, self._short, size**2 // 2), (long, self._long, size)) for group in _groups(which, rows)]
        if not parts:
            return np.zeros(0, np.int32), np.zeros(len(pieces) + 1, np.int64)
        w, t = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(w, kind="stable")
        return t[order].astype(np.int32), np.searchsorted(w[order], np.arange(len(pieces) + 1))

    def _rows(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data, start, end = self._spans(pieces)
        w = np.repeat(np.arange(len(pieces), dtype=np.int32), end - start)
        return w, (np.arange(len(data)) - np.repeat(start, end - start)).astype(np.int32), self.byte[data]

    def _short(self, pieces: list[bytes], which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w, p, t = self._rows(pieces)
        last = np.append(w[1:] != w[:-1], True)
        self._table("pieces", w=w, p=p, t=t, n=np.where(last, -1, np.append(t[1:], -1)).astype(np.int32),
                    q=np.where(last, -1, p + 1).astype(np.int32))
        out = self.db.sql(_CONTRACT).to_arrow_table()
        return which[out.column("w").to_numpy()], out.column("t").to_numpy()

    def _long(self, pieces: list[bytes], which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w, p, t = self._rows(pieces)
        while True:
            steps = max(1, min(STEPS, KEPT_ROWS // len(w)))
            self._table("state", w=w, p=p, t=t)
            out = self.db.sql(_CONTRACT_LONG.format(steps=steps)).to_arrow_table()
            w, p, t = (out.column(c).to_numpy() for c in "wpt")
            if out.column("step").to_numpy().max() < steps:
                return which[w], t

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets) of each range of ids, by ordered aggregation."""
        n = np.diff(offsets)
        self._table("ids", d=np.repeat(np.arange(len(n)), n), p=np.arange(len(ids)), t=ids)
        rows = self.db.sql(_DECODE).to_arrow_table().combine_chunks()
        if rows.column("n").to_numpy().sum() < len(ids):
            raise ValueError("an id is not in the vocabulary")
        size = np.zeros(len(n), np.int64)
        if not rows.num_rows:
            return np.zeros(0, np.uint8), np.zeros(len(n) + 1, np.int64)
        data, at = X.text_bytes(rows.column("b").combine_chunks())
        size[rows.column("d").to_numpy()] = np.diff(at)
        return data, np.concatenate([[0], np.cumsum(size)])

    def learn(self, hashes: np.ndarray, take) -> np.ndarray:
        """Places of the pieces with these distinct hashes; ``take(which)`` gives the bytes of those not yet known."""
        if len(self.known) > REMEMBER:
            self._keep(REMEMBER // 2)
        at = np.minimum(np.searchsorted(self.known, hashes), max(len(self.known) - 1, 0))
        new = np.flatnonzero(self.known[at] != hashes) if len(self.known) else np.arange(len(hashes))
        if len(new):
            ids, bounds = self.encode(take(new))
            data, ends = self.decode(ids, bounds)
            n = len(self.id_bounds) - 1
            self.ids, self.bytes = np.concatenate([self.ids, ids]), np.concatenate([self.bytes, data])
            self.id_bounds = np.concatenate([self.id_bounds, self.id_bounds[-1] + bounds[1:]])
            self.byte_bounds = np.concatenate([self.byte_bounds, self.byte_bounds[-1] + ends[1:]])
            self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int32)])
            known, place = np.concatenate([self.known, hashes[new]]), np.concatenate([self.place, n + np.arange(len(new))])
            order = np.argsort(known)
            self.known, self.place = known[order], place[order]
            at = np.searchsorted(self.known, hashes)
        place = self.place[at] if len(hashes) else np.zeros(0, np.int64)
        self.uses[place] += 1
        return place


def _groups(which: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """``which`` in runs of about ``KEPT_ROWS`` rows each."""
    if not len(which):
        return []
    run = (np.cumsum(rows[which]) - 1) // KEPT_ROWS
    return np.split(which, np.flatnonzero(np.diff(run)) + 1)


_CODECS: dict[str, Codec] = {}
X.KEPT.append(_CODECS)


def _codec(vocabulary: Vocabulary) -> Codec:
    """The worker's codec; kept while tasks ask for the same vocabulary."""
    key = vocabulary.digest
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(vocabulary)
    return _CODECS[key]


def _encode_slice(part: pa.RecordBatch, codec: Codec, with_ids: bool) -> pa.StructArray:
    pieces, rows = X.list_bounds(part.column("pieces"))
    data, at = X.text_bytes(pieces)
    h = X.hash_ranges(data, at[:-1], at[1:])
    codes, values, first = X.distinct(h)
    blob = data.tobytes()
    place = codec.learn(values, lambda new: [blob[at[i]: at[i + 1]] for i in first[new].tolist()])[codes]
    n = np.diff(codec.id_bounds)[place]
    ids = X.take_ranges(codec.ids, codec.id_bounds[place], n)
    id_rows = np.concatenate([[0], np.cumsum(n)])[rows]
    size = np.diff(codec.byte_bounds)[place]
    decoded = X.take_ranges(codec.bytes, codec.byte_bounds[place], size)
    byte_rows = np.concatenate([[0], np.cumsum(size)])[rows]
    digest = lambda x, b: pa.array([hashlib.sha256(x[i:j]).hexdigest() for i, j in zip(b[:-1].tolist(), b[1:].tolist(), strict=True)], pa.string())
    out = {"n_tokens": pa.array(np.diff(id_rows)), "ids_sha256": digest(ids.astype("<u4"), id_rows), "decoded_sha256": digest(decoded, byte_rows)}
    if with_ids:
        out["ids"] = pa.ListArray.from_arrays(pa.array(id_rows.astype(np.int32)), pa.array(ids))
    return pa.StructArray.from_arrays(list(out.values()), list(out))


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", with_ids: bool = True) -> tuple[DataFrame, str]:
    """``docs`` with a struct of n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids; also the struct's name."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.read(path))
    name = fresh("_m", docs.columns)
    fields = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                           T.StructField("decoded_sha256", T.StringType()),
                           *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else [])])
    # (?U): white space as Unicode has it, as in the tokenizer's own engine
    pieces = F.regexp_extract_all(text, F.lit(f"(?U){pattern}"), F.lit(0))
    kept = [c for c in docs.columns if c != text]
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), pieces.alias("pieces")) if kept else docs.select(
        F.struct(F.lit(1).alias("_")).alias("row"), pieces.alias("pieces"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary.value)
        for batch in batches:
            for part in X.list_slices(batch, "pieces", SLICE_PIECES):
                yield pa.RecordBatch.from_arrays([part.column("row"), _encode_slice(part, codec, with_ids)], ["row", name])
        batch = part = None
        X.trim()

    out = row.mapInArrow(run, T.StructType([T.StructField("row", row.schema["row"].dataType), T.StructField(name, fields)]))
    return out.select(*[F.col(f"row.`{c}`") for c in kept], name), name


def decode(frame: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``frame`` with a binary column ``decoded``: the bytes of the list of ids."""
    vocabulary = frame.sparkSession.sparkContext.broadcast(Vocabulary.read(path))
    name = fresh("decoded", frame.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary.value)
        for batch in batches:
            for part in X.list_slices(batch, ids):
                values, rows = X.list_bounds(part.column(ids))
                texts = X.binary_list(*codec.decode(values.to_numpy(zero_copy_only=False).astype(np.int32), rows))
                texts = pc.if_else(part.column(ids).is_null(), pa.scalar(None, pa.binary()), texts)
                yield pa.RecordBatch.from_arrays([*part.columns, texts], [*part.schema.names, name])

    return frame.mapInArrow(run, T.StructType([*frame.schema.fields, T.StructField(name, T.BinaryType())]))


def byte_bpe(spark: SparkSession, sf_dir: str, file: str = VOCABULARY) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out, m = encode(docs, public_tokenizers.path(file), public_tokenizers.PATTERN, with_ids=False)
    return out.select("doc_id", f"{m}.*")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str, file: str = VOCABULARY) -> DataFrame:
    """Last pipeline stage: (doc_id, n_tokens, ids_sha256, decoded_sha256, ids) of every document."""
    import public_tokenizers

    out, m = encode(docs.select("doc_id", "text"), public_tokenizers.path(file), public_tokenizers.PATTERN)
    return out.select("doc_id", f"{m}.*")
