"""Sharding by jump consistent hashing, in DataFrame functions alone.

``jump`` walks a key's own sequence of jumps: a 64-bit linear congruential generator seeded
with the key draws the next shard count at which the key would move, until that is past the
count at hand.  No ring or table is kept, and one shard more takes from every shard only the
keys that jump into the new one.  The generator's product modulo 2^64 is built from 32-bit
halves, as Spark's long arithmetic must not overflow.

Slots number a shard's rows from 0 without gaps.  No shard passes through one task: rows are
ordered within ``BLOCKS`` hash blocks of a shard, and a block starts where the counts of the
blocks before it end; that table has at most shards x ``BLOCKS`` rows.  Within a block, an id's rows
are ordered in ``PARTS`` ranges of their checksum, and only the counts of these ranges are
summed over the block, so different texts of a hot id do not fill one window.  Rows alike in
id, size and checksum are counted before the shuffle and laid out again behind it, ``CHUNK``
at a time.

Defined results: a null text has size 8 and the checksum of no bytes, 0; a null id is the
key 0 and comes first within a block; repeated rows share a shard and get slots of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.corpus import table

SHARDS = 24
#: By the first three hexadecimal digits of the id's MD5.
BLOCKS = 16**3
#: By the first twelve bits of the checksum.
PARTS = 16**3
CHUNK = 4096
OVERHEAD = 8
_MULTIPLIER = 2862933555777941757


def jump(key: Column, shards: int) -> Column:
    """Shard of a long key, 0 to ``shards`` - 1."""
    m_hi, m_lo = _MULTIPLIER >> 32, _MULTIPLIER & 0xFFFFFFFF
    low32 = F.lit(0xFFFFFFFF)
    long = lambda x: F.lit(x).cast("long")

    def step(s: Column, _: Column) -> Column:
        hi, lo = s["hi"], s["lo"]
        p0 = lo.bitwiseAND(F.lit(0xFFFF)) * m_lo + 1
        p1 = F.shiftright(lo, 16) * m_lo
        low = p0 + F.shiftleft(p1.bitwiseAND(F.lit(0xFFFF)), 16)
        up = (F.shiftright(low, 32) + F.shiftright(p1, 16) + lo * m_hi
              + hi.bitwiseAND(F.lit(0xFFFF)) * m_lo
              + F.shiftleft((F.shiftright(hi, 16) * (m_lo & 0xFFFF)).bitwiseAND(F.lit(0xFFFF)), 16))
        hi, lo = up.bitwiseAND(low32), low.bitwiseAND(low32)
        draw = (F.shiftright(hi, 1) + 1).cast("double")
        ahead = F.floor((s["j"] + 1).cast("double") * (F.lit(float(1 << 31)) / draw)).cast("long")
        return F.when(s["j"] < shards, F.struct(hi.alias("hi"), lo.alias("lo"), s["j"].alias("b"), ahead.alias("j"))).otherwise(s)

    start = F.struct(F.shiftrightunsigned(key, 32).alias("hi"), key.bitwiseAND(low32).alias("lo"),
                     long(-1).alias("b"), long(0).alias("j"))
    # every jump moves ahead by one at least, so as many steps as shards always reach the end
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step, lambda s: s["b"].cast("int"))


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row of ``docs``."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    alike = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"))
    key = F.coalesce("doc_id", F.lit(0).cast("long"))
    block = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 3), 16, 10).cast("int")
    placed = alike.select("*", jump(key, shards).alias("shard"), jump(key, shards + 1).alias("grown_shard"),
                          block.alias("block"), F.expr(f"cast(text_crc32 div {2**32 // PARTS} as int)").alias("part"))
    sizes = placed.groupBy("shard", "block").agg(F.sum("n").alias("rows"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("shard").alias("of"), F.col("block").alias("at_block"),
                          F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    ranges = placed.groupBy("shard", "block", "doc_id", "part").agg(F.sum("n").alias("rows"))
    earlier = Window.partitionBy("shard", "block").orderBy("doc_id", "part").rowsBetween(Window.unboundedPreceding, -1)
    # null-safe, as neither side has nulls and a null filter on one side would keep Spark from reusing the one shuffle
    bases = ranges.withColumn("over", F.coalesce(F.sum("rows").over(earlier), F.lit(0))).join(
        starts, F.col("shard").eqNullSafe(F.col("of")) & F.col("block").eqNullSafe(F.col("at_block")))
    bases = bases.select(F.col("shard").alias("in_shard"), F.col("block").alias("in_block"), F.col("doc_id").alias("of_id"),
                         F.col("part").alias("of_part"), (F.col("start") + F.col("over")).alias("start"))
    inside = Window.partitionBy("shard", "block", "doc_id", "part").orderBy("text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    same = [F.col(x).eqNullSafe(F.col(y)) for x, y in (("shard", "in_shard"), ("block", "in_block"), ("doc_id", "of_id"), ("part", "of_part"))]
    first = placed.withColumn("at", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(bases, same)
    chunks = first.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(CHUNK).cast("long"))).alias("from"))
    return (chunks.hint("rebalance")
            .select("*", F.explode(F.sequence("from", F.least(F.col("from") + CHUNK, "n") - 1)).alias("copy"))
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("start") + F.col("at") + F.col("copy")).alias("slot"), "grown_shard"))


def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents").select("doc_id", "text"))


#: The same in DuckDB: CRC-32 byte by byte over its table, the generator in 128-bit integers, slots by one window.
SQL = f"""
with recursive polynomial(i, c, n) as (
  select i, i, 0 from (select unnest(range(256))::bigint i)
 union all
  select i, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, n + 1 from polynomial where n < 8),
crc as (select list(c order by i) t from polynomial where n = 8),
d as (select doc_id, coalesce(text, '') t from documents),
b as (select doc_id, octet_length(encode(t)) n, hex(encode(t)) h from d),
r as (select doc_id, n + {OVERHEAD} size,
             xor(list_reduce(list_concat([4294967295::bigint], list_transform(regexp_extract_all(h, '..'), lambda p: ('0x' || p)::bigint)),
                             lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) text_crc32
      from b, crc),
j(doc_id, shards, key, b, j) as (
  select *, -1::bigint, 0::bigint from (
    select doc_id, shards, (coalesce(doc_id, 0)::hugeint + 18446744073709551616) % 18446744073709551616 from (select distinct doc_id from d), (values ({SHARDS}), ({SHARDS + 1})) s(shards))
 union all
  select doc_id, shards, k, j, floor((j + 1) * (2147483648.0::double / ((k >> 33) + 1)::double))::bigint
  from (select *, (key * {_MULTIPLIER} + 1) % 18446744073709551616 k from j where j < shards)),
placed as (select doc_id, max(case when shards = {SHARDS} then b end)::int shard, max(case when shards > {SHARDS} then b end)::int grown_shard
           from j where j >= shards group by doc_id)
select r.doc_id, size::bigint size, text_crc32::bigint text_crc32, 'key' law, shard,
       row_number() over (partition by shard order by substr(md5(coalesce(r.doc_id::varchar, '')), 1, 3), r.doc_id nulls first, text_crc32, size) - 1 slot,
       grown_shard
from r join placed on r.doc_id is not distinct from placed.doc_id
"""
