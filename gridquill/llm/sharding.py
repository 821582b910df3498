"""Proportional stratified interleaving, in DataFrame functions only.

Rows of a source get a rank in the order of a seeded hash. All rows are then put in the order of
their fractional rank (rank + phase) / rows of the source, and that order is cut into equal shards:
any stretch of it holds each source in proportion. The phase, between 0 and 1 and fixed for a source,
keeps sources of one size from coming in clumps. Both orders are found in two steps, so that no
window holds a whole source: a bucket of the order from arithmetic, and a rank inside the bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, fits, hashed_rows, read_table, small

#: Rows that one window sorts, on average.
BUCKET_ROWS = 2_048
#: Ranges of the hash in which rows are counted: the most buckets of a source.
RANGE_BITS = 16
#: Phases are multiples of 1 / STEPS. Products of rows, buckets and steps stay below 2**63 up to 3e10 rows.
STEPS = 16
#: Numbers that one row of a sequence is spread out from.
BLOCK = 4_096


def interleave(docs: DataFrame, shards: int, scratch: Scratch, seed: int = 11, bucket_rows: int = BUCKET_ROWS, keep: tuple[str, ...] = ()) -> DataFrame:
    """Shard and slot of every row.

    docs: doc_id, source, text; keep names further columns or '*' for all. Null source is a source of its own.
    Null text has 0 bytes. Rows of a source that share an id, null or not, are told apart by the text, and
    equal rows by their number, in any order (they are equal). No rows: no rows out; shards
    differ by one row at most.

    Returns doc_id, the kept columns, size (UTF-8 bytes + 16), text_crc32, shard, slot.
    """
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    wanted = [c for c in (docs.columns if "*" in keep else keep) if c != "doc_id"]
    bare = docs.select("doc_id", "source", "text", *([F.struct(*wanted).alias("_kept")] if wanted else []))
    hashed = hashed_rows(bare, scratch, seed)
    slim = hashed.select("doc_id", *(["_kept"] if wanted else []), (F.octet_length(raw) + 16).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"), "skey", "h")
    # Counts by source and range of the hash, merged below to buckets of about bucket_rows.
    ranges, span = 1 << RANGE_BITS, F.shiftright("h", 60 - RANGE_BITS).alias("range")
    fine = scratch.table(hashed.select("skey", span).groupBy("skey", "range").agg(F.count("*").alias("count")), "counts")
    phase = F.pmod(F.crc32(F.col("skey").cast("binary")), F.lit(STEPS - 1)) + 1
    per = fine.groupBy("skey").agg(F.sum("count").alias("n")).withColumn("buckets", F.greatest(F.lit(1), F.least(F.lit(ranges), F.ceil(F.col("n") / bucket_rows))).cast("long"))
    sources = scratch.table(per.withColumn("phase", phase.cast("long")), "sources")
    total = sources.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = max(1, -(-total // bucket_rows))
    bucket = F.expr(f"(range * buckets) div {ranges}")
    offsets = (
        fine.join(small(sources), "skey").groupBy("skey", bucket.alias("bucket")).agg(F.sum("count").alias("rows"))
        .withColumn("before", F.sum("rows").over(W.partitionBy("skey").orderBy("bucket")) - F.col("rows"))
    )
    ranged = slim.withColumn("range", span)
    if fits(sources):
        dealt = ranged.join(F.broadcast(sources.select("skey", "n", "phase", "buckets")), "skey").withColumn("bucket", bucket).drop("range", "buckets")
        ordered = dealt.join(small(scratch.table(offsets.select("skey", "bucket", "before"), "offsets")), ["skey", "bucket"])
    else:
        # Every range that has rows is one row here, so no join key is a whole source.
        known = fine.join(sources, "skey").select("skey", "range", "n", "phase", bucket.alias("bucket")).join(offsets.select("skey", "bucket", "before"), ["skey", "bucket"])
        ordered = ranged.join(known, ["skey", "range"])
    rank = (F.row_number().over(W.partitionBy("skey", "bucket").orderBy("h", "doc_id", "text_crc32", "size")) - 1 + F.col("before")).cast("long")
    ranked = ordered.withColumn("r", rank).withColumn("frac", (STEPS * F.col("r") + F.col("phase")) / (STEPS * F.col("n")).cast("double"))
    ranked = ranked.withColumn("cut", _cut(parts))
    place = (F.row_number().over(W.partitionBy("cut").orderBy("frac", "skey", "r")) - 1 + F.col("first_place")).cast("long")
    n = max(1, total)
    placed = ranked.join(small(scratch.table(_cuts(sources, parts), "cuts")), "cut")
    out = placed.withColumn("place", place).withColumn("shard", F.expr(f"cast((place * {shards}) div {n} as int)"))
    return out.withColumn("slot", F.expr(f"place - (cast(shard as bigint) * {n} + {shards - 1}) div {shards}")).select(
        "doc_id", *[F.col(f"_kept.{c}").alias(c) for c in wanted], "size", "text_crc32", "shard", "slot"
    )


def _cut(parts: int):
    """The piece of the whole order that rank r of a source falls into."""
    return F.expr(f"(({STEPS} * r + phase) * {parts}) div ({STEPS} * n)")


def _cuts(sources: DataFrame, parts: int) -> DataFrame:
    """(cut, first_place): how many rows lie before each cut, from the counts of the sources alone.

    A source of fewer rows than there are cuts gives a row for each of its ranks, a larger one a row for each cut,
    so there are never more rows than documents, and sums by cut are made in each task first.
    """
    def numbers(rows: DataFrame, count: str, name: str) -> DataFrame:
        blocks = rows.withColumn("_block", F.explode(F.expr(f"sequence(0L, ({count} - 1) div {BLOCK})")))
        return blocks.withColumn(name, F.explode(F.expr(f"sequence(_block * {BLOCK}, least({count}, (_block + 1) * {BLOCK}) - 1)")))

    few = numbers(sources.where(F.col("n") <= parts), "n", "r").select(_cut(parts).alias("cut"), F.lit(1).cast("long").alias("rows"))
    many = numbers(sources.where(F.col("n") > parts), f"{parts}L", "cut")
    # Ranks below a cut: those r with (STEPS * r + phase) * parts < STEPS * n * cut.
    below = lambda cut: f"greatest(0L, least(n, ({STEPS} * n * ({cut}) + ({STEPS} - phase) * {parts} - 1) div ({STEPS} * {parts})))"
    many = many.select("cut", F.expr(f"{below('cut + 1')} - {below('cut')}").alias("rows"))
    per = few.unionByName(many).groupBy("cut").agg(F.sum("rows").alias("rows")).withColumn("_block", F.expr(f"cut div {BLOCK}"))
    blocks = per.groupBy("_block").agg(F.sum("rows").alias("_in")).select("_block", (F.sum("_in").over(W.orderBy("_block")) - F.col("_in")).alias("_before"))
    first = F.sum("rows").over(W.partitionBy("_block").orderBy("cut")) - F.col("rows") + F.col("_before")
    return per.join(blocks, "_block").select("cut", first.alias("first_place"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = interleave(read_table(spark, sf_dir, "documents"), 40, Scratch(spark, "op10"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


#: CRC-32 of a hexadecimal string's bytes, by a table of 256 remainders.
_CRC = "xor(4294967295, list_reduce(list_transform(range(len({x}) // 2), lambda i: ('0x' || substr({x}, 2 * i + 1, 2))::BIGINT), lambda c, k: xor(c >> 8, t[1 + (xor(c, k) & 255)]), 4294967295::BIGINT))"
OP10_SQL = f"""
WITH t AS MATERIALIZED (SELECT list(list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i::BIGINT) ORDER BY i) AS t FROM range(256) r(i)),
e AS (SELECT doc_id, CASE WHEN source IS NULL THEN 't' ELSE 's' || source END AS skey, hex(encode(coalesce(text, ''))) AS x, md5(coalesce(text, '')) AS m, ('0x' || substr(md5('11:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM documents),
f AS (SELECT *, count(*) OVER (PARTITION BY skey, h) AS same, row_number() OVER (PARTITION BY skey, h, m) - 1 AS place FROM e),
d AS (SELECT doc_id, skey, x, CASE WHEN same > 1 THEN ('0x' || substr(md5(h || ':' || m || ':' || place), 1, 15))::BIGINT ELSE h END AS h FROM f),
c AS MATERIALIZED (SELECT doc_id, skey, h, (len(x) // 2 + 16)::BIGINT AS size, {_CRC.format(x="x")} AS text_crc32 FROM d, t),
p AS (SELECT skey, count(*) AS n, 1 + {_CRC.format(x="hex(encode(skey))")} % 15 AS phase FROM c, t GROUP BY skey, t),
r AS (SELECT c.*, n, phase, row_number() OVER (PARTITION BY c.skey ORDER BY h, doc_id NULLS FIRST, text_crc32, size) - 1 AS r FROM c JOIN p ON c.skey = p.skey),
o AS (SELECT *, row_number() OVER (ORDER BY (16 * r + phase)::DOUBLE / (16 * n)::DOUBLE, encode(skey), r) - 1 AS place, count(*) OVER () AS total FROM r)
SELECT doc_id, size, text_crc32, 'rows' AS law, (place * 40 // total)::INT AS shard, (place - ((place * 40 // total) * total + 39) // 40)::BIGINT AS slot, NULL::INT AS grown_shard FROM o
"""
