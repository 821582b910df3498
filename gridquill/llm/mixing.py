"""Mixing sources to target weights by hash-threshold histograms.

Every document has a 60-bit hash. The mix takes whole epochs of a source plus the documents whose
hash is at most the source's threshold. The threshold comes from a histogram of sizes by source and
leading hash bits; only the bucket in which the budget ends is counted again by its next bits, until
it holds one hash. So nothing is sorted, a smaller budget takes a subset of a larger one, and what
moves is one partial sum for each source, bucket and task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD_PATTERN, Scratch, fits, hashed_rows, read_table

HASH_BITS, LEVEL_BITS = 60, 12
#: Where the plan of the sources is too large to broadcast, a source's rows are dealt to this many tasks by their hash.
DEAL = 64


def shares(totals: DataFrame, budget: float | None, most_epochs: int) -> DataFrame:
    """totals (skey, n, weight) with target: the budget shared by weight, none above most_epochs times n.

    What a full source can't take is reshared. Sources fill up in the order of cap / weight; the level is
    what the open ones get for a unit of weight. Two windows run over one row for each source, in a stream;
    nothing but two numbers reaches the driver.
    """
    words, weight = totals.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("weight") > 0, F.col("weight"))), F.lit(0.0))).first()
    budget = float(words) if budget is None else budget
    open_ones = totals.where("weight > 0").withColumn("cap", F.col("n") * most_epochs).withColumn("ratio", F.col("cap") / F.col("weight"))
    upto = W.orderBy("ratio", "skey").rowsBetween(W.unboundedPreceding, 0)
    filled = open_ones.withColumn("left", F.lit(budget) - (F.sum("cap").over(upto) - F.col("cap"))).withColumn("weights", F.lit(weight) - (F.sum("weight").over(upto) - F.col("weight")))
    edge = filled.where(F.col("ratio") > F.col("left") / F.col("weights")).agg(F.min_by(F.col("left") / F.col("weights"), F.struct("ratio", "skey"))).first()[0]
    cap = (F.col("n") * most_epochs).cast("double")
    target = cap if edge is None else F.least(cap, F.lit(edge) * F.col("weight"))
    return totals.withColumn("target", F.when(F.col("weight") > 0, target).otherwise(0.0))


def mix(docs: DataFrame, scratch: Scratch, **how) -> DataFrame:
    """Which documents a mix takes and how often.

    docs: doc_id, source, text; other columns are ignored. weights: (skey, weight) by common.source_key, by default
    1, 2, 3 repeating over the sources in the order of code points, null last; a source that it leaves out weighs
    nothing. budget: words, by default all. A document's size is its number of words; null and empty texts have none and
    are taken with their hash like others. Null and repeated ids, and repeated rows, are rows like others: each is
    taken or not by a hash of its own. No rows: no rows out. Null is a source of its own. Any number of sources.

    Returns doc_id, source, size, h, source_size, target, copies (times the document is taken).
    """
    sized, plan = thresholds(docs, scratch, **how)
    return planned(sized, plan).select(
        "doc_id", "source", "size", "h", "source_size", "target", (F.col("epochs") + (F.col("h") <= F.col("upto")).cast("int")).alias("copies")
    )


def planned(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """rows (skey, h) with their source's plan. A plan that doesn't fit a broadcast is dealt, so that a large source is split."""
    if fits(plan.select("skey", "epochs", "upto", "target", "source_size")):
        return rows.join(F.broadcast(plan), "skey")
    dealt = plan.withColumn("_deal", F.explode(F.sequence(F.lit(0), F.lit(DEAL - 1))))
    return rows.withColumn("_deal", F.pmod("h", F.lit(DEAL)).cast("int")).join(dealt, ["skey", "_deal"]).drop("_deal")


def thresholds(docs: DataFrame, scratch: Scratch, weights: DataFrame | None = None, budget: float | None = None, most_epochs: int = 3, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """(documents with size, hash and source key; a plan with whole epochs and hash threshold of each source)."""
    hashed = hashed_rows(docs.select("doc_id", "source", "text"), scratch, seed)
    size = F.coalesce(F.regexp_count("text", F.lit(WORD_PATTERN)), F.lit(0)).cast("long")
    sized = scratch.table(hashed.select("doc_id", "source", size.alias("size"), "h", "skey"), "sizes")
    totals = sized.groupBy("skey").agg(F.sum("size").alias("n"))
    if weights is None:
        # UTF-8 bytes sort as code points do.
        totals = totals.withColumn("weight", (F.pmod(F.row_number().over(W.orderBy(F.col("skey").cast("binary"))) - 1, F.lit(3)) + 1).cast("double"))
    else:
        totals = totals.join(weights.select("skey", F.col("weight").cast("double").alias("weight")), "skey", "left").na.fill(0.0, ["weight"])
    totals = scratch.table(totals.coalesce(1), "totals")
    epochs = F.when(F.col("n") > 0, F.floor(F.col("target") / F.col("n"))).otherwise(0).cast("int")
    plan = shares(totals, budget, most_epochs).select("skey", F.col("n").alias("source_size"), "target", epochs.alias("epochs"))
    plan = scratch.table(plan.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")), "targets")
    state = plan.where("rest > 0").select("skey", "rest", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("before"))
    none, all_of_it = F.lit(-1).cast("long"), F.lit((1 << HASH_BITS) - 1).cast("long")
    # State is a row or less for each source.
    sent = F.broadcast if fits(plan) else lambda df: df
    settled = plan.where("not rest > 0").select("skey", none.alias("upto"))
    for level in range(1, HASH_BITS // LEVEL_BITS + 1):
        shift = HASH_BITS - LEVEL_BITS * level
        bucketed = sized.select("skey", "size", "h", F.shiftright("h", shift).alias("bucket"))
        if level > 1:
            # Only the boundary buckets are read on: a small part of every source.
            bucketed = bucketed.withColumn("prefix", F.shiftright("bucket", LEVEL_BITS)).join(sent(state.select("skey", "prefix")), ["skey", "prefix"], "left_semi")
        counts = bucketed.groupBy("skey", "bucket").agg(F.sum("size").alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi")).join(sent(state), "skey")
        # One source has 2**LEVEL_BITS buckets at most, so its window is small whatever the input.
        upto = counts.withColumn("upto", F.col("before") + F.sum("n").over(W.partitionBy("skey").orderBy("bucket")))
        edge = upto.where(F.col("upto") > F.col("rest")).groupBy("skey").agg(F.min_by(F.struct("bucket", "n", "upto", "lo", "hi"), "bucket").alias("b"))
        below = F.col("b.upto") - F.col("b.n")
        nearer = F.when(F.col("b.upto") - F.col("rest") < F.col("rest") - below, F.col("b.hi")).otherwise(F.col("b.lo") - 1)
        found = state.join(edge, "skey", "left").select(
            "skey", "rest", F.col("b.bucket").alias("prefix"), below.alias("before"),
            # A source without a boundary fits as a whole; a bucket of one hash ends the search.
            F.when(F.col("b").isNull(), all_of_it).when(F.col("b.lo") == F.col("b.hi"), nearer).alias("upto"),
        )
        found = scratch.table(found, f"level{level}")
        settled = settled.unionByName(found.where("upto is not null").select("skey", "upto"))
        state = found.where("upto is null").drop("upto")
        if not state.limit(1).count():
            break
    return sized, scratch.table(plan.drop("rest").join(settled, "skey"), "plan")


def repeat(docs: DataFrame, scratch: Scratch, most_epochs: int = 3, seed: int = 7, **how) -> DataFrame:
    """docs with every row as often as the mix takes it; columns stay.

    Rows find their copies by source and hash again, without a join by id, so null and repeated ids do no harm.
    """
    plan = thresholds(docs, scratch, most_epochs=most_epochs, seed=seed, **how)[1]
    # Other columns travel as one, so that none clashes with what is added.
    row = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", "text", "source")
    taken = planned(hashed_rows(row, scratch, seed), plan).withColumn("_copies", F.col("epochs") + (F.col("h") <= F.col("upto")).cast("int"))
    return taken.where("_copies > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_row.*")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(read_table(spark, sf_dir, "documents"), Scratch(spark, "op3"))
    return mixed.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), (F.col("size") * F.col("copies")).alias("taken"))


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, skey, size, CASE WHEN same > 1 THEN ('0x' || substr(md5(h || ':' || m || ':' || place), 1, 15))::BIGINT ELSE h END AS h FROM (
    SELECT *, count(*) OVER (PARTITION BY skey, h) AS same, row_number() OVER (PARTITION BY skey, h, m) - 1 AS place FROM (
      SELECT doc_id, CASE WHEN source IS NULL THEN 't' ELSE 's' || source END AS skey, md5(coalesce(text, '')) AS m,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
        ('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
      FROM documents))
), s AS (
  SELECT skey, sum(size)::BIGINT AS n, 1 + (row_number() OVER (ORDER BY encode(skey)) - 1) % 3 AS w FROM d GROUP BY skey
), o AS (
  SELECT *, 3 * n / w AS ratio,
    sum(n) OVER () - coalesce(sum(3 * n) OVER (ORDER BY 3 * n / w, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room,
    sum(w) OVER (ORDER BY 3 * n / w DESC, skey DESC) AS open_weight
  FROM s
), f AS (
  SELECT room::DOUBLE / open_weight AS level, open_weight FROM o WHERE ratio > room::DOUBLE / open_weight ORDER BY open_weight DESC LIMIT 1
), t AS (
  SELECT o.skey, n, CASE WHEN ratio <= coalesce(level, 1e300) AND o.open_weight > coalesce(f.open_weight, 0) THEN (3 * n)::DOUBLE ELSE level * w END AS target
  FROM o LEFT JOIN f ON true
), p AS (
  SELECT *, CASE WHEN n > 0 THEN floor(target / n) ELSE 0 END AS epochs, target - CASE WHEN n > 0 THEN floor(target / n) ELSE 0 END * n AS rest FROM t
), u AS (
  SELECT d.*, p.n, target, epochs, rest, sum(size) OVER (PARTITION BY d.skey ORDER BY h) AS upto FROM d JOIN p USING (skey)
), v AS (
  SELECT *, upto - sum(size) OVER (PARTITION BY skey, h) AS below FROM u
)
SELECT doc_id, size, n AS source_size, round(target, 6) AS target,
  (size * (epochs + CASE WHEN rest > 0 AND (upto <= rest OR (below <= rest AND upto - rest < rest - below)) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM v
"""
