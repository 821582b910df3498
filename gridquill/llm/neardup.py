"""Near-duplicate documents by bottom-k sketches of one hash function.

A document's sketch is the K smallest hashes of its word shingles. The union of two sets has its own
K smallest hashes, and a share of about their Jaccard similarity of those is in both sketches. So
linked documents share at least need() retained values (at similarity 0.85 and K = 64 fewer than 34
are shared with probability 3e-10; sets of 54 shingles at most are in the sketch whole, and there the
bound is exact). The similarity is a parameter, and bounds() derives these numbers from it.

Inverted lists are kept for the rarest retained values of each document only: of two sketches that
share need() values, the size - need() + 1 rarest ones share one (values in order of the number of
documents that retain them). A passage that a third of all documents hold is at the far end of that
order, and values of one document only make no list. Documents that meet in lists, directly or over
others, are a candidate cluster. A cluster's texts meet once: retained values give overlaps, the
sketch of the union estimates the similarity and drops clear misses, and the full sets decide. Pairs
that links already connect aren't compared, and only links that connect something come out, so a
group gives fewer rows than it has members. A cluster of more than BLOCK documents or BLOCK_BYTES of
text is compared in pairs of blocks; that keeps every task bounded and loses no link, at a cost that
grows with the square of that cluster.

Documents with equal sets are one node from the start.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, read_table, workers_see_package
from .components import components
from .textvec import U, shingle_sets, slices, text_slices, utf8

#: Retained values, words of a shingle, and the similarity in hundredths that op9 links from.
K, WIDTH, PERCENT = 64, 5, 85
#: Linked sketches share fewer values than asked for with a probability below this.
TAIL = 1e-9
#: Documents of a cluster that one task compares with each other or with as many others.
BLOCK = 512
#: And the text of those, on average: a task holds two blocks and about eight times their bytes.
BLOCK_BYTES = 8 << 20
#: Holders of values that are looked at together.
HOLDERS = 1 << 20
#: Text that a task of small clusters gets, on average.
JOB_BYTES = 1 << 20
BROADCAST_NODES = 500_000


@dataclass(frozen=True)
class Bounds:
    percent: int
    shared: int  # values that linked sketches share at least
    whole: int  # sets up to this size and all that they link with are in the sketch whole: they share percent of their own size
    least: int  # smaller sets link only with equal sets: a difference of one shingle already is too much


def bounds(percent: int) -> Bounds:
    if not 50 <= percent <= 99:
        raise ValueError("similarity is from 50 to 99 in 100")
    p, shared, below = percent / 100, 0, 0.0
    while (below := below + comb(K, shared) * p**shared * (1 - p) ** (K - shared)) < TAIL:
        shared += 1
    return Bounds(percent, shared, K * percent // 100, -(-percent // (100 - percent)))


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n (shingles), size (bytes of the text), set_key (128-bit hash of the set), sketch (K smallest hashes, 8 bytes each)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in text_slices(batches):
            sets = shingle_sets(data, offsets, WIDTH)
            keys = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            packed = [s[:K].tobytes() for s in sets]
            columns = {"doc_id": part.column("doc_id"), "n": pa.array([len(s) for s in sets], pa.int64()), "size": pa.array(np.diff(offsets), pa.int64()), "set_key": pa.array(keys, pa.binary()), "sketch": pa.array(packed, pa.binary())}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, size long, set_key binary, sketch binary")


def need(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Retained values that a set of n shingles shares with any set that it is linked to."""
    b = bounds(percent)
    return np.where(n <= b.whole, -(-percent * n // 100), b.shared)


def retained(nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(value, node) for every retained value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, _ = utf8(batch.column("sketch"))
            count = pc.binary_length(batch.column("sketch")).to_numpy(zero_copy_only=False) // 8
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(np.repeat(batch.column("node").to_numpy(), count))], ["value", "node"])

    return nodes.where(F.col("n") >= bounds(percent).least).select("node", "sketch").mapInArrow(run, "value long, node long")


def clusters(nodes: DataFrame, scratch: Scratch, percent: int = PERCENT) -> DataFrame:
    """(node, comp): candidate clusters, for nodes that share a rare retained value with others."""
    limit = bounds(percent)
    every = scratch.table(retained(nodes, percent), "retained")
    common = every.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    shared = every.join(common, "value").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("own"))
    sizes = nodes.select("node", "n", F.least("n", F.lit(K)).alias("kept"), F.when(F.col("n") <= limit.whole, F.ceil(F.col("n") * percent / 100)).otherwise(F.lit(limit.shared)).alias("need"))
    # Values of this node alone are the rarest: they take their places in the prefix, and make no list.
    room = F.col("kept") - F.col("need") + 1 - (F.col("kept") - F.size("own"))
    rare = shared.join(sizes, "node").where(room > 0).select("node", F.explode(F.slice("own", F.lit(1), room.cast("int")))).select("node", F.col("col.value").alias("value"))
    rare = scratch.table(rare, "rare")
    scratch.drop(every)
    first = rare.groupBy("value").agg(F.min("node").alias("b"), F.count("*").alias("c")).where("c > 1").select("value", "b")
    edges = scratch.table(rare.join(first, "value").where("node <> b").select(F.col("node").alias("a"), "b").distinct(), "stars")
    found = components(edges, scratch)
    scratch.drop(rare, edges)
    return found


def links_among(ids: np.ndarray, sets: list[np.ndarray], block: np.ndarray, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that connect the sets, none between sets that others connect already.

    Where block has two values, only pairs across them are compared.
    """
    m = len(sets)
    size = np.array([len(s) for s in sets])
    sketch = [s[:K] for s in sets]
    kept = np.minimum(size, K)
    least, shared = need(size, percent), bounds(percent).shared
    table = np.full((m, K), np.iinfo(np.uint64).max, U)
    for row, s in enumerate(sketch):
        table[row, : len(s)] = s
    flat = np.concatenate(sketch)
    order = np.argsort(flat, kind="stable")
    values, holder = flat[order], np.repeat(np.arange(m), kept)[order]
    full = None
    cross = block.min() != block.max()
    root = np.arange(m)
    out = []

    def overlaps(keys: np.ndarray, of: np.ndarray, who: np.ndarray) -> np.ndarray:
        low, high = np.searchsorted(of, keys), np.searchsorted(of, keys, "right")
        count = high - low
        upto = np.cumsum(count)
        out, a = np.zeros(m, np.int64), 0
        while a < len(keys):
            done = upto[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(upto, done + HOLDERS, "right")))
            n = count[a:b]
            out += np.bincount(who[np.arange(n.sum()) - np.repeat(upto[a:b] - n - done, n) + np.repeat(low[a:b], n)], minlength=m)
            a = b
        return out

    def join(x: int, y: int) -> None:
        out.append((int(ids[x]), int(ids[y])))
        root[root == root[x]] = root[y]

    for x in range(m):
        able = (root[:x] != root[x]) & (size[:x] * 100 >= size[x] * percent) & (size[x] * 100 >= size[:x] * percent)
        if cross:
            able &= block[:x] != block[x]
        if not able.any():
            continue
        overlap = overlaps(sketch[x], values, holder)[:x]
        likely = np.flatnonzero(able & (overlap >= np.maximum(least[:x], least[x])))
        if not len(likely):
            continue
        # Shared values with their rank in the union: of the union's K smallest, a linked pair shares as many as linked sketches do.
        rows = table[likely]
        at = np.minimum(np.searchsorted(sketch[x], rows), kept[x] - 1)
        both = (sketch[x][at] == rows) & (np.arange(K) < kept[likely][:, None])
        rank = at + np.arange(K) + 2 - np.cumsum(both, 1)
        common = overlap[likely]
        exact = 100 * common >= percent * (size[x] + size[likely] - common)
        whole = (size[x] <= K) & (size[likely] <= K)
        likely = likely[np.where(whole, exact, (both & (rank <= K)).sum(1) >= shared)]
        if not len(likely):
            continue
        # Copies link with the first of their likely neighbours; the whole index is for those that don't.
        while len(likely):
            y = likely[0]
            place = np.minimum(np.searchsorted(sets[y], sets[x]), size[y] - 1)
            inter = np.count_nonzero(sets[y][place] == sets[x])
            if 100 * inter < percent * (size[x] + size[y] - inter):
                likely = likely[1:]
                break
            join(x, y)
            likely = likely[root[likely] != root[x]]
        if not len(likely):
            continue
        if full is None:
            values_of_all = np.concatenate(sets)
            by_value = np.argsort(values_of_all, kind="stable")
            full = values_of_all[by_value], np.repeat(np.arange(m, dtype=np.int32), size)[by_value]
            del values_of_all, by_value
        inter = overlaps(sets[x], *full)[likely]
        for y in likely[100 * inter >= percent * (size[x] + size[likely] - inter)]:
            if root[y] != root[x]:
                join(x, y)
    return out


def links(texts: DataFrame, found: DataFrame, scratch: Scratch, percent: int = PERCENT) -> DataFrame:
    """(a, b): links that connect the nodes of each cluster. texts: node, text; found: node, comp, size."""
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.least(F.ceil(F.sum("size") / BLOCK_BYTES), F.count("*"))).cast("int")
    placed = found.join(found.groupBy("comp").agg(blocks.alias("blocks")), "comp")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    rows = scratch.table(texts.join(placed, "node").select("node", "comp", "blocks", own.alias("own"), "text"), "texts")
    jobs = max(1, rows.where("blocks = 1").agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0] // JOB_BYTES)
    small = rows.where("blocks = 1").select("node", "comp", F.lit(0).alias("own"), "text", F.pmod(F.xxhash64("comp"), F.lit(jobs)).alias("job"), F.lit(-1).alias("i"), F.lit(-1).alias("j"))
    wide = rows.where("blocks > 1").select("node", "comp", "own", "text", F.col("comp").alias("job"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    wide = wide.select("node", "comp", "own", "text", "job", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def compare(table: pa.Table) -> pa.Table:
        data, offsets = utf8(table["text"])
        sets = []
        for a, b in slices(offsets):
            sets += shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], WIDTH)
        del data
        node, comp, own = (table[c].to_numpy() for c in ("node", "comp", "own"))
        order = np.lexsort((node, comp))
        out = []
        for group in np.split(order, np.flatnonzero(np.diff(comp[order])) + 1):
            group = np.array([k for k in group if len(sets[k])], np.int64)
            if len(group) > 1:
                out += links_among(node[group], [sets[k] for k in group], own[group], percent)
        a, b = zip(*out, strict=True) if out else ((), ())
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return small.unionByName(wide).groupBy("job", "i", "j").applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, scratch: Scratch, percent: int = PERCENT) -> DataFrame:
    """Component of every document; sets are linked from a Jaccard similarity of percent in 100 on.

    docs: doc_id, text; other columns are ignored. A set has the distinct five-word shingles of the text in lower
    case; a shorter text has its whole word sequence as one; a null or empty text, or one of white space, has
    none and is linked with nothing. Rows with one doc_id count as one document whose links are joined. Rows
    with a null doc_id take no part: component_id is null, kept true. No rows: no rows out.

    Returns doc_id, n_shingles, component_id, kept.
    """
    workers_see_package(docs.sparkSession)
    own = scratch.table(sketches(docs), "sketches")
    classes = own.where("n > 0 and doc_id is not null").groupBy("set_key", "n").agg(F.min("doc_id").alias("node"), F.max("size").alias("size"), F.first("sketch").alias("sketch"))
    nodes = scratch.table(classes, "nodes")
    found = clusters(nodes, scratch, percent)
    few = found.limit(BROADCAST_NODES + 1).count() <= BROADCAST_NODES
    texts = docs.select(F.col("doc_id").alias("node"), "text").join(F.broadcast(found.select("node")) if few else found.select("node"), "node", "left_semi")
    joined = scratch.table(links(texts, found.join(nodes.groupBy("node").agg(F.sum("size").alias("size")), "node"), scratch, percent), "links")
    labels = components(joined, scratch) if joined.limit(1).count() else None
    named_sets = own.select("doc_id", "n", "set_key").join(nodes.select("set_key", "n", "node"), ["set_key", "n"], "left")
    linked = named_sets.join(labels, "node", "left") if labels is not None else named_sets.withColumn("comp", F.lit(None).cast("long"))
    found = linked.withColumn("c", F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "node", "doc_id")))
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.col("c").alias("component_id"), F.coalesce(F.col("doc_id") == F.col("c"), F.lit(True)).alias("kept"))


def deduplicate(docs: DataFrame, scratch: Scratch, percent: int = PERCENT) -> DataFrame:
    """docs with one document of each component, the one with the smallest id; columns stay.

    Rows with a null doc_id stay. Of rows that share a doc_id one stays.
    """
    found = near_duplicates(docs, scratch, percent)
    gone = scratch.table(found.where("not kept").select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    few = gone.limit(BROADCAST_NODES + 1).count() <= BROADCAST_NODES
    rest = docs.join(F.broadcast(gone) if few else gone, F.col("doc_id") == F.col("_gone"), "left_anti")
    repeated = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count()
    if repeated:
        rest = rest.where("doc_id is null").union(rest.where("doc_id is not null").dropDuplicates(["doc_id"]))
    return rest


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), Scratch(spark, "op9"))


_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
OP9_SQL = rf"""
WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{_CAPITALS}', '{_CAPITALS.lower()}'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(len(w) - 4), lambda i: array_to_string(w[i + 1:i + 5], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS x FROM w),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * shared >= 85 * (na.n + nb.n - shared)),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c AS component_id, w.doc_id = c AS kept FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS c FROM r GROUP BY a) ON a = w.doc_id
"""
