"""SimHash near-dedup: covering locality-sensitive hashing.

A text's fingerprint has bit b set if more than half of the hashes of its word shingles
have it. Fingerprints at most ``RADIUS`` = 2 bits apart are linked. Two levels of masks
guarantee that every such pair meets:

* seven masks: every bit position is given one of the seven non-zero vectors of three bits,
  and mask v keeps the positions whose vector has an odd product with v. Two differing
  positions always leave some v with even products to both, whose mask keeps neither;
* within a mask, the positions it does not keep fall into four blocks, of which two
  differing positions leave two untouched: six pairs of blocks.

So two fingerprints within the radius agree on all kept bits of one of 42 tables, each of
about 50 bits, and as the other bits are few, no bucket has more than a few thousand
distinct fingerprints, however many documents share them. Copies are reduced to one row
per fingerprint first. A bucket gives a spanning star of each linked set, not its pairs;
connected components follow by alternating star contraction over stored tables.

Defined results: a null text or one without words has fingerprint zero and is linked like
any other; fewer words than a shingle make one shingle of all; a tie of bits is zero;
repeated rows share fingerprint and component; a component is named by its smallest
doc_id (null ids count last; null if it has no other); texts of any length are read whole;
an empty table gives an empty result; ``keep_documents`` keeps other columns whatever
their names, and of rows that repeat the id and text that stay exactly one.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import common as C

SHINGLE, RADIUS, SEED = 3, 2, 42
_STEP = 1 << 15
#: Entries (fingerprint and table) that one task compares.
PER_TASK = 1_000_000


def masks() -> np.ndarray:
    """The 42 masks, for radius 2 over 64 bits."""
    vector = np.arange(64) % 7 + 1
    out = []
    for v in range(1, 8):
        keep = np.array([bin(int(x) & v).count("1") % 2 == 1 for x in vector])
        rest = np.flatnonzero(~keep)
        for pair in combinations(np.array_split(rest, 4), 2):
            bits = np.concatenate([np.flatnonzero(keep), *pair])
            out.append(sum(1 << int(b) for b in bits))
    return np.array(out, np.uint64)


MASKS = masks()


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.r_[0, ends[:-1]].tolist()
    stops = (ends - 1)[shingle - 1:].tolist() or [len(line)]
    ones, n = np.zeros(64, np.int64), len(stops)
    for a in range(0, n, _STEP):
        h = np.array([xxhash.xxh64_intdigest(line[i:j], SEED) for i, j in zip(starts[a:a + _STEP], stops[a:a + _STEP])], ">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, row key and fingerprint (as a signed long) of every row."""
    def run(batches):
        for batch in batches:
            for a, b in C.blocks(batch, "text"):
                part = batch.slice(a, b - a)
                fp = np.array([fingerprint(t, shingle) for t in part.column(2).to_pylist()], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(fp)], names=["doc_id", "key", "fp"])

    src = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), C.row_key(doc_id, text).alias("key"), F.col(f"`{text}`").alias("text"))
    return src.mapInArrow(run, "doc_id long, key string, fp long")


def _dealt(buckets: int):
    """Fingerprints -> for each bucket of table keys, those that fall into it, packed."""
    def run(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            key = (fp[:, None] & MASKS).ravel()
            table = np.tile(np.arange(len(MASKS), dtype=np.uint8), len(fp))
            mixed = (key ^ (table.astype(np.uint64) << np.uint64(57))) * np.uint64(0x9E3779B97F4A7C15)
            at = ((mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(33)) % np.uint64(buckets)
            order = np.argsort(at, kind="stable")
            at, fps, table = at[order], np.repeat(fp, len(MASKS))[order], table[order]
            cut = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.empty(0, int)
            to = np.r_[cut[1:], len(at)] if len(at) else cut
            yield pa.RecordBatch.from_arrays([
                pa.array(at[cut].astype(np.int32)), pa.array([fps[i:j].tobytes() for i, j in zip(cut, to)], pa.binary()),
                pa.array([table[i:j].tobytes() for i, j in zip(cut, to)], pa.binary())], names=["bucket", "fps", "tables"])
    return run


def stars(nodes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least node that each of ``nodes`` (sorted) reaches over the links a - b."""
    i, j = np.searchsorted(nodes, a), np.searchsorted(nodes, b)
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            return nodes[label]
        label = new


def _linked(got: pa.Table) -> pa.Table:
    """The fingerprints of a bucket that have a partner, with the least they reach here."""
    fps = np.frombuffer(b"".join(got.column("fps").to_pylist()), np.uint64)
    tables = np.frombuffer(b"".join(got.column("tables").to_pylist()), np.uint8)
    key = fps & MASKS[tables]
    order = np.lexsort((fps, key, tables))
    fps, key, tables = fps[order], key[order], tables[order]
    same = (key[1:] == key[:-1]) & (tables[1:] == tables[:-1])
    run = np.cumsum(np.r_[True, ~same]) if len(fps) else np.empty(0, int)
    left, right, d = [], [], 1
    at = np.flatnonzero(same)
    while len(at):
        near = np.bitwise_count(fps[at] ^ fps[at + d]) <= RADIUS
        left.append(fps[at[near]])
        right.append(fps[at[near] + d])
        d += 1
        at = at[at + d < len(fps)]
        at = at[run[at] == run[at + d]]
    a = np.concatenate(left) if left else np.empty(0, np.uint64)
    b = np.concatenate(right) if right else np.empty(0, np.uint64)
    a, b = a.view(np.int64), b.view(np.int64)
    nodes = np.unique(np.r_[a, b])
    root = stars(nodes, a, b)
    return pa.table({"a": nodes[nodes != root], "b": root[nodes != root]})


def components(links: DataFrame) -> DataFrame:
    """Links (a, b: longs, a != b) -> node, root: every linked node that is not the least of
    its component, with that least node. Large-star and small-star steps over stored
    tables; a node with very many links is handled by ``common.attach``."""
    spark = links.sparkSession

    def star(edges: DataFrame, large: bool) -> DataFrame:
        if large:  # every neighbour above the node is linked to the least one around
            both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        else:  # u > v already: the node and its lower neighbours are linked to the least
            both = edges
        least = cut_lineage(both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")))
        joined = C.attach(both, least, ["u"], "n", ["m"], F.col("v"))
        m = F.least("u", "m")
        if large:
            new = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), m.alias("v"))
        else:
            new = joined.select(F.col("v").alias("u"), m.alias("v")).union(least.select("u", F.least("u", "m").alias("v")))
        return cut_lineage(new.where(F.col("u") != F.col("v")).distinct())

    def state(edges: DataFrame):
        return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    edges = cut_lineage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    now = state(edges)
    while now[0]:
        edges = star(star(edges, True), False)
        before, now = now, state(edges)
        if now == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def link(prints: DataFrame) -> DataFrame:
    """Stored fingerprints (doc_id, key, fp) -> fp, n (its rows), component_id and the row
    (doc_id, key) that stands for the component; one row per fingerprint."""
    spark = prints.sparkSession
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    each = cut_lineage(prints.groupBy("fp").agg(F.min(rank).alias("rep"), F.count(F.lit(1)).alias("n")))
    buckets = max(C.shuffle_partitions(spark), -(-each.count() * len(MASKS) // PER_TASK))
    dealt = each.select("fp").mapInArrow(_dealt(buckets), "bucket int, fps binary, tables binary")
    links = dealt.groupBy("bucket").applyInArrow(_linked, "a long, b long")
    comp = components(links)
    rooted = cut_lineage(each.join(comp, each["fp"] == comp["node"], "left").select("fp", "n", "rep", F.coalesce("root", "fp").alias("root")))
    named = cut_lineage(rooted.groupBy("root").agg(F.min("rep").alias("first"), F.count(F.lit(1)).alias("size")))
    out = C.attach(rooted, named, ["root"], "size", ["first"], F.col("fp"))
    return cut_lineage(out.select("fp", "n", F.col("first.doc_id").alias("component_id"), F.col("first.key").alias("component_key")))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, key, fp, component_id and component_key of every row."""
    prints = cut_lineage(fingerprints(docs, shingle, doc_id, text))
    return C.attach(prints, link(prints), ["fp"], "n", ["component_id", "component_key"], F.col("key"))


def keep_documents(docs: DataFrame, shingle: int = SHINGLE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, that of its smallest doc_id, with the columns of ``docs``."""
    stay = near_duplicates(docs, shingle, doc_id, text).where(F.col("key") == F.col("component_key")).select(
        F.col("key").alias(C.internal(docs, "stay"))).distinct()
    key = C.internal(docs, "row_key")
    rows = docs.withColumn(key, C.row_key(doc_id, text)).join(stay, F.col(key) == F.col(C.internal(docs, "stay")), "left_semi")
    first = C.internal(docs, "row_no")
    rows = rows.withColumn(first, F.row_number().over(Window.partitionBy(key).orderBy(F.lit(1))))
    return rows.where(F.col(first) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])


def op9_simhash_dedup(spark, sf_dir: str) -> DataFrame:
    """Query: fingerprint and component of every document."""
    out = near_duplicates(C.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
