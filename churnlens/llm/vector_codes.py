"""Vector code compression: anchors-hierarchy metric trees over parts.

A vector's components become integers, the vector is cut into ``PARTS`` equal consecutive
parts, and every part position has a codebook of at most ``ENTRIES`` entries, improved by
``ROUNDS`` rounds of exact k-means. Rows are read once into blocks of ``BLOCK`` vectors; a
block has one metric tree for each part position, built middle-out: about sqrt(n) anchors
are placed, each at the point furthest from its anchor (an anchor only gives up points that
are nearer to the new one, and none closer to it than half the distance between both),
anchors are merged in pairs of the least ball up to the root, and each anchor's own points
are treated the same way down to ``LEAF`` points. A ball caches its centre, radius, sum and
count.

A round sends the codebooks (fixed size) to the stored trees. Each ball inherits the
entries that can still be nearest to a point of its parent and keeps those e with
dist(centre, e) <= least dist + 2 radius; a ball with one entry left is owned by it and
adds its cached sum and count, all others go on to their children and at leaves to the
points, where exact integer distances decide (ties: the lower index). Balls of one depth
are handled together as arrays. Only sums and counts by part and entry leave a task: they
are added by Spark, and a few thousand numbers reach the driver each round.

Defined results: rows whose vector is null or holds null or non-finite components are
dropped; a null id is coded like any other and comes last among the first entries; of rows
that repeat an id the smaller vector comes first; shorter vectors count as padded with
zeros to the greatest length, itself rounded up to a multiple of ``PARTS``; components
beyond +-2^24 after scaling count as that; an entry without points stays as it is; an empty
table gives an empty result; other columns pass through whatever their names.
"""

from __future__ import annotations

import hashlib
import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from ..session import cut_lineage
from . import common as C

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
BLOCK, LEAF, LIMIT = 4096, 48, 1 << 24
#: Points compared with all entries at once.
_STEP = 4096


class Tree:
    """Metric tree over the rows of ``points`` (integers): balls in the order of their
    depth, each with a run of ``order``; children of a ball are ``kids[first:stop]``."""

    __slots__ = ("order", "centre", "radius", "sums", "start", "stop", "levels", "parent", "leaf")


def _anchors(x: np.ndarray, k: int) -> list[np.ndarray]:
    """At most ``k`` anchors of the points ``x``: the points of each. A new anchor looks
    only at points further from theirs than half the distance of both anchors."""
    at = [0]
    dist, owner = np.sqrt(((x - x[0]) ** 2).sum(1)), np.zeros(len(x), np.int64)
    while len(at) < k:
        new = int(dist.argmax())
        if dist[new] <= 0:
            break
        gap = np.sqrt(((x[at] - x[new]) ** 2).sum(1))
        some = np.flatnonzero(dist > (gap / 2)[owner])
        to = np.sqrt(((x[some] - x[new]) ** 2).sum(1))
        steal = to < dist[some]
        some = some[steal]
        dist[some], owner[some] = to[steal], len(at)
        at.append(new)
    by = np.argsort(owner, kind="stable")
    return [g for g in np.split(by, np.cumsum(np.bincount(owner, minlength=len(at)))[:-1]) if len(g)]


def build(points: np.ndarray) -> Tree:
    """The tree of a block; distances of the build are doubles, sums are exact integers."""
    x = points.astype(np.float64)
    out = Tree()
    start, stop, radius, centre, depth, parent = [], [], [], [], [], []

    def ball(lo: int, hi: int, c: np.ndarray, r: float, up: int, deep: int) -> int:
        start.append(lo), stop.append(hi), centre.append(c), radius.append(r), parent.append(up), depth.append(deep)
        return len(start) - 1

    # groups of point numbers still to be made into balls, last one first
    todo: list[tuple[np.ndarray, int, int, int]] = [(np.arange(len(x)), -1, 0, 0)]
    order = np.empty(len(x), np.int64)
    while todo:
        ids, up, deep, lo = todo.pop()
        y = x[ids]
        c = y.mean(0)
        r = float(np.sqrt(((y - c) ** 2).sum(1).max())) if len(ids) else 0.0
        if len(ids) <= LEAF or not (y != y[0]).any():
            if len(ids):
                r = 0.0 if not (y != y[0]).any() else r
                c = y[0] if r == 0.0 else c
            ball(lo, lo + len(ids), c, r, up, deep)
            order[lo:lo + len(ids)] = ids
            continue
        groups = _anchors(y, max(2, round(len(ids) ** 0.5)))
        # merge the two balls of the least joint radius until one is left
        mid = np.array([y[g].mean(0) for g in groups])
        wide = np.array([np.sqrt(((y[g] - m) ** 2).sum(1).max()) for g, m in zip(groups, mid)])
        size = np.array([len(g) for g in groups], np.float64)
        nodes: list = list(groups)
        apart = np.sqrt(((mid[:, None] - mid[None]) ** 2).sum(2))
        joint = np.maximum((apart + wide[:, None] + wide[None]) / 2, np.maximum(wide[:, None], wide[None]))
        np.fill_diagonal(joint, np.inf)
        for _ in range(len(groups) - 1):
            i, j = divmod(int(joint.argmin()), len(joint))
            i, j = min(i, j), max(i, j)
            total = size[i] + size[j]
            m = (mid[i] * size[i] + mid[j] * size[j]) / total
            w = max(float(np.sqrt(((mid[i] - m) ** 2).sum())) + wide[i], float(np.sqrt(((mid[j] - m) ** 2).sum())) + wide[j])
            nodes[i], mid[i], wide[i], size[i] = (nodes[i], nodes[j], m, w), m, w, total
            joint[j, :] = joint[:, j] = np.inf
            live = np.isfinite(joint[i])
            live[i] = live[j] = False
            gap = np.sqrt(((mid[live] - m) ** 2).sum(1))
            joint[i, live] = joint[live, i] = np.maximum((gap + w + wide[live]) / 2, np.maximum(w, wide[live]))
            nodes[j] = None
        top = next(n for n in nodes if n is not None)
        walk = [(top, up, deep, lo)]
        while walk:
            node, above, at, pos = walk.pop()
            if isinstance(node, np.ndarray):
                todo.append((ids[node], above, at, pos))
                continue
            left, right, m, w = node
            n_left, n_all = _points_in(left), _points_in(node)
            me = ball(pos, pos + n_all, m, w, above, at)
            walk += [(right, me, at + 1, pos + n_left), (left, me, at + 1, pos)]
    at = np.argsort(np.array(depth), kind="stable")
    back = np.empty(len(at), np.int64)
    back[at] = np.arange(len(at))
    parent = np.array(parent)[at]
    out.parent = np.where(parent >= 0, back[parent], -1)
    out.order, out.start, out.stop = order, np.array(start)[at], np.array(stop)[at]
    out.centre, out.radius = np.array(centre).reshape(len(at), -1)[at], np.array(radius)[at]
    deep = np.array(depth)[at]
    out.levels = np.searchsorted(deep, np.arange(deep.max() + 2))
    out.leaf = np.ones(len(at), bool)
    out.leaf[out.parent[out.parent >= 0]] = False
    run = np.zeros((len(x) + 1, points.shape[1]), np.int64)
    np.cumsum(points[order], axis=0, out=run[1:])
    out.sums = run[out.stop] - run[out.start]
    return out


def _points_in(node) -> int:
    n, todo = 0, [node]
    while todo:
        x = todo.pop()
        if isinstance(x, np.ndarray):
            n += len(x)
        else:
            todo += x[:2]
    return n


def _exact(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of integer points and entries; doubles hold them exactly if small."""
    most = max(int(np.abs(points).max(initial=0)), int(np.abs(book).max(initial=0)))
    kind = np.float64 if 4 * most * most * max(1, points.shape[1]) < 1 << 53 else np.int64
    p, b = points.astype(kind), book.astype(kind)
    return (p * p).sum(1)[:, None] - 2 * (p @ b.T) + (b * b).sum(1)[None]


def _add(sums: np.ndarray, counts: np.ndarray, who: np.ndarray, points: np.ndarray, n: np.ndarray | None = None) -> None:
    by = np.argsort(who, kind="stable")
    at = np.flatnonzero(np.r_[True, who[by][1:] != who[by][:-1]])
    sums[who[by][at]] += np.add.reduceat(points[by], at, axis=0)
    counts[who[by][at]] += np.diff(np.r_[at, len(by)]) if n is None else np.add.reduceat(n[by], at)


def _members(tree: Tree, balls: np.ndarray) -> np.ndarray:
    return np.concatenate([tree.order[a:b] for a, b in zip(tree.start[balls].tolist(), tree.stop[balls].tolist())])


def assign(tree: Tree, points: np.ndarray, book: np.ndarray, each: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Sums and counts of the points nearest to each entry of ``book``; with ``each`` also
    the entry of every point."""
    k, n = len(book), len(points)
    sums, counts = np.zeros((k, points.shape[1]), np.int64), np.zeros(k, np.int64)
    entry = np.zeros(n, np.int64) if each else None
    entries = book.astype(np.float64)
    square = (entries * entries).sum(1)
    size = tree.stop - tree.start
    may = np.ones((1, k), bool)  # one row of entries for each ball of the level before that is still open
    row = np.zeros(1, np.int64)  # ball -> its row, or -1
    for level, (a, b) in enumerate(zip(tree.levels[:-1].tolist(), tree.levels[1:].tolist())):
        balls = np.arange(a, b)
        above = row[tree.parent[balls] - first] if level else np.zeros(1, np.int64)
        balls, above = balls[above >= 0], above[above >= 0]
        first, row = a, np.full(b - a, -1)
        if not len(balls):
            break
        c = tree.centre[balls]
        dist = np.sqrt(np.maximum((c * c).sum(1)[:, None] - 2 * (c @ entries.T) + square, 0.0))
        dist[~may[above]] = np.inf
        # the margin covers the rounding of the doubles, so that no nearest or tied entry is lost
        slack = 1e-6 * (1.0 + np.sqrt((c * c).sum(1)) + np.sqrt(square.max()))
        may = dist <= (dist.min(1) + 2 * tree.radius[balls] + slack)[:, None]
        owned = may.sum(1) == 1
        if owned.any():
            who = may[owned].argmax(1)
            _add(sums, counts, who, tree.sums[balls[owned]], size[balls[owned]])
            if each:
                entry[_members(tree, balls[owned])] = np.repeat(who, size[balls[owned]])
        balls, may = balls[~owned], may[~owned]
        leaf = tree.leaf[balls]
        if leaf.any():
            ids, rows = _members(tree, balls[leaf]), np.repeat(np.flatnonzero(leaf), size[balls[leaf]])
            for s in range(0, len(ids), _STEP):
                some = ids[s:s + _STEP]
                d = _exact(points[some], book)
                d[~may[rows[s:s + _STEP]]] = np.inf if d.dtype == np.float64 else np.iinfo(np.int64).max
                who = d.argmin(1)
                _add(sums, counts, who, points[some])
                if each:
                    entry[some] = who
        row[balls[~leaf] - a] = np.flatnonzero(~leaf)
    return sums, counts, entry


def _packed(tree: Tree) -> bytes:
    out = io.BytesIO()
    np.savez(out, **{x: getattr(tree, x) for x in Tree.__slots__})
    return out.getvalue()


def _unpacked(data: bytes) -> Tree:
    out, got = Tree(), np.load(io.BytesIO(data))
    for x in Tree.__slots__:
        setattr(out, x, got[x])
    return out


def _integers(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have a whole finite vector, and the integers of those, padded to ``width``."""
    lists = column.cast(pa.list_(pa.float64()))
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten() if not lists.null_count else lists.values.slice(lists.offsets[0].as_py(), lists.offsets[-1].as_py() - lists.offsets[0].as_py())
    x = flat.to_numpy(zero_copy_only=False)  # null components become nan
    whole = np.ones(len(lists), bool) if not lists.null_count else lists.is_valid().to_numpy(zero_copy_only=False)
    at = np.repeat(np.arange(len(lists)), sizes)
    whole[at[~np.isfinite(x)]] = False
    out = np.zeros((len(lists), width), np.int64)
    fits = whole[at]
    pos = np.arange(len(x)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[at[fits], pos[fits]] = np.clip(np.floor(x[fits] * SCALE), -LIMIT, LIMIT).astype(np.int64)
    return whole, out[whole]


def _kept(vec: str):
    x = F.col(f"`{vec}`").cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return x.isNotNull() & ~F.coalesce(bad, F.lit(True))


def first_books(rows: DataFrame, vec_id: str, vec: str, width: int) -> list[np.ndarray]:
    """The first codebooks: the parts of the vectors with the smallest ids."""
    id_ = F.col(f"`{vec_id}`")
    top = (rows.where(_kept(vec)).select(id_.alias("i"), F.col(f"`{vec}`").cast("array<double>").alias("v"))
           .orderBy(F.col("i").asc_nulls_last(), "v").limit(ENTRIES).toArrow().combine_chunks())
    x = _integers(top.column("v").combine_chunks() if top.num_rows else pa.array([], pa.list_(pa.float64())), width)[1]
    return [x[:, p * width // PARTS:(p + 1) * width // PARTS] for p in range(PARTS)]


def blocks_of(rows: DataFrame, vec: str, keep: list[str], width: int) -> DataFrame:
    """Blocks of kept rows: their points, one tree a part, and the columns to keep."""
    col = C.internal(rows, "vector")
    src = rows.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{vec}`").cast("array<double>").alias(col))
    w = width // PARTS

    def made(held: list[tuple[pa.RecordBatch, np.ndarray]]) -> pa.RecordBatch:
        points = np.concatenate([x for _, x in held])
        trees = [_packed(build(points[:, p * w:(p + 1) * w])) for p in range(PARTS)]
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, held[0][0].schema) as to:
            for batch, _ in held:
                to.write_batch(batch)
        return pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in (points.astype(np.int32).tobytes(), *trees, out.getvalue().to_pybytes())], names=names)

    names = ["points", *[f"tree_{p}" for p in range(PARTS)], "kept"]

    def run(batches):
        held, n = [], 0
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                part = batch.slice(a, BLOCK)
                whole, x = _integers(part.column(part.num_columns - 1), width)
                if len(x):
                    held.append((pa.RecordBatch.from_arrays(part.columns[:-1], names=[f"c{i}" for i in range(len(keep))]).filter(pa.array(whole)), x))
                    n += len(x)
                if n >= BLOCK:
                    yield made(held)
                    held, n = [], 0
        if held:
            yield made(held)

    return src.mapInArrow(run, ", ".join(f"{x} binary" for x in names))


def _block(batch: pa.RecordBatch, width: int):
    for i in range(batch.num_rows):
        points = np.frombuffer(batch.column("points")[i].as_py(), np.int32).reshape(-1, width).astype(np.int64)
        w = width // PARTS
        yield i, [(_unpacked(batch.column(f"tree_{p}")[i].as_py()), points[:, p * w:(p + 1) * w]) for p in range(PARTS)]


def improve(blocks: DataFrame, books: list[np.ndarray], width: int) -> list[np.ndarray]:
    """One round: the books with every used entry moved to the floor of its points' mean."""
    k, w = len(books[0]), width // PARTS

    def run(batches):
        sums, counts = np.zeros((PARTS, k, w), np.int64), np.zeros((PARTS, k), np.int64)
        for batch in batches:
            for _, parts in _block(batch, width):
                for p, (tree, points) in enumerate(parts):
                    s, c, _ = assign(tree, points, books[p])
                    sums[p] += s
                    counts[p] += c
        used = np.flatnonzero(counts.ravel())
        table = np.concatenate([counts.reshape(-1, 1), sums.reshape(-1, w)], axis=1)[used]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(used, w + 1).astype(np.int32)), pa.array(np.tile(np.arange(w + 1), len(used)).astype(np.int32)), pa.array(table.ravel())], names=["entry", "pos", "v"])

    got = (blocks.select("points", *[f"tree_{p}" for p in range(PARTS)]).mapInArrow(run, "entry int, pos int, v long")
           .groupBy("entry", "pos").agg(F.sum("v").alias("v")).toArrow())  # PARTS x ENTRIES x (width of a part + 1) rows at most
    total = np.zeros((PARTS * k, w + 1), np.int64)
    total[got.column("entry").to_numpy(), got.column("pos").to_numpy()] = got.column("v").to_numpy()
    total = total.reshape(PARTS, k, w + 1)
    out = []
    for p in range(PARTS):
        used = total[p, :, 0] > 0
        new = books[p].copy()
        new[used] = total[p, used, 1:] // total[p, used, :1]
        out.append(new)
    return out


def compress(rows: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", keep: list[str] | None = None,
             rounds: int = ROUNDS) -> tuple[DataFrame, dict[str, str], list[np.ndarray]]:
    """The columns ``keep`` (all but the vector if None) of the kept rows plus their entries
    (array of ``PARTS`` ints) and squared error, the new columns' names by role, and the
    final codebooks."""
    keep = [c for c in rows.columns if c != vec] if keep is None else keep
    names = {x: C.internal(rows, x) for x in ("entries", "error")}
    longest = rows.where(_kept(vec)).agg(F.max(F.size(F.col(f"`{vec}`")))).first()[0] or 0
    width = max(PARTS, -(-longest // PARTS) * PARTS)
    books = first_books(rows, vec_id, vec, width)
    kept = rows.select(*[F.col(f"`{c}`") for c in keep])
    schema = StructType([*kept.schema.fields, StructField(names["entries"], ArrayType(IntegerType())), StructField(names["error"], LongType())])
    if not len(books[0]):
        return rows.sparkSession.createDataFrame([], schema), names, books
    blocks = cut_lineage(blocks_of(rows, vec, keep, width))
    for _ in range(rounds):
        books = improve(blocks, books, width)

    def run(batches):
        for batch in batches:
            for i, parts in _block(batch, width):
                entries, error = [], 0
                for p, (tree, points) in enumerate(parts):
                    entries.append(assign(tree, points, books[p], each=True)[2])
                    error = error + ((points - books[p][entries[-1]]) ** 2).sum(1)
                flat = pa.array(np.stack(entries, 1).astype(np.int32).ravel())
                rows_ = pa.ipc.open_stream(batch.column("kept")[i].as_py()).read_all().combine_chunks()
                codes = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, PARTS, dtype=np.int32)), flat)
                cols = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in rows_.columns]
                yield pa.RecordBatch.from_arrays([*[c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in cols], codes, pa.array(error)], names=schema.names)

    return blocks.mapInArrow(run, schema), names, books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of the decimal components by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.ravel()).encode()).hexdigest()


def op11_vector_codes(spark, sf_dir: str) -> DataFrame:
    """Query: code and error of every kept vector, the error of its label, and the digest
    of the final codebooks."""
    coded, n, books = compress(C.table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    code = F.array_join(F.transform(n["entries"], lambda e: F.lower(F.lpad(F.hex(e), 2, "0"))), "")
    key = F.when(F.col("label").isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), F.col("label").cast("string")))
    rows = cut_lineage(coded.select("vec_id", code.alias("code"), F.col(n["error"]).alias("error"), key.alias("key")))
    labels = cut_lineage(rows.groupBy("key").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")))
    out = C.attach(rows, labels, ["key"], "n", ["label_error"], F.col("vec_id"))
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _sql() -> str:
    """The contract for vectors of one length that 4 divides, round by round."""
    def nearest(book: str) -> str:
        return (f"SELECT p.r, p.part, min({{'d': CAST(p.sq - 2 * list_dot_product(p.v, b.v) + b.sq AS BIGINT), 'e': b.entry}}) AS x "
                f"FROM p JOIN {book} b ON b.part = p.part GROUP BY p.r, p.part")

    rounds = "".join(f"""
a{i} AS MATERIALIZED ({nearest(f'b{i}')}),
m{i} AS MATERIALIZED (
  SELECT part, entry, list(c ORDER BY pos) AS v FROM (
    SELECT p.part, a.x.e AS entry, u.pos, floor(sum(p.v[u.pos]) / count(*)) AS c
    FROM a{i} a JOIN p ON p.r = a.r AND p.part = a.part, LATERAL (SELECT unnest(range(1, len(p.v) + 1)) AS pos) u GROUP BY 1, 2, 3) GROUP BY 1, 2),
b{i + 1} AS MATERIALIZED (
  SELECT o.part, o.entry, coalesce(m.v, o.v) AS v, list_dot_product(coalesce(m.v, o.v), coalesce(m.v, o.v)) AS sq
  FROM b{i} o LEFT JOIN m{i} m ON m.part = o.part AND m.entry = o.entry),""" for i in range(ROUNDS))
    return f"""
WITH k AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r,
         list_transform(embedding, lambda c: floor({SCALE} * CAST(c AS DOUBLE))) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
q AS (SELECT k.r, u.part, k.v[u.part * (len(k.v) // {PARTS}) + 1:(u.part + 1) * (len(k.v) // {PARTS})] AS v
      FROM k, LATERAL (SELECT unnest(range({PARTS})) AS part) u),
p AS MATERIALIZED (SELECT *, list_dot_product(v, v) AS sq FROM q),
b0 AS MATERIALIZED (SELECT part, r - 1 AS entry, v, sq FROM p WHERE r <= {ENTRIES}),{rounds}
last AS MATERIALIZED ({nearest(f'b{ROUNDS}')}),
coded AS (SELECT r, string_agg(printf('%02x', x.e), '' ORDER BY part) AS code, CAST(sum(x.d) AS BIGINT) AS error FROM last GROUP BY r),
digest AS (SELECT sha256(string_agg(CAST(CAST(c AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, pos)) AS sha
           FROM (SELECT part, entry, unnest(v) AS c, unnest(range(len(v))) AS pos FROM b{ROUNDS}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT sha FROM digest) AS codebooks_sha256
FROM k JOIN coded USING (r)
"""


SQL = _sql()
