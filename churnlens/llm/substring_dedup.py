"""Suffix-array dedup: threshold-bounded interval expansion on a Burrows-Wheeler transform.

A byte goes if a 50-byte string that covers it also starts in a document with a smaller id.
Equal strings are brought together by content, in two shuffles, and compared by a
Burrows-Wheeler transform (BWT) of what meets:

1. Anchors. Every 50-byte window has an anchor, the least hash of its 24-byte substrings,
   which equal windows share. Runs of windows with one anchor are the unit. A map task
   reports each anchor once, however many of its documents hold it, so a frequent passage
   adds one entry a task to its bucket. Anchors of two documents or more make candidates.
2. Candidate runs (at most 76 bytes) are dealt by anchor. A map task sends equal runs
   once, for their smallest id; the other documents' runs are removed at once.
3. An anchor whose runs all have one text needs no comparison. Of the others each bucket
   builds the BWT. From the empty string, all intervals are extended backward by one
   character at a time (the rows of c w are found from those of w by the transform's map),
   so boundaries appear by increasing length of the common prefix, up to 50, where the
   expansion stops. The suffixes of an interval left then share 50 bytes; its smallest id
   decides which windows go.
4. Removed windows go back to their documents, where overlapping ones are joined.

Documents are dealt out by id once for both joins. Every list that meets in a task is
bounded by distinct content times map tasks, or by one document.

Defined results: null text is empty; a text of fewer than 50 bytes loses nothing; rows of
one id don't affect each other, and equal rows get equal results; a null doc_id counts as
larger than all others; a text is judged on the input, so chains of copies all lose the
shared bytes but the first; texts of any length are read whole (in blocks); an empty
table gives an empty result; columns beyond doc_id and text are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Shorter anchors would meet by chance, the more of them the larger the input; longer ones
#: make more and shorter runs, which overlap.
LENGTH, MER = 50, 24
#: Windows hashed at once, anchors a map task gathers before it reports them, bytes of
#: candidate runs likewise, and bytes of one transform.
BLOCK, ANCHORS, RUN_BYTES, BWT_BYTES = 1 << 18, 1 << 20, 32 << 20, 1 << 18
#: Text bytes for each bucket of anchors, of documents and of candidate runs; of the last
#: there are several a partition, so that chance does not give one task many.
ANCHOR_BUCKET, DOC_BUCKET, RUN_BUCKET = 64 << 20, 16 << 20, 4 << 20
LAST = np.iinfo(np.int64).max
_C1, _C2, _C3, _C4 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _grow(h: np.ndarray, by: int) -> np.ndarray:
    return h[:-by] << np.uint64(8 * by) | h[by:]


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    done = 1
    while done * 2 <= width:
        h = np.minimum(h[:-done], h[done:])
        done *= 2
    more = width - done
    return np.minimum(h[:-more], h[more:]) if more else h


def runs(texts: list[bytes]):
    """Runs of windows with one anchor: (text index, start, windows, anchor), block by
    block of at most ``BLOCK`` windows; a run across blocks comes in two."""
    todo, size = [], 0
    for d, t in enumerate(texts):
        for a in range(0, len(t) - LENGTH + 1, BLOCK):
            part = t[a:a + BLOCK + LENGTH - 1]
            if size + len(part) > BLOCK + LENGTH and todo:
                yield _runs(todo)
                todo, size = [], 0
            todo.append((d, a, part))
            size += len(part)
    if todo:
        yield _runs(todo)


def _runs(parts):
    lens = np.array([len(p) for _, _, p in parts])
    h = np.frombuffer(b"".join(p for _, _, p in parts), np.uint8).astype(np.uint64)
    h = _grow(_grow(_grow(h, 1), 2), 4)
    h = h[:-16] * _C1 + h[8:-8] * _C2 + h[16:] * _C4
    h ^= h >> np.uint64(29)
    h *= _C3
    h ^= h >> np.uint64(32)
    h = _least(h, LENGTH - MER + 1)
    first = np.cumsum(lens) - lens
    own = lens - LENGTH + 1
    new = np.zeros(len(h) + 1, bool)
    new[1:-1] = h[1:] != h[:-1]
    new[first] = True
    gap = np.zeros(len(h) + 1, np.int32)  # windows that reach into the next part
    np.add.at(gap, first, 1)
    np.add.at(gap, np.minimum(first + own, len(h)), -1)
    inside = np.cumsum(gap)[:len(h)] > 0
    at = np.flatnonzero(new[:len(h)] & inside)
    part = np.searchsorted(first, at, "right") - 1
    end = np.minimum(np.r_[at[1:], len(h)], (first + own)[part])
    doc, off = np.array([d for d, _, _ in parts]), np.array([a for _, a, _ in parts])
    return doc[part], at - first[part] + off[part], end - at, h[at]


def _bytes(column) -> list[bytes]:
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


_ANCHOR = "bucket int, lows binary, keys binary, counts binary, shared binary, own_lows binary, own_keys binary, own_counts binary"
#: Of what is sent, runs, ids of anchors and their counts.
_CODEC = pa.Codec("zstd")


def _pack(values: bytes) -> bytes:
    """The bytes compressed, behind their number."""
    return len(values).to_bytes(8, "little") + _CODEC.compress(values, asbytes=True) if values else b""


def _unpack(packed: bytes) -> bytes:
    return _CODEC.decompress(packed[8:], int.from_bytes(packed[:8], "little"), asbytes=True) if packed else b""


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before in any of the columns."""
    n = len(columns[0])
    return np.flatnonzero(np.r_[True, np.any([c[1:] != c[:-1] for c in columns], 0)]) if n else np.empty(0, int)


def _deal(place: np.ndarray, keys: np.ndarray, lows: np.ndarray):
    """For each place (ascending) its keys as differences, how many lows each has, and the
    lows in the order of the keys. Entries come by place, then key."""
    at = _starts(place, keys)
    counts = np.diff(np.r_[at, len(keys)]).astype(np.uint32)
    cut = _starts(place[at])
    for i, j in zip(cut.tolist(), [*cut[1:].tolist(), len(at)]):
        a, b = at[i], at[j] if j < len(at) else len(keys)
        yield int(place[a]), lows[a:b].tobytes(), _pack(np.diff(keys[at[i:j]], prepend=0).tobytes()), _pack(counts[i:j].tobytes())


def _by_place(place: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """An order by place, then key."""
    order = np.argsort(keys)
    return order[np.argsort(place[order].astype(np.uint16) if len(place) and place.max() < 1 << 16 else place[order], kind="stable")]


def _joined(table: pa.Table, column: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(x for x in table.column(column).to_pylist() if x), kind)


def _dealt(table: pa.Table, keys: str, counts: str) -> np.ndarray:
    """For each low of ``_deal`` its key."""
    found = [np.repeat(np.cumsum(np.frombuffer(_unpack(k), np.int64)), np.frombuffer(_unpack(n), np.uint32))
             for k, n in zip(table.column(keys).to_pylist(), table.column(counts).to_pylist()) if k]
    return np.concatenate(found) if found else np.empty(0, np.int64)


def _report_anchors(buckets: int):
    """Rows for the buckets of anchors, and for documents whose anchors another document
    of the same task has (key and lows)."""
    def flush(found, keys):
        doc, anchor = (np.concatenate(x) for x in zip(*found))
        key = np.array(keys, np.int64)
        code = ((anchor >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32) | anchor & np.uint64(0xFFFFFFFF)).astype(np.int64)
        order = np.argsort(code)
        code, doc = code[order], doc[order]
        start = _starts(code)
        code = code[start]
        # each document once for an anchor
        pairs = np.sort(np.repeat(np.arange(len(start)) << 32, np.diff(np.r_[start, len(doc)])) | doc)
        pairs = pairs[_starts(pairs)]
        which, doc = pairs >> 32, pairs & 0xFFFFFFFF
        many = np.bincount(which) > 1
        own, shared = many[which], code[many]
        code = code[which]
        out: dict[int, list] = {}
        for first, here in ((0, ~own), (4, own)):
            at = code[here] >> 32
            order = _by_place(at, doc[here])
            for b, *cols in _deal(at[order], key[doc[here][order]], (code[here][order] & 0xFFFFFFFF).astype(np.uint32)):
                out.setdefault(b, [b""] * 7)[first:first + 3] = cols
        cut = _starts(shared >> 32)
        for i, j in zip(cut, [*cut[1:], len(shared)]):
            out[int(shared[i] >> 32)][3] = (shared[i:j] & 0xFFFFFFFF).astype(np.uint32).tobytes()
        out = [(b, *cols) for b, cols in out.items()]
        cols = list(zip(*out))
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]],
                                         names=[c.split()[0] for c in _ANCHOR.split(", ")])

    def run(batches):
        found, keys, size = [], [], 0
        for batch in batches:
            for a, b in C.blocks(batch, "text"):
                part = batch.slice(a, b - a)
                base = len(keys)
                keys += part.column(0).to_pylist()
                for doc, _, _, anchor in runs(_bytes(part.column(1))):
                    found.append((doc + base, anchor))
                    size += len(anchor)
                    if size >= ANCHORS:
                        yield from flush(found, keys)
                        found, size = [], 0
                if not found:
                    keys = []
        if found:
            yield from flush(found, keys)
    return run


def _shared_anchors(parts: int):
    """The anchors of a bucket that two documents have, dealt by document."""
    def run(got: pa.Table) -> pa.Table:
        lows, keys = _joined(got, "lows", np.uint32), _dealt(got, "keys", "counts")
        order = np.argsort(lows)
        lows, keys = lows[order], keys[order]
        start = _starts(lows)
        size = np.diff(np.r_[start, len(lows)])
        # entries are distinct in a report of a task: two entries are two rows
        take = np.repeat((size > 1) | np.isin(lows[start], _joined(got, "shared", np.uint32)), size)
        lows = np.r_[_joined(got, "own_lows", np.uint32), lows[take]]
        keys = np.r_[_dealt(got, "own_keys", "own_counts"), keys[take]]
        to = keys % parts
        order = _by_place(to, keys)
        out = list(_deal(to[order], keys[order], lows[order]))
        cols = list(zip(*out)) if out else [[]] * 4
        return pa.table({"part": pa.array(cols[0], pa.int32()), **{n: pa.array(c, pa.binary()) for n, c in zip(("lows", "keys", "counts"), cols[1:])}})
    return run


def _document_anchors(got: pa.Table) -> pa.Table:
    """One row per document with its shared anchors."""
    lows, keys = _joined(got, "lows", np.uint32), _dealt(got, "keys", "counts")
    order = np.argsort(keys)
    lows, keys = lows[order], keys[order]
    at = _starts(keys)
    return pa.table({"k": pa.array(keys[at], pa.int64()), "lows": pa.array([lows[i:j].tobytes() for i, j in zip(at.tolist(), [*at[1:].tolist(), len(keys)])], pa.binary())})


#: An entry's id is its key, or LAST where ``unnamed`` says so.
_RUN = "bucket int, spans binary, runs binary, lens binary, unnamed binary, lows binary, owners binary, places binary"
_RUN_NAMES = [c.split()[0] for c in _RUN.split(", ")]


def _row(**values) -> tuple:
    return tuple(values.get(n) for n in _RUN_NAMES)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in _RUN_NAMES]
    kinds = [pa.int32()] + [pa.binary()] * 7
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=_RUN_NAMES)


def _merged(spans: np.ndarray) -> np.ndarray:
    """Spans (key, fp, start, end) in order, with those of a row that touch joined."""
    if not len(spans):
        return spans.reshape(0, 4)
    keys, fps, starts, ends = spans[np.lexsort((spans[:, 3], spans[:, 2], spans[:, 1], spans[:, 0]))].T
    row = np.r_[True, (keys[1:] != keys[:-1]) | (fps[1:] != fps[:-1])]
    # the furthest end so far in the row: ends are made to grow from row to row
    base = np.cumsum(row) * (int(ends.max()) + 1)
    reach = np.maximum.accumulate(ends + base) - base
    at = np.flatnonzero(row | np.r_[True, starts[1:] > reach[:-1]])
    return np.stack([keys[at], fps[at], starts[at], reach[np.r_[at[1:], len(row)] - 1]], 1)


def _split(spans: np.ndarray, parts: int):
    """(part, its spans), dealt by key."""
    to = spans[:, 0] % parts
    order = np.argsort(to, kind="stable")
    cut = _starts(to[order])
    for i, j in zip(cut, [*cut[1:], len(order)]):
        yield int(to[order[i]]), spans[order[i:j]]


def _send_runs(buckets: int):
    """Candidate runs for the buckets (equal ones of a task once, for the smallest id), and
    the spans of the documents that lose a run to another one of the same task."""
    def flush(found, texts):
        low, at, ident, key, fp, pos = (np.concatenate(x) for x in zip(*found))
        lens = np.fromiter(map(len, texts), np.int64, len(texts))
        code = at << 40 | low << 8 | lens
        order = np.argsort(code)
        # equal runs have one anchor and one length
        start = _starts(code[order])
        size = np.diff(np.r_[start, len(order)])
        some = order[np.repeat(size > 1, size)]
        equal = np.arange(len(texts))
        known: dict[tuple, int] = {}
        equal[some] = [known.setdefault((c, texts[i]), i) for i, c in zip(some.tolist(), code[some].tolist())]
        least = ident.copy()
        np.minimum.at(least, equal[some], ident[some])
        gone = ident > least[equal]
        rows = []
        if gone.any():
            spans = _merged(np.stack([key[gone], fp[gone], pos[gone], pos[gone] + lens[gone]], 1))
            rows += [_row(bucket=b, spans=x.tobytes()) for b, x in _split(spans, buckets)]
        order = order[~gone[order]]
        cut = _starts(at[order])
        for i, j in zip(cut, [*cut[1:], len(order)]):
            e = order[i:j]
            rows.append(_row(bucket=int(at[e[0]]), runs=_pack(b"".join([texts[x] for x in e.tolist()])), lens=lens[e].astype(np.uint8).tobytes(),
                             unnamed=(ident[e] == LAST).astype(np.uint8).tobytes(), lows=low[e].astype(np.uint32).tobytes(),
                             owners=np.array([key[e], fp[e]]).tobytes(), places=pos[e].astype(np.uint32).tobytes()))
        yield _batch(rows)

    def run(batches):
        found, held, size = [], [], 0
        for batch in batches:
            for a, b in C.blocks(batch, "text"):
                part = batch.slice(a, b - a)
                ids = np.array([LAST if x is None else x for x in part.column(0).to_pylist()], np.int64)
                keys, fps, texts = np.array(part.column(1).to_pylist(), np.int64), np.array(part.column(2).to_pylist(), np.int64), _bytes(part.column(3))
                lows = [np.frombuffer(x, np.uint32) for x in part.column(4).to_pylist()]
                wanted = np.sort(np.repeat(np.arange(len(lows)) << 32, [len(x) for x in lows]) | np.concatenate(lows))
                for doc, start, n, anchor in runs(texts):
                    low = (anchor & np.uint64(0xFFFFFFFF)).astype(np.int64)
                    sought = doc << 32 | low
                    take = wanted[np.minimum(np.searchsorted(wanted, sought), len(wanted) - 1)] == sought
                    at = ((anchor[take] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
                    doc, start, n, low = doc[take], start[take], n[take], low[take]
                    # a run of one repeated anchor can be long
                    pieces = -(-n // 200)
                    doc, low, at, end = (np.repeat(x, pieces) for x in (doc, low, at, start + n))
                    start = np.repeat(start, pieces) + 200 * (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
                    end = np.minimum(end, start + 200) + LENGTH - 1
                    held += [texts[d][i:j] for d, i, j in zip(doc.tolist(), start.tolist(), end.tolist())]
                    found.append((low, at, ids[doc], keys[doc], fps[doc], start))
                    size += int((end - start).sum()) + 100 * len(doc)
                    if size >= RUN_BYTES:
                        yield from flush(found, held)
                        found, held, size = [], [], 0
        if held:
            yield from flush(found, held)
    return run


def transform(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts as one array (0xFF after each), its suffixes in order of their first
    ``LENGTH`` bytes or more, and the inverse of that order. Prefix doubling from eight
    bytes on, or rather as many times as ranks fit in a key: 8, 24 and 72 bytes."""
    raw = np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8)
    n = len(raw)
    h = np.concatenate([raw, np.full(8, 255, np.uint8)]).astype(np.uint64)
    key = _grow(_grow(_grow(h, 1), 2), 4)[:n]
    step, bits = 8, n.bit_length()
    while True:
        order = np.argsort(key)  # equal keys: in any order, the next step parts them
        if step > LENGTH:
            break
        key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.r_[True, key[1:] != key[:-1]])
        key = rank.copy()
        ways = max(2, 63 // bits)
        for k in range(1, ways):
            key <<= bits
            key[:max(0, n - k * step)] |= rank[k * step:]
        step *= ways
    inverse = np.empty(n, np.int64)
    inverse[order] = np.arange(n)
    return raw, order, inverse


def intervals(raw: np.ndarray, order: np.ndarray, inverse: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For each suffix in order, whether it shares fewer than ``length`` bytes with the one
    before. ``psi`` leads from c w to w: the character before w in the BWT is c. Interval
    of c w are extended from those of w, all of one length at a time: two neighbours
    c v, c w part at length k + 1 if v, w lie in two intervals of length k. Found
    boundaries are left out once they are many, and nothing is done beyond ``length``."""
    psi = inverse[np.minimum(order + 1, len(order) - 1)]
    head = raw[order]
    cut = np.r_[True, head[1:] != head[:-1]]
    live = np.flatnonzero(~cut)
    v, w = psi[live - 1], psi[live]
    for _ in range(length - 1):
        if not len(live):
            break
        interval = np.cumsum(cut, dtype=np.int32)
        parts = interval[v] != interval[w]
        found = np.flatnonzero(parts)
        cut[live[found]] = True
        if 8 * len(found) > len(live):
            live, v, w = (x[~parts] for x in (live, v, w))
    return cut


def least_owner(texts: list[bytes], ids: np.ndarray) -> np.ndarray:
    """By position in the joined texts (one byte between them), the smallest id of a text
    that holds the ``LENGTH`` bytes from there."""
    raw, order, inverse = transform(texts)
    cut = intervals(raw, order, inverse)
    lens = np.array([len(t) for t in texts]) + 1
    owner = np.repeat(ids, lens)[order]
    least = np.minimum.reduceat(owner, np.flatnonzero(cut))
    return least[np.cumsum(cut) - 1][inverse]


def _removed(parts: int):
    """Spans to remove, from a bucket of candidate runs, dealt by document."""
    def run(got: pa.Table) -> pa.Table:
        spans = _merged(np.concatenate([_joined(got, "spans", np.int64).reshape(-1, 4), _bucket_spans(got)]))
        dealt = list(_split(spans, parts))
        return pa.table({"part": pa.array([p for p, _ in dealt], pa.int32()), "spans": pa.array([x.tobytes() for _, x in dealt], pa.binary())})
    return run


def _document_spans(got: pa.Table) -> pa.Table:
    """One row per document row with its spans."""
    spans = _merged(_joined(got, "spans", np.int64).reshape(-1, 4))
    cut = np.flatnonzero(np.r_[True, (spans[1:, :2] != spans[:-1, :2]).any(1)]) if len(spans) else np.empty(0, int)
    to = np.r_[cut[1:], len(spans)] if len(spans) else cut
    return pa.table({"k": pa.array(spans[cut, 0], pa.int64()), "fp": pa.array(spans[cut, 1], pa.int64()),
                     "spans": pa.array([spans[i:j, 2:].tobytes() for i, j in zip(cut, to)], pa.binary())})


def _bucket_spans(got: pa.Table) -> np.ndarray:
    """Spans (key, fp, start, end) that the runs of a bucket lose."""
    rest = got.filter(got.column("runs").is_valid())
    join = lambda c, t: np.frombuffer(b"".join(rest.column(c).to_pylist()), t)
    lens, lows, pos = join("lens", np.uint8).astype(np.int64), join("lows", np.uint32), join("places", np.uint32).astype(np.int64)
    owners = [np.frombuffer(x, np.int64).reshape(2, -1) for x in rest.column("owners").to_pylist()]
    key, fp = np.concatenate(owners, 1) if owners else np.empty((2, 0), np.int64)
    ids = np.where(join("unnamed", np.uint8) == 1, LAST, key)
    text = b"".join(map(_unpack, rest.column("runs").to_pylist()))
    ends = np.cumsum(lens)
    distinct: dict[bytes, int] = {}
    which = np.array([distinct.setdefault(text[e - n:e], len(distinct)) for e, n in zip(ends.tolist(), lens.tolist())], np.int64)
    least = np.full(len(distinct), LAST)
    np.minimum.at(least, which, ids)
    low = np.zeros(len(distinct), np.uint32)
    low[which] = lows
    texts = list(distinct)
    order = np.argsort(low, kind="stable")  # runs of one anchor side by side
    new = np.r_[True, low[order][1:] != low[order][:-1], True] if len(order) else np.ones(1, bool)
    alone = new[:-1] & new[1:]
    # an anchor with one text: it goes from all documents but the first
    spare = np.zeros(len(distinct), bool)
    spare[order[alone]] = True
    e = np.flatnonzero(spare[which] & (least[which] < ids))
    out = [np.stack([key[e], fp[e], pos[e], pos[e] + lens[e]], 1)]
    order = order[~alone]
    entries = np.argsort(which, kind="stable")
    first = np.searchsorted(which[entries], np.arange(len(texts) + 1))
    sizes = np.array([len(texts[i]) for i in order], np.int64)
    upto = np.cumsum(sizes)
    a = 0
    while a < len(order):
        b = a + max(1, int(np.searchsorted(upto[a:] - (upto[a] - sizes[a]), BWT_BYTES)))
        while b < len(order) and low[order[b]] == low[order[b - 1]]:
            b += 1
        some = order[a:b]
        owner = least_owner([texts[i] for i in some], least[some])
        at = np.cumsum(sizes[a:b] + 1) - sizes[a:b] - 1
        count = first[some + 1] - first[some]
        entry = entries[np.repeat(first[some] - np.cumsum(count) + count, count) + np.arange(int(count.sum()))]
        base, windows = np.repeat(at, count), np.repeat(sizes[a:b] - LENGTH + 1, count)
        inside = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
        gone = owner[np.repeat(base, windows) + inside] < np.repeat(ids[entry], windows)
        e, i = np.repeat(entry, windows)[gone], inside[gone]
        if len(e):  # consecutive windows of an entry make one span
            start = np.flatnonzero(np.r_[True, (e[1:] != e[:-1]) | (i[1:] != i[:-1] + 1)])
            stop = np.r_[start[1:], len(e)] - 1
            out.append(np.stack([key[e[start]], fp[e[start]], pos[e[start]] + i[start], pos[e[start]] + i[stop] + LENGTH], 1))
        a = b
    return np.concatenate(out)


def _cut_out(batches):
    for batch in batches:
        for a, b in C.blocks(batch, "text"):
            part = batch.slice(a, b - a)
            rows = {"doc_id": part.column(0), "kept": [], "spans": []}
            for fp, text, spans in zip(part.column(2).to_pylist(), _bytes(part.column(3)), part.column(4).to_pylist()):
                own = [np.frombuffer(x["spans"], np.int64).reshape(-1, 2) for x in spans or () if x["fp"] == fp]
                joined = []
                for s, e in sorted(map(tuple, np.concatenate(own).tolist())) if own else ():
                    if joined and s <= joined[-1][1]:
                        joined[-1][1] = max(joined[-1][1], e)
                    else:
                        joined.append([s, e])
                at, kept = 0, []
                for s, e in joined:
                    kept.append(text[at:s])
                    at = e
                kept.append(text[at:])
                rows["kept"].append(b"".join(kept))
                rows["spans"].append(joined)
            n = [len(k) for k in rows["kept"]]
            gone = [sum(e - s for s, e in x) for x in rows["spans"]]
            yield pa.RecordBatch.from_arrays([
                rows["doc_id"], pa.array([x + y for x, y in zip(n, gone)], pa.int64()), pa.array(gone, pa.int64()),
                pa.array([hashlib.sha256(k).hexdigest() for k in rows["kept"]], pa.string()), pa.array(rows["spans"], pa.list_(pa.list_(pa.int64())))],
                names=["doc_id", "n_bytes", "n_removed", "kept_sha256", "spans"])


def removed_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, kept_sha256 and spans ([start, end) in bytes, by start,
    maximal) of every row."""
    spark = docs.sparkSession
    ident, body = F.col(f"`{doc_id}`").cast("long"), C.text_or_empty(f"`{text}`")
    rows = docs.select(ident.alias("doc_id"), F.coalesce(ident, F.xxhash64(body)).alias("key"), F.xxhash64(body).alias("fp"), body.alias("text"))
    total = docs.agg(F.sum(F.octet_length(body))).first()[0] or 0
    run_buckets = max(4 * C.shuffle_partitions(spark), -(-total // RUN_BUCKET))
    anchor_buckets, parts = (max(C.shuffle_partitions(spark), -(-total // x)) for x in (ANCHOR_BUCKET, DOC_BUCKET))
    lows = (rows.select("key", "text").mapInArrow(_report_anchors(anchor_buckets), _ANCHOR)
            .groupBy("bucket").applyInArrow(_shared_anchors(parts), "part int, lows binary, keys binary, counts binary")
            .groupBy("part").applyInArrow(_document_anchors, "k long, lows binary"))
    candidates = rows.join(lows, F.col("key") == F.col("k")).select("doc_id", "key", "fp", "text", "lows")
    spans = (candidates.mapInArrow(_send_runs(run_buckets), _RUN)
             .groupBy("bucket").applyInArrow(_removed(parts), "part int, spans binary")
             .groupBy("part").applyInArrow(_document_spans, "k long, fp long, spans binary")
             .groupBy("k").agg(F.collect_list(F.struct("fp", "spans")).alias("spans")))
    return rows.join(spans, F.col("key") == F.col("k"), "left").select("doc_id", "key", "fp", "text", "spans").mapInArrow(
        _cut_out, "doc_id long, n_bytes long, n_removed long, kept_sha256 string, spans array<array<long>>")


def op5_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Query: what every document loses."""
    out = removed_spans(C.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
