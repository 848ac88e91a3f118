"""SentencePiece encoding and decoding by a streaming Viterbi.

Text is read in pieces of any size. For each boundary the lattice keeps the best path that
ends there as (piece, backpointer); only the boundaries of the last ``longest`` characters
(the longest piece) can be continued, so that is the window retained. When the
backpointer paths of all of them meet in one boundary, the ids before it are committed.

Path rule by model type. Unigram: the greatest sum of piece scores. BPE: a path may go on
with a piece only if merging the text of its last two pieces gives exactly these two; a
sequence is the BPE encoding of its text just when all its neighbours agree so, hence one
path at most survives per boundary, and the ids are those of merging the whole text.
Between such decisions no other path can live, so a boundary that no piece spans (before
a space, around a character without a piece) is where all paths meet.

``commits`` is the loop: chunks of a text go in, ids come out as they settle. Of the text
it holds the stretch after the last meeting point of the chunk, whose paths may still
differ. A finished stretch goes through the lattice once, from each boundary along a trie
of the pieces, and is remembered while it is short. What a character does to the live
boundaries of the window depends on them alone, so that step is remembered too, and
stretches that begin alike share their lattice. A stretch that outgrows ``_HELD`` characters
goes through the windowed lattice of ``stream``, which commits whenever the backpointer
paths of the window meet.

Defined results: a null text has no ids (and decodes to null); an empty text has none;
characters without a piece become byte pieces (or the unknown id if the model has none);
the mark U+2581 in a text is read as a space, as the model does, and so comes back as one;
repeated rows are encoded alike; a null doc_id is carried; texts of any length are encoded
whole, with no more of the lattice held than a chunk and the window (the row's own text
and ids apart); an empty table gives an empty result.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from . import common as C

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Remembered stretches, piece pairs and windows a task, and the longest stretch remembered.
_KEPT, _KEPT_PAIRS, _KEPT_WINDOWS, _SHORT = 400_000, 1_000_000, 200_000, 48
#: Bits of a character beside the number of a node or window, and of a piece beside a node.
_CHAR, _PIECE = 21, 32
_EVERY = 64
#: Characters that go in at a time, and of a stretch without an end before it is streamed.
CHUNK, _HELD = 1 << 15, 1 << 12
#: Field numbers of a model file, and its number for unigram models (also the default).
_TRAINER, _KIND, _UNIGRAM = 2, 3, 1


def _fields(data: bytes):
    """(number, value) of the fields of a serialized message: varints and byte strings."""
    at = 0

    def varint() -> int:
        nonlocal at
        x = shift = 0
        while True:
            b = data[at]
            at += 1
            x |= (b & 127) << shift
            if b < 128:
                return x
            shift += 7

    while at < len(data):
        key = varint()
        number, wire = key >> 3, key & 7
        if wire == 0:
            yield number, varint()
        elif wire == 2:
            n = varint()
            yield number, data[at:at + n]
            at += n
        else:
            at += {1: 8, 5: 4}[wire]


def is_unigram(proto: bytes) -> bool:
    """The type that a model file states of itself."""
    trainer = next((v for k, v in _fields(proto) if k == _TRAINER), b"")
    return next((v for k, v in _fields(trainer) if k == _KIND), _UNIGRAM) == _UNIGRAM


@lru_cache(maxsize=4)
def load(path: str = MODEL) -> dict:
    """Pieces and scores of a model file, read on the driver; a plain dict of the size of
    the vocabulary, which is what gets broadcast."""
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=path)
    n = m.get_piece_size()
    normal = {m.id_to_piece(i): i for i in range(n) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))}
    data = {int(m.id_to_piece(i)[3:5], 16): i for i in range(n) if m.is_byte(i)}
    probe = m.encode("ab", out_type=str)
    return {"pieces": normal, "scores": {i: m.get_score(i) for i in normal.values()}, "bytes": data, "unknown": m.unk_id(),
            "unigram": is_unigram(m.serialized_model_proto()), "prefix": bool(probe) and probe[0].startswith(SPACE)}


class _Known(dict):
    """Stretch -> its ids as packed 32-bit integers; short ones are remembered."""

    def __init__(self, learn):
        super().__init__()
        self.learn = learn

    def __missing__(self, stretch: str) -> bytes:
        got = self.learn(stretch)
        if len(stretch) <= _SHORT:
            self[stretch] = got
        return got


class Coder:
    def __init__(self, model: dict):
        self.pieces, self.scores, self.bytes = model["pieces"], model["scores"], model["bytes"]
        self.unknown, self.unigram, self.prefix = model["unknown"], model["unigram"], model["prefix"]
        self.longest = max(map(len, self.pieces), default=1)
        self.text = {i: p for p, i in self.pieces.items()}
        self.out = {i: p.replace(SPACE, " ").encode("utf-8", "surrogatepass") for p, i in self.pieces.items()}
        self.out |= {i: bytes([b]) for b, i in self.bytes.items()}
        self.out.setdefault(self.unknown, "\ufffd".encode())
        #: piece -> piece after it -> do they stay as they are
        self.agrees: dict[int, dict[int, bool]] = {}
        self.n_pairs = 0
        self.split: dict[int, tuple | None] = {}
        self.spines: tuple[dict, dict] = {}, {}
        self.known = _Known(self.lattice)
        self.n_commits = self.held = 0
        #: characters of a piece
        self.size = {i: len(p) for p, i in self.pieces.items()}
        #: trie of the pieces: node and character -> node below; the nodes that go on; by node
        #: the piece that ends there or -1
        self.trie: dict[int, int] = {}
        self.goes_on: set[int] = set()
        self.ends = [-1]
        for p, i in self.pieces.items():
            node = 0
            for c in p:
                below = self.trie.setdefault(node << _CHAR | ord(c), len(self.ends))
                if below == len(self.ends):
                    self.ends.append(-1)
                    self.goes_on.add(node)
                node = below
            self.ends[node] = i
        self.forget()
        split = "".join(c for c in "\n\t\r" if c not in self.pieces)
        inner = any(SPACE in p.lstrip(SPACE) for p in self.pieces)
        # stretches: no piece spans the places between them; and where a longer one ends
        runs = "".join(f"[{re.escape(''.join(sorted(x)))}]+|" for x in self.families())
        self.stretch = None if inner else re.compile(f"{SPACE}*(?:{runs}(?s:.))")
        self.border = re.compile(f"(?<!{SPACE}){SPACE}|(?s:.)(?<=[{split}])" if split else f"(?<!{SPACE}){SPACE}")

    def families(self) -> list[set[str]]:
        """Characters that stand side by side in pieces, directly or through others, the largest
        family first; the mark of spaces joins none."""
        family: dict[str, set[str]] = {}
        for a, b in {p[i:i + 2] for p in self.pieces for i in range(len(p) - 1)}:
            if SPACE in (a, b):
                continue
            one, other = sorted((family.get(x) or {x} for x in (a, b)), key=len)
            other |= one
            family |= dict.fromkeys(one | {a, b}, other)
        return sorted({id(x): x for x in family.values()}.values(), key=len, reverse=True)

    def merged(self, text: str) -> tuple[list[str], list[str]]:
        """Plain BPE of a short text: the neighbours with the best score are merged first,
        the leftmost of equal ones. The parts at the end and before the last merge."""
        parts = before = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                p = self.pieces.get(parts[i] + parts[i + 1])
                if p is not None and (best is None or self.scores[p] > best):
                    best, at = self.scores[p], i
            if at < 0:
                break
            before, parts = parts, [*parts[:at], parts[at] + parts[at + 1], *parts[at + 2:]]
        return parts, before

    def halves(self, piece: int):
        """The two pieces that BPE makes this one of, () for a character, None for a piece
        that its own text does not merge to."""
        known = self.split.get(piece, 0)
        if known == 0:
            text = self.text[piece]
            parts, before = self.merged(text)
            known = self.split[piece] = None if parts != [text] else tuple(self.pieces[x] for x in before) if len(text) > 1 else ()
        return known

    def fits(self, last: int, piece: int) -> bool:
        """Does BPE leave the two pieces as they are when they stand side by side? (-1: no
        piece before.) Merges are undone from the last to the first; at each point the
        parts that touch must not be merged before the merge undone last: a merge with a
        better score goes first, and of equal ones the leftmost."""
        a, b = last, piece
        if self.halves(b) is None:
            return False
        if a < 0:
            return True
        if 2 * SPACE in self.text[a] + self.text[b]:  # scores of these do not follow their making
            return self.merged(self.text[a] + self.text[b])[0] == [self.text[a], self.text[b]]
        get, scores, at, to = self.pieces.get, self.scores, 0, 0
        ends, starts = self.spine(a, 1), self.spine(b, 0)
        bound, equal = float("inf"), False
        while True:
            (cost_a, text_a), (cost_b, text_b) = ends[at], starts[to]
            c = get(text_a + text_b)
            if c is not None and (-scores[c] < bound or equal and -scores[c] == bound):
                return False
            if len(text_a) == 1 and len(text_b) == 1:
                return True
            if cost_a > cost_b:
                bound, equal, at = cost_a, False, at + 1
            else:
                bound, equal, to = cost_b, True, to + 1

    def spine(self, piece: int, side: int) -> list[tuple[float, str]]:
        """The piece, its half at the start (0) or end (1), that half's half and so on to a
        character, each with what its merge costs and its text."""
        known = self.spines[side].get(piece)
        if known is None:
            text = self.text[piece]
            known = self.spines[side][piece] = [(-self.scores[piece], text), *self.spine(self.halves(piece)[side], side)] if len(text) > 1 else [(-1e30, text)]
        return known

    def stream(self, chunks):
        """Commits (an id, or a character without a piece) in order, from an iterable of
        strings. Held are the text since the last commit and its boundaries; all but the
        last ``longest`` characters of it wait only for the paths to meet."""
        longest, get, unigram = self.longest, self.pieces.get, self.unigram
        text, at = "", 0
        # by boundary: the piece that ends there (-1: start, or a character without one;
        # -2: no path), where it starts, its path's score; the boundaries that have a path
        last, back, score, alive = [-1], [0], [0.0], [0]
        after = {0: self.agrees.setdefault(-1, {})}
        for chunk in chunks:
            text += chunk
            while at < len(text):
                at += 1
                if at > longest and alive[0] < at - longest:
                    alive = [j for j in alive if j >= at - longest] or [at - 1]
                found, start, value = -2, 0, 0.0
                for j in alive:
                    p = get(text[j:at])
                    if p is None:
                        continue
                    if unigram:
                        if found == -2 or score[j] + self.scores[p] > value:
                            found, start, value = p, j, score[j] + self.scores[p]
                        continue
                    row = after[j]
                    ok = row.get(p)
                    if ok is None:
                        ok = row[p] = self.fits(last[j], p)
                        self.n_pairs += 1
                    if ok:
                        found, start = p, j
                        break
                if found == -2 and last[at - 1] != -2 and get(text[at - 1]) is None:
                    found, start, value = -1, at - 1, score[at - 1] - 1e6
                last.append(found)
                back.append(start)
                score.append(value)
                if found != -2:
                    alive.append(at)
                    after[at] = self.agrees.setdefault(found, {})
                if at % _EVERY == 0 and at > longest:
                    to = self._meet(last, back, at)
                    if to:
                        yield from self._path(text, last, back, to)
                        text, at = text[to:], at - to
                        low = score[to]
                        last, back, score = last[to:], [x - to for x in back[to:]], [x - low for x in score[to:]]
                        alive = [j - to for j in alive if j >= to]
                        after = {j - to: row for j, row in after.items() if j >= to}
        yield from self._path(text, last, back, at)

    def _meet(self, last: list, back: list, at: int) -> int:
        """The last boundary that the paths of all live boundaries have in common."""
        live = {b for b in range(at - self.longest + 1, at + 1) if last[b] != -2}
        while len(live) > 1:
            top = max(live)
            live.remove(top)
            live.add(back[top])
        return live.pop() if live else 0

    @staticmethod
    def _path(text: str, last: list, back: list, to: int) -> list:
        path = []
        while to > 0:
            path.append(last[to] if last[to] >= 0 else text[to - 1])
            to = back[to]
        return path[::-1]

    def ids(self, committed) -> list[int]:
        out = []
        for x in committed:
            if isinstance(x, int):
                out.append(x)
            elif self.bytes:
                out += [self.bytes[b] for b in x.encode("utf-8", "surrogatepass")]
            else:
                out.append(self.unknown)
        return out

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), np.int32).tolist()

    def packed(self, text: str) -> bytes:
        """The ids of a text as packed 32-bit integers."""
        if not text:
            return b""
        t = (SPACE if self.prefix else "") + text.replace(" ", SPACE)
        return b"".join(self.commits(t[i:i + CHUNK] for i in range(0, len(t), CHUNK)))

    def commits(self, chunks):
        """Packed ids in order, as soon as they are settled, from an iterable of strings.
        ``held`` is the most text that waited at once."""
        chunks = iter(chunks)
        if self.unigram or self.stretch is None:
            yield from self._numbers(self.stream(chunks))
            return
        text, rest = "", ""

        def on(first: str):
            """The stretch that ``first`` begins, up to its end in one of the chunks."""
            nonlocal rest
            yield first
            before = first[-1]
            for chunk in chunks:
                if not chunk:
                    continue
                end = self.border.search(before + chunk, 1)
                if end:
                    rest = chunk[end.start() - 1:]
                    yield chunk[:end.start() - 1]
                    return
                before = chunk[-1]
                yield chunk

        for chunk in chunks:
            text += chunk
            self.held = max(self.held, len(text))
            parts = self.stretch.findall(text)
            text = parts.pop() if parts else ""
            yield self._settled(parts)
            while len(text) > _HELD:
                yield from self._numbers(self.stream(on(text)))
                parts = self.stretch.findall(rest)
                text, rest = parts.pop() if parts else "", ""
                yield self._settled(parts)
        yield self._settled([text] if text else [])

    def _numbers(self, committed):
        """Packed ids of ``stream``'s commits, some at a time."""
        some: list[int] = []
        for x in committed:
            some += self.ids((x,))
            if len(some) >= _EVERY:
                self.n_commits += 1
                yield np.array(some, np.int32).tobytes()
                some = []
        yield np.array(some, np.int32).tobytes()

    def _settled(self, parts: list[str]) -> bytes:
        """Ids of whole stretches, each from the lattice or remembered from it."""
        if len(self.known) > _KEPT:
            self.known.clear()
        if self.n_pairs > _KEPT_PAIRS:
            self.agrees.clear()
            self.n_pairs = 0
        if len(self.windows) > _KEPT_WINDOWS:
            self.forget()
        self.n_commits += len(parts)
        return b"".join(map(self.known.__getitem__, parts))

    def forget(self):
        """Only the window at the start of a stretch is known: one boundary, no piece before."""
        #: by window its boundaries that a piece may go on from, in order: where the piece is in
        #: the trie, and the piece before it plus one; then the piece that ends at the window
        self.windows, self.ended = [(0,)], [-1]
        self.numbers = {(0,): 0}  # boundaries -> window, with the bits of a character left free
        self.moves: dict[int, int] = {}  # window and character -> window after it

    def move(self, window: int, char: int) -> int:
        """The window after one more character: every boundary's piece goes on along the trie.
        The boundary after the character takes the first piece that ends there and fits the
        piece before it; no two can."""
        trie, agrees, live, found = self.trie, self.agrees, [], -2
        for boundary in self.windows[window >> _CHAR]:
            node = trie.get(boundary >> _PIECE << _CHAR | char)
            if node is None:
                continue
            before, p = boundary & (1 << _PIECE) - 1, self.ends[node]
            if p >= 0 and found == -2:
                row = agrees.get(before - 1)
                if row is None:
                    row = agrees[before - 1] = {}
                ok = row.get(p)
                if ok is None:
                    ok = row[p] = self.fits(before - 1, p)
                    self.n_pairs += 1
                if ok:
                    found = p
            if node in self.goes_on:
                live.append(node << _PIECE | before)
        if found == -2 and self.ended[window >> _CHAR] != -2 and chr(char) not in self.pieces:
            found = -1
        if found != -2:
            live.append(found + 1)
        key = tuple(live)
        to = self.numbers.get(key)
        if to is None:
            to = self.numbers[key] = len(self.windows) << _CHAR
            self.windows.append(key)
            self.ended.append(found)
        self.moves[window | char] = to
        return to

    def lattice(self, s: str) -> bytes:
        """Packed ids of a stretch by BPE's path rule: the window goes over it, then the path is
        read back from its end by the pieces that end at the boundaries."""
        if len(s) > _HELD:
            return b"".join(self._numbers(self.stream((s,))))
        known, window, passed = self.moves.get, 0, []
        for c in map(ord, s):
            to = known(window | c)
            window = self.move(window, c) if to is None else to
            passed.append(window)
        ended, size, out, to = self.ended, self.size, [], len(s)
        while to > 0:
            p = ended[passed[to - 1] >> _CHAR]
            if p >= 0:
                out.append(p)
                to -= size[p]
            else:
                out += self.ids((s[to - 1],))[::-1]
                to -= 1
        out.reverse()
        return array("i", out).tobytes()

    def decode(self, ids: list[int]) -> str:
        out = self.out
        text = b"".join(map(out.__getitem__, ids)).decode("utf-8", "surrogatepass" if not self.bytes else "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


def encode(docs: DataFrame, model: str = MODEL, keep: list[str] | None = None, text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """Columns ``keep`` of ``docs`` plus the ids of the text and whether decoding them gives
    the text again; the new columns' names by role."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(load(model))  # bounded by the vocabulary
    keep = docs.columns if keep is None else keep
    names = {k: C.internal(docs, k) for k in ("ids", "round_trip", "text")}
    src = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias(names["text"]))
    schema = StructType([*src.schema.fields[:-1], StructField(names["ids"], ArrayType(IntegerType())), StructField(names["round_trip"], BooleanType())])

    def run(batches):
        coder = Coder(shared.value)
        for batch in batches:
            for a, b in C.blocks(batch, names["text"], 2 << 20):
                part = batch.slice(a, b - a)
                texts = part.column(part.num_columns - 1).to_pylist()
                ids = [None if t is None else coder.packed(t) for t in texts]
                same = [None if t is None else coder.decode(np.frombuffer(i, np.int32).tolist()) == t for t, i in zip(texts, ids)]
                sizes = np.cumsum([0] + [len(i or ()) // 4 for i in ids])
                flat = np.frombuffer(b"".join(i for i in ids if i), np.int32)
                gaps = pa.array([i is None for i in ids], pa.bool_())
                arr = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(flat), mask=gaps)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], arr, pa.array(same, pa.bool_())], names=schema.names)

    return src.mapInArrow(run, schema), names


def decode(rows: DataFrame, ids: str, model: str = MODEL) -> tuple[DataFrame, str]:
    """``rows`` plus the text of a column of ids (null for null)."""
    shared = rows.sparkSession.sparkContext.broadcast(load(model))
    name = C.internal(rows, "decoded")
    schema = StructType([*rows.schema.fields, StructField(name, StringType())])
    at = rows.columns.index(ids)

    def run(batches):
        coder = Coder(shared.value)
        for batch in batches:
            texts = [None if x is None else coder.decode(x) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema), name


def op8_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Query: ids of every document, and whether they decode to its text."""
    out, n = encode(C.table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    return out.select("doc_id", F.coalesce(F.size(n["ids"]), F.lit(0)).cast("long").alias("n_ids"), F.col(n["ids"]).alias("ids"),
                      F.col(n["round_trip"]).alias("round_trip"))
