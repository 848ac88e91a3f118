"""Language ID: script ranges narrow the candidates of a word, then Viterbi over per-word
scores with a switching penalty labels spans of a mixed-language text.

Training counts hashed character n-grams and whole words per language over every labelled
row (a table of ``BUCKETS`` x languages, so the model's size is fixed) and the letters of
each script per language. A word's candidates are the languages that write its script;
others get a floor score. The document's language is the one whose spans hold most
letters, and its score is their share of all letters.

Defined results: null or empty text, or one without a letter: ``und`` with score 0; ties go
to the language that comes first in order of name; rows with a null language are not
learned from; without any labelled row every text is ``und``; repeated rows are judged one
by one and each counts in training; a null doc_id counts as not held out (its remainder is
that of the empty string); texts of any length are read whole; an empty table gives an
empty result; columns other than those named are not read.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_right
from collections import Counter, defaultdict
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

BUCKETS = 1 << 15
SWITCH = 8.0
#: Score of a language that does not write the word's script, and the share of a
#: language's letters from which on it counts as writing a script.
FLOOR, SHARE = -60.0, 0.01
#: Largest model that is broadcast: buckets x languages.
MAX_LANGS = 512
#: First code point of each range of a script (later ranges go on).
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0900, "devanagari"), (0x0980, "indic"), (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"),
    (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "han"),
    (0x3130, "hangul"), (0x3190, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"),
    (0xFB00, "other"), (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0xFFE0, "other"), (0x20000, "han"),
]
_STARTS = [s for s, _ in SCRIPTS]
SCRIPT_NAMES = sorted({n for _, n in SCRIPTS})
_WORD = re.compile(r"[^\W\d_]+")
_KEPT_WORDS = 200_000
_TAIL = 16


def script(word: str) -> int:
    return SCRIPT_NAMES.index(SCRIPTS[bisect_right(_STARTS, ord(word[0])) - 1][1])


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the features of all words (each word's one after another) and the number
    of them: the word itself, and the pairs and triples of its characters with an end mark
    on both sides."""
    lens = np.array([len(w) for w in words])
    chars = np.frombuffer("".join([f"^{w}$" for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    whole = np.array([crc32(w.encode("utf-8", "surrogatepass")) for w in words], np.uint64)
    ends = np.cumsum(lens + 2)
    two = chars[:-1] * np.uint64(0x9E3779B97F4A7C15) + chars[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    three = two[:-1] * np.uint64(0x165667B19E3779F9) + chars[2:]
    n = 1 + (lens + 1) + lens
    at = np.cumsum(n) - n
    out = np.empty(int(n.sum()), np.uint64)
    out[at] = whole
    for grams, more, gap in ((two, lens + 1, 1), (three, lens, 2 + lens)):
        into = np.arange(int(more.sum())) - np.repeat(np.cumsum(more) - more, more)
        out[np.repeat(at + gap, more) + into] = grams[np.repeat(ends - lens - 2, more) + into]
    out ^= out >> np.uint64(29)
    return ((out * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(40)).astype(np.int64) % BUCKETS, n


def letters_of(word: str) -> str:
    return word if word.isalpha() else "".join(c for c in word if c.isalpha())


def _counts(batches):
    """Per batch of rows: (lang, bucket, n); scripts follow the buckets."""
    def flush():
        for lang, counted in words.items():
            items = [(own, n) for w, n in counted.items() if (own := letters_of(w))]
            if not items:
                continue
            times = np.array([n for _, n in items])
            at, per = features([w for w, _ in items])
            scripts = np.array([script(w) for w, _ in items])
            row = np.r_[np.bincount(at, np.repeat(times, per), BUCKETS),
                        np.bincount(scripts, times * [len(w) for w, _ in items], len(SCRIPT_NAMES))].astype(np.int64)
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at, pa.int32()), pa.array(row[at])], names=["lang", "bucket", "n"])

    words: dict[str, Counter] = defaultdict(Counter)
    for batch in batches:
        for a, b in C.blocks(batch, "text"):
            part = batch.slice(a, b - a)
            for t, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                words[lang].update(_WORD.findall((t or "").lower()))
            if sum(map(len, words.values())) > _KEPT_WORDS:
                yield from flush()
                words.clear()
    yield from flush()


def train(docs: DataFrame, lang: str = "lang", text: str = "text") -> dict:
    """The model as plain arrays: langs, weights (buckets x langs) and writes (scripts x
    langs). What comes to the driver is the count table, at most BUCKETS rows a language, of
    at most ``MAX_LANGS`` languages: the labels are counted first, and of more those with the
    most rows are learned (ties: the smaller name)."""
    src = docs.where(F.col(f"`{lang}`").isNotNull()).select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"))
    labels = src.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    if labels.count() > MAX_LANGS:
        top = [r["lang"] for r in labels.orderBy(F.col("n").desc(), "lang").limit(MAX_LANGS).collect()]
        src = src.where(F.col("lang").isin(top))
    rows = src.mapInArrow(_counts, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    got = rows.toArrow()
    langs = sorted(set(got.column("lang").to_pylist()))
    table = np.zeros((BUCKETS + len(SCRIPT_NAMES), max(1, len(langs))))
    if langs:
        where = {x: i for i, x in enumerate(langs)}
        np.add.at(table, (got.column("bucket").to_numpy(), [where[x] for x in got.column("lang").to_pylist()]), got.column("n").to_numpy())
    grams, letters = table[:BUCKETS] + 0.1, table[BUCKETS:]
    weights = np.log(grams / grams.sum(0)).astype(np.float32)
    writes = letters >= SHARE * np.maximum(letters.sum(0), 1)
    return {"langs": langs, "weights": weights, "writes": writes}


def viterbi(scores: np.ndarray, sizes: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of every word. ``scores``: words x labels, documents one after another
    (``sizes`` words each). Documents advance together, longest first; the last few long
    ones go on word by word, so time follows the words, not the longest document."""
    n_words, n_labels = scores.shape
    order = np.argsort(-sizes, kind="stable")
    lens = sizes[order]
    first = (np.cumsum(sizes) - sizes)[order]
    docs = int((lens > 0).sum())
    back = np.empty((n_words, n_labels), np.uint16)
    best = np.zeros((docs, n_labels))
    own = np.arange(n_labels, dtype=np.uint16)
    together = int(lens[min(_TAIL, docs) - 1]) if docs >= _TAIL else 0
    live = docs
    for t in range(together):
        while lens[live - 1] <= t:
            live -= 1
        at, v = first[:live] + t, best[:live]
        top = v.argmax(1).astype(np.uint16)
        jump = v[np.arange(live), top] - penalty
        leave = jump[:, None] > v
        back[at] = np.where(leave, top[:, None], own)
        best[:live] = np.where(leave, jump[:, None], v) + scores[at]
    for d in range(min(_TAIL, docs)):
        v, a, b = best[d].tolist(), int(first[d]) + together, int(first[d] + lens[d])
        came = array("H")
        labels = range(n_labels)
        for row in scores[a:b].tolist():
            jump = max(v)
            top = v.index(jump)
            jump -= penalty
            came.extend([top if jump > v[k] else k for k in labels])
            v = [(jump if jump > v[k] else v[k]) + row[k] for k in labels]
        back[a:b] = np.frombuffer(came, np.uint16).reshape(-1, n_labels)
        best[d] = v
    out = np.zeros(n_words, np.uint16)
    state = best.argmax(1).astype(np.uint16)
    for d in range(min(_TAIL, docs)):
        s, a, b = int(state[d]), int(first[d]) + together, int(first[d] + lens[d])
        for i in range(b - 1, a - 1, -1):
            out[i] = s
            s = int(back[i, s])
        state[d] = s
    live = 0
    for t in range(together - 1, -1, -1):
        while live < docs and lens[live] > t:
            live += 1
        at = first[:live] + t
        out[at] = state[:live]
        state[:live] = back[at, state[:live]]
    return out


class Scorer:
    """Word scores of a model, remembered for up to ``_KEPT_WORDS`` words."""

    def __init__(self, model: dict):
        self.langs, self.weights, self.writes = model["langs"], model["weights"], model["writes"]
        self._clear()

    def _clear(self):
        self.known: dict[str, int] = {}
        self.rows, self.letters = np.empty((0, len(self.langs)), np.float32), np.empty(0, np.int64)

    def _learn(self, words: list[str]) -> None:
        """Scores of new words, at the next places; a word without a letter has 0 letters."""
        own = [letters_of(w) for w in words]
        at, n = features([w or "0" for w in own])
        s = np.add.reduceat(self.weights[at], np.cumsum(n) - n, axis=0)
        can = self.writes[[script(w) if w else 0 for w in own]]
        can = np.where(can.any(1)[:, None], can, True)
        s -= np.where(can, s, -np.inf).max(1)[:, None]
        s = np.maximum(np.where(can, s, FLOOR), FLOOR).astype(np.float32)
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words))))
        self.rows, self.letters = np.concatenate([self.rows, s]), np.r_[self.letters, [len(w) for w in own]]

    def judge(self, texts: list) -> tuple[list, list, list]:
        """Language, score and spans (label, words) of each text."""
        words = [_WORD.findall((t or "").lower()) for t in texts]
        if self.langs:
            if len(self.known) > _KEPT_WORDS:
                self._clear()
            flat = list(chain.from_iterable(words))
            new = list(set(flat).difference(self.known))
            if new:
                self._learn(new)
            ids = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        else:
            ids = np.empty(0, np.int64)
        sizes = np.array([len(ws) for ws in words])
        if len(ids) and (empty := self.letters[ids] == 0).any():
            doc = np.repeat(np.arange(len(texts)), sizes)[~empty]
            ids, sizes = ids[~empty], np.bincount(doc, minlength=len(texts))
        if not len(ids):
            return ["und"] * len(texts), [0.0] * len(texts), [[] for _ in texts]
        size = sizes.astype(np.int64)
        path = viterbi(self.rows[ids], size, SWITCH)
        k = len(self.langs)
        doc = np.repeat(np.arange(len(texts)), size)
        held = np.bincount(doc * k + path, weights=self.letters[ids], minlength=len(texts) * k).reshape(-1, k)
        top, total = held.argmax(1), held.sum(1)
        lang = [self.langs[i] if n else "und" for i, n in zip(top, total)]
        score = np.where(total > 0, held.max(1) / np.maximum(total, 1), 0.0).tolist()
        cut = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (path[1:] != path[:-1])])
        spans: list[list] = [[] for _ in texts]
        for a, n in zip(cut, np.diff(np.r_[cut, len(path)])):
            spans[doc[a]].append((self.langs[path[a]], int(n)))
        return lang, score, spans


_PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double, spans array<struct<lang:string,words:int>>"
_SPAN = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int32())]))


def predict(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """doc_id, held_out (both columns of ``docs``, carried only) with lang_pred, score and
    the labelled spans in order."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            for a, b in C.blocks(batch, "text", 8 << 20):
                part = batch.slice(a, b - a)
                lang, score, spans = scorer.judge(part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                                                  pa.array([[{"lang": x, "words": n} for x, n in s] for s in spans], _SPAN)],
                                                 names=["doc_id", "held_out", "lang_pred", "score", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", F.col(f"`{text}`").alias("text")).mapInArrow(run, _PREDICTED)


def op3_language_id(spark, sf_dir: str) -> DataFrame:
    """Query: learned from the documents that are not held out, applied to all."""
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2)
    model = train(docs.where(~F.col("held_out")).select("text", "lang"))
    out = predict(docs.select("doc_id", "held_out", "text"), model)
    return out.select("doc_id", "held_out", "lang_pred", "score", F.size("spans").alias("n_spans"))
