"""Every stage of the pipeline on a whole small table against plain Python."""

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import sentencepiece
import xxhash

from churnlens.llm import mixing, pieces, quality
from .test_operators import brute_quality, words

SMOKE = "/root/testdata/sf0.001"


def passes(text):
    n, chars, symbols, dup, repeat = brute_quality(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    stop = set(quality.stop_list())
    ratio = sum(w in stop for w in words(text)) / max(1, n)
    bang = (text or "").count("!") / max(1, n)
    return (n >= 50 and repeat <= 0.5 * n and symbols <= 0.1 * n and 2 * n <= chars <= 14 * n and ratio >= 0.02
            and dup <= 0.5 * max(1, len(lines)) and bang <= 0.5)


def simhash(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = words(w)
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def first_of_components(rows):
    prints = [simhash(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 2:
                root[find(i)] = find(j)
    best = {}
    for i, (d, _) in enumerate(rows):
        best[find(i)] = min(best.get(find(i), d), d)
    return set(best.values())


def rates(rows, labels):
    """Naive Bayes and the fit in numpy: rate of every row."""
    bucket = lambda w: xxhash.xxh64_intdigest(w.encode(), 42) % mixing.BUCKETS  # noqa: E731  (2^14 divides 2^64)
    lower = lambda t: words("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    text = dict(rows)
    domain = {d: f"q{q}t{t}" for d, q, t in labels}
    counts, held = defaultdict(Counter), Counter(domain.values())
    for d, name in domain.items():
        if d in text:
            counts[name].update(map(bucket, lower(text[d])))
    domains = sorted(k for k in counts if counts[k])
    used = sorted(set().union(*counts.values()))
    log = np.array([[math.log((counts[k][b] + 0.5) / (sum(counts[k].values()) + 0.5 * mixing.BUCKETS)) for k in domains] for b in used])
    weight = dict(zip(used, log - log.mean(1, keepdims=True)))
    prior = np.log(np.array([held[k] for k in domains]) / sum(held[k] for k in domains))
    n, p = [], []
    for _, t in rows:
        ws = lower(t)
        z = prior + mixing.SHARPNESS * sum((weight.get(bucket(w), np.zeros(len(domains))) for w in ws), np.zeros(len(domains))) / max(1, len(ws))
        e = np.exp(z - z.max())
        n.append(len(ws))
        p.append(e / e.sum())
    n, p = np.array(n, float), np.array(p)
    share = np.array([mixing.TARGETS[k] for k in domains])
    goal = mixing.BUDGET * share / share.sum()
    u = np.zeros(len(domains))
    for pull in (1e-2, 1e-3, 1e-4, 1e-5, 1e-6, 1e-7, 1e-8, 1e-9, 1e-10):  # plain Newton steps, halved until the slope falls
        for _ in range(400):
            r = np.maximum(0, 1 - p @ u)
            down = goal - (r * n) @ p / n.sum() + pull * u
            if np.linalg.norm(down) < 1e-11:
                break
            on = r > 0
            step = -np.linalg.solve((p[on] * n[on, None]).T @ p[on] / n.sum() + pull * np.eye(len(u)), down)
            value = lambda v: 0.5 * (np.maximum(0, 1 - p @ v) ** 2 * n).sum() / n.sum() + goal @ v + 0.5 * pull * v @ v  # noqa: B023, E731
            a = 1.0
            while value(u + a * step) > value(u) + 1e-4 * a * (down @ step) and a > 1e-12:
                a /= 2
            u = u + a * step
    return np.maximum(0, 1 - p @ u)


def test_every_stage(spark):
    import corpus_pipeline as P
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    stage = dict(P.STAGES)

    def run(name, df):
        out = stage[name](spark, df, SMOKE)
        return out, [(r.doc_id, r.text) for r in out.select("doc_id", "text").collect()]

    good, got = run("quality_rules", docs)
    assert sorted(got) == sorted((d, t) for d, t in rows.items() if passes(t))
    good = spark.createDataFrame(good.collect(), docs.schema)

    left, now = run("exact_dedup", good)
    assert sorted(now) == sorted((d, rows[d]) for d in keep_first(got))
    left = spark.createDataFrame(left.collect(), docs.schema)

    apart, after = run("simhash_dedup", left)
    assert {d for d, _ in after} == first_of_components(now) and len(after) == len({d for d, _ in after})
    apart = spark.createDataFrame(apart.collect(), docs.schema)

    drawn, copies = run("mixing", apart)
    labels = [tuple(r) for r in spark.read.parquet(f"{SMOKE}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    want = rates(after, labels)
    count = Counter(d for d, _ in copies)
    for (d, t), r in zip(after, want):
        key = hashlib.md5(f"{d}:{t}".encode()).hexdigest()
        h = xxhash.xxh64_intdigest(b"mixing", xxhash.xxh64_intdigest(key.encode(), 42))
        unit = (h % (1 << 20)) / (1 << 20)
        assert count[d] in {math.floor(r + unit - 1e-4 * (1 + r)), math.floor(r + unit + 1e-4 * (1 + r))}, (d, r)
    assert set(count) <= {d for d, _ in after} and drawn.columns == docs.columns

    ids = stage["sentencepiece"](spark, apart, SMOKE).collect()
    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    assert len(ids) == len(after) and all(r.ids == lib.encode(rows[r.doc_id]) and r.round_trip for r in ids)

    whole = P.run(spark, SMOKE).collect()
    assert Counter(r.doc_id for r in whole) == count and all(r.ids == lib.encode(rows[r.doc_id]) for r in whole)


def norm(text):
    import re
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def keep_first(rows):
    first = {}
    for d, t in sorted(rows):
        first.setdefault(norm(t), d)
    return set(first.values())
