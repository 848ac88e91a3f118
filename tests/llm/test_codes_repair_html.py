"""Vector codes, conversation repair, HTML extraction and the newer parts of the earlier
operators, against brute force on small tables with odd rows."""

import hashlib
import heapq
import html as entities
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlens.llm import common, conversations, exact_dedup, html_text, language, mixing, pieces, secrets, sharding, simhash, url_filter, vector_codes

SMOKE, SMALL = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


# vector codes

def brute_codes(rows, rounds=4, parts=4):
    """rows: (vec_id, vector, label), kept ones in the order of the contract."""
    width = max(parts, -(-max(len(v) for _, v, _ in rows) // parts) * parts)
    x = [[*[int(np.floor(1024 * c)) for c in v], *[0] * (width - len(v))] for _, v, _ in rows]
    w = width // parts
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))[:256]
    books = [[x[i][p * w:(p + 1) * w] for i in order] for p in range(parts)]

    def nearest(v, book):
        d = [sum((a - b) ** 2 for a, b in zip(v, e)) for e in book]
        return d.index(min(d)), min(d)

    def at(p):
        return [nearest(v[p * w:(p + 1) * w], books[p]) for v in x]

    for _ in range(rounds):
        for p in range(parts):
            got = at(p)
            for e in range(len(books[p])):
                own = [x[i][p * w:(p + 1) * w] for i, (k, _) in enumerate(got) if k == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    last = [at(p) for p in range(parts)]
    codes = ["".join(f"{last[p][i][0]:02x}" for p in range(parts)) for i in range(len(rows))]
    errors = [sum(last[p][i][1] for p in range(parts)) for i in range(len(rows))]
    return codes, errors, hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()


def run_codes(df):
    got, n, books = vector_codes.compress(df, keep=["vec_id", "label"])
    rows = [(r.vec_id, r.label, "".join(f"{e:02x}" for e in r[n["entries"]]), r[n["error"]]) for r in got.collect()]
    return sorted(rows, key=str), vector_codes.digest(books) if len(books[0]) else None


def test_codes_on_the_small_table(spark):
    src = [tuple(r) for r in spark.read.parquet(f"{SMOKE}/embeddings.parquet").select("vec_id", "embedding", "label").orderBy("vec_id").limit(320).collect()]
    df = spark.createDataFrame(src, "vec_id long, embedding array<float>, label int")
    codes, errors, digest = brute_codes(src)
    got, sha = run_codes(df)
    assert got == sorted([(i, label, c, e) for (i, _, label), c, e in zip(src, codes, errors)], key=str) and sha == digest


def test_codes_odd_rows(spark, monkeypatch):
    rng = np.random.default_rng(0)
    vec = lambda n: [float(x) for x in np.float32(rng.normal(size=n))]
    same = vec(8)
    rows = [(i % 90, vec(8), i % 3 if i % 4 else None) for i in range(120)] + [(5, same, 1)] * 40 + [(None, vec(6), None), (None, [], 2), (300, [0.5] * 3, 1)]
    bad = [(1, None, 1), (2, [1.0, None] * 4, 1), (3, [float("nan")] * 8, 1), (4, [float("inf")] + [0.0] * 7, None)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, label int").withColumn("entries", F.lit("x")).withColumn("__error", F.lit(1))
    codes, errors, digest = brute_codes(rows)
    monkeypatch.setattr(vector_codes, "BLOCK", 50)
    got, sha = run_codes(df)
    assert got == sorted([(i, label, c, e) for (i, _, label), c, e in zip(rows, codes, errors)], key=str) and sha == digest
    out, n, _ = vector_codes.compress(df)
    assert out.columns[:4] == ["vec_id", "label", "entries", "__error"] and n["error"] not in df.columns
    assert vector_codes.compress(df.limit(0))[0].count() == 0 and run_codes(spark.createDataFrame(bad, df.schema.simpleString()[7:-1].split(",entries")[0]))[0] == []
    far = spark.createDataFrame([(1, [3e38] * 4, 1), (2, [-3e38] * 4, 1)], "vec_id long, embedding array<float>, label int")
    assert [r[3] for r in run_codes(far)[0]] == [0, 0]


def test_tree_owns_whole_balls():
    rng = np.random.default_rng(3)
    middle = rng.integers(-3000, 3000, (6, 8))
    x = np.concatenate([m + rng.integers(-5, 6, (500, 8)) for m in middle])
    tree = vector_codes.build(x)
    for a, b, c, r, s in zip(tree.start, tree.stop, tree.centre, tree.radius, tree.sums):
        own = x[tree.order[a:b]]
        assert (s == own.sum(0)).all() and np.sqrt(((own - c) ** 2).sum(1)).max() <= r + 1e-6
    compared = []
    exact = vector_codes._exact
    try:
        vector_codes._exact = lambda p, b: compared.append(len(p)) or exact(p, b)
        sums, counts, entry = vector_codes.assign(tree, x, middle, each=True)
    finally:
        vector_codes._exact = exact
    want = exact(x, middle).argmin(1)
    assert (entry == want).all() and (counts == np.bincount(want, minlength=6)).all() and not sum(compared)  # no point was compared


def test_codes_query(spark):
    rows = vector_codes.op11_vector_codes(spark, SMOKE).collect()
    src = {r.vec_id: r.label for r in spark.read.parquet(f"{SMOKE}/embeddings.parquet").collect()}
    total = defaultdict(int)
    for r in rows:
        total[src[r.vec_id]] += r.error
    assert len(rows) == len(src) and all(r.label_error == total[src[r.vec_id]] and re.fullmatch("[0-9a-f]{8}", r.code) for r in rows)
    assert len({r.codebooks_sha256 for r in rows}) == 1


# conversation repair

def brute_edits(codes):
    """Dijkstra over (row, state), cheapest first, then ASCII-least."""
    best, heap = {}, [(0, "", 0, 0)]
    while heap:
        cost, audit, i, q = heapq.heappop(heap)
        if (i, q) in best:
            continue
        best[i, q] = (cost, audit)
        new = 3 if q == 2 else 2
        heapq.heappush(heap, (cost + 3, audit + "I", i, new))
        if i < len(codes):
            fault, who = codes[i] // 4, "sua-"[codes[i] % 4]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, q))
            if fault != 1:
                more = 3 if fault == 2 else 0
                if who in {0: "su", 1: "u", 2: "a", 3: "u"}[q]:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, {"s": 1, "u": 2, "a": 3}[who]))
                heapq.heappush(heap, (cost + more + 3, audit + "R", i + 1, new))
    return min(best[len(codes), q] for q in (0, 3) if (len(codes), q) in best)


def damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv]
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        if k:
            out[conv] += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


def brute_repair(rows):
    out = {}
    for conv, rs in damage(rows).items():
        rs.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, codes, n = set(), [], dict(blank=0, duplicate=0, truncated=0)
        for _, role, text in rs:
            last = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                n[fault] += 1
            codes.append((("sua".index(role[:1]) if role[:1] in ("s", "u", "a") else 3)) + 4 * {"": 0, "truncated": 2}.get(fault, 1))
        cost, audit = brute_edits(codes)
        turns = [t for t, _, _ in rs if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rs, rs[1:]))
        done, i, who = [], 0, ""
        for e in audit:
            new = "assistant" if who == "u" else "user"
            if e == "I":
                done.append((new, ""))
            else:
                _, role, text = rs[i]
                i += 1
                if e == "D":
                    continue
                done.append((new if e == "R" else role, text))
            who = done[-1][0][0]
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in done))
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in done).encode()).hexdigest()
        out[conv] = (gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, sha)
    return out


TALK = "conv_id long, turn long, role string, text string"


def odd_talk():
    rnd = random.Random(3)
    rows = [(rnd.choice([1, 2, 3, None, 7]), rnd.choice([None, 0, 1, 2, 3, 4, 5, 9]), rnd.choice([None, "", "system", "user", "assistant", "User", "tool"]),
             rnd.choice([None, "", " \n", "a.", "b?", "c", "d!", "é.", "x y . "])) for _ in range(60)]
    rows += [(100, i % 40 if i % 3 else None, rnd.choice(["user", "assistant", "system"]), rnd.choice(["a.", "b", "c.", f"{i}.", f"{i}?"])) for i in range(300)]
    return rows + [(200 + i, 0, "user", "gone") for i in range(60)]


def test_search_is_the_cheapest_and_least():
    rnd = random.Random(1)
    for n in [*[rnd.randint(0, 9) for _ in range(400)], *[rnd.randint(20, 70) for _ in range(60)]]:  # the latter in chunks
        codes = bytes(rnd.choice([0, 1, 1, 2, 2, 3]) + 4 * rnd.choice([0, 0, 0, 1, 2]) for _ in range(n))
        audit, cost, _ = conversations.solve(codes)
        assert (cost, audit) == brute_edits(codes)


@pytest.mark.parametrize("long_rows, segment", [(50_000, 4096), (8, 4096), (8, 7)])
def test_repair(spark, monkeypatch, long_rows, segment):
    monkeypatch.setattr(conversations, "SEGMENT", segment)
    rows = odd_talk()
    df = spark.createDataFrame(rows, TALK).withColumn("audit", F.lit(1)).withColumn("conv", F.lit("x"))
    got = {r[0]: tuple(r)[1:] for r in conversations.repair(conversations.damaged(df), long_rows=long_rows).collect()}
    want = brute_repair(rows)
    assert got == want
    empty = [v for v in want.values() if v[-1] == hashlib.sha256(b"").hexdigest()]
    assert empty and conversations.repair(conversations.damaged(df.limit(0))).count() == 0


def test_repair_on_the_small_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r[0]: tuple(r)[1:] for r in conversations.op12_conversation_repair(spark, SMALL).collect()}
    assert got == brute_repair(rows)


# HTML extraction

def test_html_of_the_small_table(spark):
    got = {r.page_id: r for r in html_text.op13_html_extraction(spark, SMALL).collect()}
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    for p in pages:
        inner = re.search("<article>(.*)</article>", p.html, re.S)[1]
        lines = [" ".join(entities.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inner)]
        text = "\n\n".join(x for x in lines if x)
        assert (got[p.page_id].url, got[p.page_id].text, got[p.page_id].n_chars) == (p.url, text, len(text))
    assert len(got) == len(pages)


BODY = "<p>A long paragraph of the article, with words enough to be dense.</p>" * 3
PAGES = [
    (None, ""), ("", ""), (" \n ", ""), ("plain &amp text", "plain & text"), ("<p", ""), ("<script>x", ""), ("<article></article>", ""),
    ("a < b &lt; c<br>d", "a < b < c d"), ("<b>a<p>b<i>c</p>d", "a\n\nbc\n\nd"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a\n\nb\n\nc"),
    ("<ul><li>one<li>two</ul>", "one\n\ntwo"), ("<!-- <p>no</p> --><p title='a>b'>yes", "yes"), ("<textarea><p>no</textarea><p>yes", "yes"),
    ("<header><h1>Site</h1></header><main><article><header><h1>T</h1></header><p>x  y\n z</p><section class='post-comments'><p>" + "comment " * 50
     + "</p></section><aside>see</aside><form>mail <input></form></article></main><footer>f</footer>", "T\n\nx y z"),
    ("<div id=top-menu><a href=a>one</a> <a href=b>two</a></div><div><h2>T</h2>" + BODY + "</div><div class='cookie-notice'>We use cookies " + "very " * 99
     + "</div><div class=sidebar>" + "side " * 99 + "</div>", "T" + "\n\nA long paragraph of the article, with words enough to be dense." * 3),
    ("<div><ul><li><a href=1>first link</a><li><a href=2>second link</a><li><a href=3>third link</a></ul></div><div>" + BODY + "</div>",
     "\n\n".join(["A long paragraph of the article, with words enough to be dense."] * 3)),
    ("<body class='has-sidebar'><article class='promo'><p>kept</p></article><article class='comment'><p>" + "no " * 99 + "</p></article>", "kept"),
    ("<article><h1>T</h1><p>See <a href=x>the link</a>.</p><ul class=x><li><a href=1>Home</a></li><li><a href=2>About</a></li></ul><p><a href=y>only a link</a></p>"
     + BODY + "</article>", "T\n\nSee the link.\n\nonly a link" + "\n\nA long paragraph of the article, with words enough to be dense." * 3),
]


def test_html_cases(spark):
    for page, text in PAGES:
        assert html_text.extract(page) == text, page
    df = spark.createDataFrame([(i, p, "n") for i, (p, _) in enumerate(PAGES * 2)], "page_id long, html string, text string").withColumn("n_chars", F.lit("c"))
    out, n = html_text.extract_text(df)
    assert out.columns[:3] == ["page_id", "text", "n_chars"]
    got = {r.page_id: (r[n["text"]], r[n["n_chars"]]) for r in out.collect()}
    assert got == {i: (t, len(t)) for i, (_, t) in enumerate(PAGES * 2)}
    assert html_text.extract_text(df.limit(0))[0].count() == 0


@pytest.mark.parametrize("page", ["<div>" * 20000 + "x", "<a " * 20000, "<!--" * 20000, "</div>" * 20000, "<div><p>" * 20000, "<b>" * 20000 + "</i>" * 20000,
                                  '="' * 30000, "<a ='\"" * 10000, "<p>" + "word " * 200000, "&" * 50000, "<" * 50000])
def test_html_of_any_shape_in_time(page):
    html_text.extract(page)


# hot keys

@pytest.fixture
def plain(spark):
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_hot_keys_are_split(spark, plain):
    n = 32_000
    spread = lambda df: [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    half = lambda a, b: F.when(F.col("id") % 2 == 0, a).otherwise(b)
    docs = spark.range(n).select(F.col("id").alias("doc_id"), half(F.lit("one text"), F.concat(F.lit("text "), F.col("id"))).alias("text"))
    index = exact_dedup.new_index(spark)
    exact_dedup.dedup(docs.where("doc_id = 0"), index, "first")  # an earlier batch holds the frequent text once
    out, names = exact_dedup.dedup(docs, index, "second")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "attach_salt" in next(x for x in plan.split("\n") if "SortMergeJoin" in x).split("]")[0]
    assert max(spread(out)) < 1.5 * n / 16 and out.where(names["kept"]).count() == n // 2
    index.close()
    pages = spark.range(n).select(F.col("id").alias("page_id"), half(F.lit(None), F.concat(F.lit("http://h"), F.col("id"), F.lit(".org/x"))).alias("url"))
    out, _ = url_filter.filter_urls(pages, url_filter.rule_table(spark, url_filter.RULES), keep=["page_id"])
    assert max(spread(out)) < 1.5 * n / 16 and out.count() == n
    assert max(spread(simhash.near_duplicates(docs))) < 1.5 * n / 16


# the index over two parts of a table

def test_index_that_holds_an_earlier_part(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    index = exact_dedup.new_index(spark)
    parts = [docs.where("doc_id < 500"), docs.where("doc_id >= 500")]
    got = {}
    for i, part in enumerate(parts):
        out, n = exact_dedup.dedup(part, index, f"part-{i}")
        got |= {r.doc_id: (r[n["digest"]], r[n["keep_id"]], r[n["kept"]]) for r in out.collect()}
    first = {}
    for i in sorted(got):
        first.setdefault(got[i][0], i)
    assert all(keep == first[d] and kept == (first[d] == i) for i, (d, keep, kept) in got.items())
    assert index.rows().count() == len(first)
    index.close()


# mixing

@pytest.mark.parametrize("budget", [1.0, 1.25])
def test_mixing_ends_for_any_target(spark, budget):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    domains, prior, weights = mixing.train(docs.select("doc_id", "text"), labels)
    from churnlens.session import cut_lineage
    post = cut_lineage(mixing.posteriors(docs.select("doc_id", "text"), domains, prior, weights)).coalesce(1).cache()
    p = post.toPandas()
    probs, n = p[[f"p_{i}" for i in range(len(domains))]].to_numpy(), p.n_tokens.to_numpy()
    for targets in ({"q1t0": 0.7, "q0t0": 0.3}, {"q1t0": 0.5, "q0t0": 0.5}, {"q1t0": 1.0}, {"q0t1": 1.0}, mixing.TARGETS):
        rated, totals = mixing.fit(post, domains, targets, budget)
        off = np.array([t["expected"] - t["target"] for t in totals]) / n.sum()
        expected = np.array([t["expected"] for t in totals]) / n.sum()
        assert all(t["converged"] for t in totals)
        assert (probs[n > 0] @ off).min() > -1e-6 and abs(off @ expected) < 1e-6  # no rate could lower the error


def test_mixing_with_many_domains(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["aa", "bb", "cc"]) + str(i % 50) for _ in range(8))) for i in range(400)]
    labels = [(i, i % 50, i % 2) for i in range(400)]
    docs, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out, domains, totals = mixing.mix(docs, lab, {"q7t1": 0.5, "q8t0": 0.5}, 1.0)
    assert len(domains) == mixing.MAX_DOMAINS and mixing.OTHER in domains and {"q7t1", "q8t0"} <= set(domains)
    assert out.count() == 400 and all(t["converged"] for t in totals)


# language ID

def test_more_languages_than_a_byte_holds(spark):
    names = [f"l{i:03d}" for i in range(300)]
    rows = [(i, f"{chr(97 + i % 26)}{chr(97 + i // 26)}word{i} {chr(97 + i % 26)}{chr(97 + i // 26)}other{i}", names[i]) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("held_out", F.lit(False)).withColumn("score", F.lit("clash"))
    model = language.train(docs)
    got = {r.doc_id: r.lang_pred for r in language.predict(docs, model).collect()}
    assert sum(got[i] == names[i] for i in range(300)) > 290
    assert language.predict(docs.limit(0), model).count() == 0


def test_languages_beyond_the_model(spark, monkeypatch):
    monkeypatch.setattr(language, "MAX_LANGS", 2)
    docs = spark.createDataFrame([(1, "aa bb", "x"), (2, "aa bc", "x"), (3, "dd ee", "y"), (4, "dd ef", "y"), (5, "gg hh", "z")], "doc_id long, text string, lang string")
    assert language.train(docs)["langs"] == ["x", "y"]


def test_word_scores_by_hand(spark):
    """Counts and word scores against a plain count of the features."""
    docs = spark.createDataFrame([(1, "ab ab cd", "x"), (2, "cd de", "y"), (3, None, "y"), (4, "zz", None)], "doc_id long, text string, lang string")
    model = language.train(docs)
    counts = {lang: defaultdict(int) for lang in "xy"}
    for text, lang in (("ab ab cd", "x"), ("cd de", "y")):
        for w in text.split():
            for at in language.features([w])[0]:
                counts[lang][int(at)] += 1
    for k, lang in enumerate("xy"):
        total = sum(counts[lang].values()) + 0.1 * language.BUCKETS
        for at, n in counts[lang].items():
            assert abs(model["weights"][at, k] - np.log((n + 0.1) / total)) < 1e-5


# token ids

def test_pieces_commit_as_they_settle(spark):
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    coder = pieces.Coder(pieces.load())
    assert not coder.unigram
    texts = [r.text for r in spark.read.parquet(f"{SMOKE}/documents.parquet").collect() if r.text]
    for t in texts:
        marked = pieces.SPACE + t.replace(" ", pieces.SPACE)
        before, coder.held = coder.n_commits, 0
        got = [np.frombuffer(x, np.int32).tolist() for x in coder.commits(marked[i:i + 64] for i in range(0, len(marked), 64))]
        assert sum(got, []) == lib.encode(t) and len(got) > len(marked) // 64 and coder.n_commits > before
        assert coder.held <= 64 + max(map(len, t.replace("\n", " ").split(" ")), default=0) + 64  # a chunk and a stretch


def test_pieces_stretch_without_end(monkeypatch):
    import sentencepiece
    monkeypatch.setattr(pieces, "CHUNK", 7)
    monkeypatch.setattr(pieces, "_HELD", 20)
    lib, coder, rnd = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL), pieces.Coder(pieces.load()), random.Random(1)
    texts = ["a" * 300, " " * 100, "x" + " " * 60 + "yy" * 50 + "\n\n" + " " * 30 + "\t" + "é" * 90, "\n" * 50, "a▁▁b " * 20]
    for t in texts + ["".join(rnd.choice("ab  \n\té日▁the ing=1") for _ in range(rnd.randint(0, 120))) for _ in range(300)]:
        assert coder.encode(t) == lib.encode(t)
    assert coder.held <= 27


def test_pieces_step_once_for_words_that_begin_alike(monkeypatch):
    import sentencepiece
    lib, coder, rnd = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL), pieces.Coder(pieces.load()), random.Random(2)
    steps, move = [], coder.move
    monkeypatch.setattr(coder, "move", lambda *at: steps.append(at) or move(*at))
    words = sorted({"".join(rnd.choice(["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha"]) for _ in range(6)) for _ in range(3000)})
    text = " ".join(w + rnd.choice([",", ".", "", "###", "(1)"]) for w in words)
    assert coder.encode(text) == lib.encode(text)
    assert len(steps) == len(set(steps)) == len(coder.moves) < len(text) / 4
    assert len(coder.known) <= len(words) + 20  # a word is one stretch, whatever stands after it
    monkeypatch.setattr(pieces, "_KEPT_WINDOWS", 50)  # forgotten and found again
    monkeypatch.setattr(pieces, "CHUNK", 100)
    coder.known.clear()
    assert coder.encode(text) == lib.encode(text) and len(coder.windows) < 400


def test_pieces_side_by_side():
    coder, rnd = pieces.Coder(pieces.load()), random.Random(3)
    made = [i for i in coder.text if coder.halves(i) is not None]
    short = [i for i in made if len(coder.text[i]) < 4 and coder.text[i].isascii()]
    pairs = [(rnd.choice(made), rnd.choice(made)) for _ in range(1000)] + [(rnd.choice(short), rnd.choice(short)) for _ in range(2000)]
    found = [coder.fits(a, b) for a, b in pairs]
    assert found == [coder.merged(coder.text[a] + coder.text[b])[0] == [coder.text[a], coder.text[b]] for a, b in pairs] and {*found} == {True, False}
    families = coder.families()
    assert sum(map(len, families)) == len(set().union(*families))
    own = {c: k for k, x in enumerate(families) for c in x}
    assert all(len({own.get(c, c) for c in p.strip(pieces.SPACE)}) <= 1 for p in coder.pieces)


# what the earlier operators had no test of

def test_write_shards(spark, tmp_path):
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    names = sharding.shard_names(4)
    sharding.write_shards(df, "doc_id", names, str(tmp_path / "out"), files_per_shard=2, slots=101)
    back = spark.read.parquet(str(tmp_path / "out"))
    placed, n = sharding.place(df, "doc_id", names, 101)
    assert {(r.doc_id, r.shard) for r in back.collect()} == {(r.doc_id, r[n["shard"]]) for r in placed.collect()}
    with pytest.raises(ValueError, match="shard"):
        sharding.write_shards(df.withColumn("Shard", F.lit(1)), "doc_id", names, str(tmp_path / "no"))


def test_registered(spark):
    from churnlens.llm import registry
    assert {k.split("_")[0] for k in registry.queries()} == {f"op{i}" for i in range(1, 14)}
    assert common.internal(spark.range(1).withColumn("__x", F.lit(1)), "x") == "__x_" and secrets is not None
