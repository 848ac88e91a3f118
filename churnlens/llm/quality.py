"""Quality rules [native]: a threshold table compiled into one Spark projection.

``METRICS`` are native expressions over the whole text (length, symbol, stop-word and
line ratios); ``RULES`` is the threshold table; ``with_metrics`` adds the counts and
``judge`` compiles the table into boolean columns. No user function runs anywhere.

Defined results: a null text counts as empty (no words, rejected by ``min_words``); an
empty text likewise; repeated rows are judged one by one (no row identity is used); an
empty table gives an empty result; extra columns pass through, and a column whose name
an internal one would have is kept, because internal columns live in one struct with a
free name; texts of any length are judged whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

MIN_WORDS = 50
#: Very frequent words of the four languages.
STOP_WORDS = {
    "en": "the of and to in is that for it as was with be by on not he this are or his from at which but have an had they you a".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont avec son ou elle".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha este".split(),
}
SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """``metric op bound`` must hold, else the document fails the rule ``name``."""
    name: str
    metric: str
    op: str
    bound: float


#: The threshold table. Ratios are compared as numerator (scaled) against denominator.
RULES = [
    Rule("min_words", "n_words", ">=", MIN_WORDS),
    Rule("repeated_windows", "repeat_ratio", "<=", 0.5),
    Rule("symbol_ratio", "symbol_ratio", "<=", 0.1),
    Rule("word_length_low", "mean_word_chars", ">=", 2.0),
    Rule("word_length_high", "mean_word_chars", "<=", 14.0),
    Rule("stop_words", "stop_ratio", ">=", 0.02),
    Rule("duplicate_lines", "dup_line_ratio", "<=", 0.5),
    Rule("shouting", "bang_ratio", "<=", 0.5),
]
#: Rules that the base verdict (``base_failed``) consists of.
BASE = ("min_words", "repeated_windows")


def stop_list() -> list[str]:
    words = sorted({w for ws in STOP_WORDS.values() for w in ws})
    return words + sorted({w[:1].upper() + w[1:] for w in words})


def _repeat_words(spans: Column) -> Column:
    """Words covered by windows whose positions (ascending) are given: each covers three,
    less what the next one covers again."""
    gaps = F.zip_with(spans, F.slice(spans, 2, F.greatest(F.size(spans), F.lit(1))),
                      lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
    return F.aggregate(gaps, F.lit(0).cast("long"), lambda s, g: s + g)


def _with_twins(d: DataFrame, keep: list[Column], items: str, eq: str, same) -> DataFrame:
    """The sorted array column ``items`` reduced to elements equal to a neighbour."""
    s, e = F.col(f"`{items}`"), F.col(f"`{eq}`")
    k = F.greatest(F.size(s) - 1, F.lit(0))
    d = d.select(*keep, s, F.zip_with(F.slice(s, 1, k), F.slice(s, 2, k), same).alias(eq))
    no = F.array(F.lit(False))
    hit = F.zip_with(F.concat(no, e), F.concat(e, no), lambda a, b: a | b)
    return d.select(*keep, F.filter(F.zip_with(s, hit, lambda x, f: F.when(f, x)), lambda x: x.isNotNull()).alias(items))


def with_metrics(df: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """``df`` plus one struct column (its name is returned) with the counts and ratios.

    Words in three-word windows that occur twice: the windows of a text with any two equal
    hashes are sorted by hash and neighbours compared, then those with an equal neighbour
    by the words themselves: n log n in one text.
    """
    name = {k: C.internal(df, f"q_{k}") for k in ("t", "w", "lines", "h", "pair", "tri", "eq", "pos", "m")}
    col = {k: F.col(f"`{v}`") for k, v in name.items()}
    keep = [F.col(f"`{c}`") for c in df.columns]
    base = [col[x] for x in ("t", "w", "lines")]
    t = C.text_or_empty(f"`{text}`")
    stripped = F.btrim(t, F.lit(C.WS))
    words = F.when(stripped == "", F.array().cast("array<string>")).otherwise(F.split(stripped, C.WS_RUN))
    d = df.select(*keep, t.alias(name["t"]), words.alias(name["w"]),
                  F.filter(F.split(t, "\n", -1), lambda s: F.length(F.btrim(s, F.lit(C.WS))) > 0).alias(name["lines"]))
    w, n = col["w"], F.size(col["w"])
    h = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))))
    d = d.select(*keep, *base, h.alias(name["h"]))
    h = col["h"]
    # a text whose windows all hash apart has no window twice: nothing to sort
    pairs = F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))))
    d = d.select(*keep, *base, pairs.alias(name["pair"]))
    d = _with_twins(d, [*keep, *base], name["pair"], name["eq"], lambda a, b: a["h"] == b["h"])
    tri = F.transform(col["pair"], lambda e: F.struct(
        e["h"].alias("h"), F.concat_ws(" ", F.get(w, e["i"]), F.get(w, e["i"] + 1), F.get(w, e["i"] + 2)).alias("x"), e["i"].alias("i")))
    d = d.select(*keep, *base, F.sort_array(tri).alias(name["tri"]))
    d = _with_twins(d, [*keep, *base], name["tri"], name["eq"], lambda a, b: (a["h"] == b["h"]) & (a["x"] == b["x"]))
    d = d.select(*keep, *base, F.sort_array(F.transform(col["tri"], lambda e: e["i"])).alias(name["pos"]))
    per = F.greatest(n, F.lit(1)).cast("double")
    stop = F.size(F.filter(w, lambda x: x.isin(stop_list())))
    bang = F.length(col["t"]) - F.length(F.replace(col["t"], F.lit("!"), F.lit("")))
    chars = F.length(F.array_join(w, ""))
    symbols = F.size(F.split(col["t"], SYMBOLS, -1)) - 1
    dup = F.size(col["lines"]) - F.size(F.array_distinct(col["lines"]))
    rep = F.coalesce(_repeat_words(col["pos"]), F.lit(0).cast("long"))
    metrics = F.struct(
        n.cast("long").alias("n_words"), chars.cast("long").alias("word_chars"), symbols.cast("long").alias("n_symbols"),
        dup.cast("long").alias("n_dup_lines"), rep.alias("n_repeat_words"),
        (rep / per).alias("repeat_ratio"), (symbols / per).alias("symbol_ratio"), (chars / per).alias("mean_word_chars"),
        (stop / per).alias("stop_ratio"), (dup / F.greatest(F.size(col["lines"]), F.lit(1))).alias("dup_line_ratio"),
        (bang / per).alias("bang_ratio"))
    return d.select(*keep, metrics.alias(name["m"])), name["m"]


def compile_rules(metrics: Column, rules: list[Rule]) -> Column:
    """The names of the rules that fail, in the table's order, as one array expression."""
    ops = {">=": lambda a, b: a >= b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, "<": lambda a, b: a < b}
    failed = [F.when(~ops[r.op](metrics[r.metric], F.lit(r.bound)), F.lit(r.name)) for r in rules]
    return F.filter(F.array(*failed), lambda x: x.isNotNull())


def judge(df: DataFrame, rules: list[Rule] | None = None, text: str = "text") -> tuple[DataFrame, str, str]:
    """``df`` plus a struct of metrics and an array of failed rule names (both column
    names are returned). A document is kept when the array is empty."""
    d, m = with_metrics(df, text)
    failed = C.internal(d, "failed_rules")
    return d.withColumn(failed, compile_rules(F.col(f"`{m}`"), RULES if rules is None else rules)), m, failed


def keep_documents(df: DataFrame, rules: list[Rule] | None = None, text: str = "text") -> DataFrame:
    """The rows that pass every rule, with the columns of ``df``."""
    d, _, failed = judge(df, rules, text)
    # A filter on a plain column would be pushed below the projections, and their array
    # functions written out inside one another; one on a column that depends on the task's
    # number stays above them.
    kept = C.internal(d, "kept")
    d = d.withColumn(kept, F.when(F.spark_partition_id() >= 0, F.size(F.col(f"`{failed}`")) == 0))
    return d.where(F.col(f"`{kept}`")).select(*[F.col(f"`{c}`") for c in df.columns])


def op1_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Query: counts and verdicts of every document."""
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    d, m, failed = judge(docs)
    base = F.arrays_overlap(F.col(failed), F.array(*[F.lit(b) for b in BASE]))
    return d.select("doc_id", *[F.col(m)[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                    base.alias("base_failed"), (F.size(failed) == 0).alias("kept"), F.concat_ws(",", failed).alias("failed_rules"))


def _sql_list(words: list[str]) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


SQL = rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS x FROM documents),
w AS (SELECT r, doc_id, x, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS w,
      list_filter(string_split(x, chr(10)), lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS lines FROM t),
tri AS (SELECT r, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] AS k
        FROM (SELECT r, w, unnest(generate_series(1, len(w) - 2)) AS i FROM w)),
rep AS (SELECT r, count(DISTINCT p) AS c FROM (
          SELECT r, unnest([i, i + 1, i + 2]) AS p FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c FROM tri) WHERE c > 1)
        GROUP BY r),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
        (length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines,
        len(list_filter(w, lambda s: s IN {_sql_list(stop_list())})) AS n_stop, length(x) - length(replace(x, '!', '')) AS n_bang
      FROM w LEFT JOIN rep USING (r)),
v AS (SELECT *, greatest(n_words, 1)::DOUBLE AS n, concat_ws(',',
        CASE WHEN n_words < {MIN_WORDS} THEN 'min_words' END,
        CASE WHEN n_repeat_words / greatest(n_words, 1)::DOUBLE > 0.5 THEN 'repeated_windows' END,
        CASE WHEN n_symbols / greatest(n_words, 1)::DOUBLE > 0.1 THEN 'symbol_ratio' END,
        CASE WHEN word_chars / greatest(n_words, 1)::DOUBLE < 2 THEN 'word_length_low' END,
        CASE WHEN word_chars / greatest(n_words, 1)::DOUBLE > 14 THEN 'word_length_high' END,
        CASE WHEN n_stop / greatest(n_words, 1)::DOUBLE < 0.02 THEN 'stop_words' END,
        CASE WHEN n_dup_lines / greatest(n_lines, 1)::DOUBLE > 0.5 THEN 'duplicate_lines' END,
        CASE WHEN n_bang / greatest(n_words, 1)::DOUBLE > 0.5 THEN 'shouting' END) AS failed_rules FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, failed_rules = '' AS kept, failed_rules
FROM v
"""
