"""Secret scans: multipart credential linking by an interval join.

Each whole text gives candidates (spans in code points): strong ones (an assignment of 12
or more characters, a long AKIA identifier, 16 or more hex digits) and weak ones (a short
assignment, a login or client id, a mixed token of 20 or more characters, an endpoint).
Strong ones are always reported. A weak one is reported only when complementary parts
overlap its scope, the ``SCOPE`` code points around it: a short secret or a token needs an
access identifier or (short secrets) an endpoint, a login needs a secret, an endpoint
needs both. Parts may be strong or weak, and parts that overlap the candidate count too. A
weak one that a strong one of the same role overlaps is a part, but not reported again.

The join: parts are reduced to one row for each (document row, bin of SCOPE code points,
role) with the least start and greatest end, and weak candidates probe the bins of their
scope. In the first and last bin of a scope one bound decides and in the others every part
counts, so this is exact, and no pair of parts is ever built.

Defined results: null text is empty (no spans); repeated rows each get all spans of their
text; a null doc_id is carried through; equal starts are listed in the order of ``KINDS``;
an empty table gives an empty result; columns beyond doc_id and text are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import common as C

KINDS = ("assign", "access", "hex", "short", "login", "token", "endpoint")
BASE_KINDS = 3
ROLE = {"assign": "secret", "access": "ident", "hex": "secret", "short": "secret", "login": "ident", "token": "secret", "endpoint": "endpoint"}
SCOPE = 160
#: The patterns of the strong kinds, with the least length that counts.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_ASSIGN, MIN_ACCESS, MIN_HEX, MIN_SHORT = 12, 18, 16, 4

_ASSIGN = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{%d,}" % (MIN_ACCESS - 4))
_HEX = re.compile(r"[0-9a-f]{%d,}" % MIN_HEX)
_LOGIN = re.compile(r"""\b(?:user(?:name)?|login|client_id|account|access_key_id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@+-]{3,}""", re.IGNORECASE | re.ASCII)
_TOKEN = re.compile(r"[A-Za-z0-9+/_-]{20,}")
_SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.-]{1,20}\Z")
_AFTER_SCHEME = re.compile(r"[^\s\"'<>]+")
_HOST_PORT = re.compile(r"\b\d{1,3}(?:\.\d{1,3}){3}:\d{2,5}\b", re.ASCII)
#: A text without any of these (in lower case) cannot match the pattern.
_ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_LOGIN_HINTS = ("user", "login", "client_id", "account", "access_key_id")

_SPANS = "array<struct<kind:int,strong:boolean,shown:boolean,s:int,e:int>>"
_ARROW = pa.list_(pa.struct([("kind", pa.int32()), ("strong", pa.bool_()), ("shown", pa.bool_()), ("s", pa.int32()), ("e", pa.int32())]))


def candidates(text: str) -> list[dict]:
    """All candidates of one text; weak ones that a strong one of their role overlaps are
    not ``shown``: they count as parts only."""
    strong, weak = [], []
    low = text.lower()
    for m in _ASSIGN.finditer(text) if any(h in low for h in _ASSIGN_HINTS) else ():
        n = m.end(2) - m.start(2)
        if n >= MIN_ASSIGN:
            strong.append((0, *m.span()))
        elif n >= MIN_SHORT:
            weak.append((3, *m.span()))
    strong += [(1, *m.span()) for m in _ACCESS.finditer(text)] if "AKIA" in text else []
    strong += [(2, *m.span()) for m in _HEX.finditer(text)]
    weak += [(4, *m.span()) for m in _LOGIN.finditer(text)] if any(h in low for h in _LOGIN_HINTS) else []
    for m in _TOKEN.finditer(text):
        v = m.group()
        if any(c.isdigit() for c in v) and any(c.isupper() for c in v) and any(c.islower() for c in v):
            weak.append((5, *m.span()))
    weak += [(6, *x) for x in _endpoints(text)]
    shown = _outside(weak, strong) if weak and strong else [True] * len(weak)
    return ([{"kind": k, "strong": True, "shown": True, "s": s, "e": e} for k, s, e in strong]
            + [{"kind": k, "strong": False, "shown": x, "s": s, "e": e} for (k, s, e), x in zip(weak, shown)])


def _endpoints(text: str) -> list[tuple[int, int]]:
    """scheme://rest and address:port, leftmost and without overlap."""
    found, at = [], text.find("://")
    while at >= 0:
        scheme, rest = _SCHEME.search(text, max(0, at - 21), at), _AFTER_SCHEME.match(text, at + 3)
        end = rest.end() if rest else at + 3
        if scheme and rest:
            found.append((scheme.start(), end))
        at = text.find("://", end)
    return found + [m.span() for m in _HOST_PORT.finditer(text)]


def _outside(weak: list[tuple], strong: list[tuple]) -> list[bool]:
    """For each weak span whether no strong one of its role overlaps it: of those that start
    before its end, the greatest end is not beyond its start."""
    taken = {}
    for role in {ROLE[KINDS[k]] for k, _, _ in strong}:
        own = sorted((s, e) for k, s, e in strong if ROLE[KINDS[k]] == role)
        taken[role] = [s for s, _ in own], [0, *accumulate((e for _, e in own), max)]
    out = []
    for k, s, e in weak:
        starts, reach = taken.get(ROLE[KINDS[k]], ([], [0]))
        out.append(reach[bisect_left(starts, e)] <= s)
    return out


def _extract(batches):
    for batch in batches:
        at = batch.schema.get_field_index("text")
        for a, b in C.blocks(batch, "text"):
            part = batch.slice(a, b - a)
            found = pa.array([candidates(t or "") for t in part.column(at).to_pylist()], type=_ARROW)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), found], names=["doc_id", "key", "spans"])


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """doc_id and spans: array of (kind, s, e) of all reported candidates by start and
    kind; kind is an index into ``KINDS``."""
    src = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), C.row_key(doc_id, text).alias("key"), F.col(f"`{text}`").alias("text"))
    rows = cut_lineage(src.mapInArrow(_extract, f"doc_id long, key string, spans {_SPANS}"))
    each = rows.select("key", F.explode("spans").alias("x")).select("key", "x.*").distinct()
    role = F.element_at(F.array(*[F.lit(ROLE[k]) for k in KINDS]), F.col("kind") + 1)
    parts = (each.withColumn("role", role)
             .withColumn("bin", F.explode(F.sequence((F.col("s") / scope).cast("int"), ((F.col("e") - 1) / scope).cast("int"))))
             .groupBy("key", "bin", "role").agg(F.min("s").alias("least"), F.max("e").alias("most")))
    weak = (each.where(~F.col("strong") & F.col("shown")).select("key", "kind", "s", "e")
            .withColumn("bin", F.explode(F.sequence((F.greatest(F.col("s") - scope, F.lit(0)) / scope).cast("int"), ((F.col("e") + scope - 1) / scope).cast("int")))))
    near = (weak.join(parts, ["key", "bin"]).where((F.col("least") < F.col("e") + scope) & (F.col("most") > F.col("s") - scope))
            .groupBy("key", "kind", "s", "e").agg(F.collect_set("role").alias("roles")))
    has = lambda r: F.array_contains("roles", r)
    kind = lambda k: F.col("kind") == KINDS.index(k)
    linked = near.where((kind("short") & (has("ident") | has("endpoint"))) | (kind("token") & has("ident"))
                        | (kind("login") & has("secret")) | (kind("endpoint") & has("ident") & has("secret")))
    linked = linked.groupBy("key").agg(F.collect_list(F.struct("s", "kind", "e")).alias("more"))
    own = F.transform(F.filter("spans", lambda x: x["strong"]), lambda x: F.struct(x["s"].alias("s"), x["kind"].alias("kind"), x["e"].alias("e")))
    both = F.concat(own, F.coalesce("more", F.array().cast("array<struct<s:int,kind:int,e:int>>")))
    return rows.join(linked, "key", "left").select("doc_id", F.sort_array(both).alias("spans"))


def listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["s"], x["e"])), ",")


def _of_kind(k: int):
    return lambda x: x["kind"] == k


def op4_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Query: spans of every document."""
    out = scan(C.table(spark, sf_dir, "documents").select("doc_id", "text"))
    n = [F.size(F.filter("spans", _of_kind(k))).cast("long").alias(f"n_{KINDS[k]}") for k in range(BASE_KINDS)]
    base = F.filter("spans", lambda x: x["kind"] < BASE_KINDS)
    return out.select("doc_id", *n, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
