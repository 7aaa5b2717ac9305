"""Secret scan with multipart credential linking (operator 10).

Every text is scanned once for *parts*.  Strong parts (``assign``, ``access``,
``hex``) are findings by themselves.  Weak parts (``login``, ``blob``,
``endpoint``) look like ordinary text; one is reported only when a part of a
complementary role stands within ``scope`` characters of it in the same text.
Linking is an interval join in Spark: parts fall into bins of ``scope``
characters and a weak part meets the parts of its own and both neighbouring
bins, so a text of any length splits over tasks and no text is joined whole.

Defined cases: null text is empty text and has no spans; a repeated row gets
the same result as its twin; rows that repeat a doc_id with another text stay
apart; an empty table gives an empty result; other columns of the input are
ignored, whatever their names; offsets are code points, the end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seekframe.llm.common import row_key, stored

ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LOGIN = re.compile(
    r"(?<![A-Za-z0-9_])(?:user(?:_?name)?|login|account|client_?id)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9._@-]{3,}",
    re.I | re.A)
BLOB = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{32,}={0,2}(?![A-Za-z0-9+/_=-])")
ENDPOINT = re.compile(
    r"[a-z][a-z0-9+]{1,9}://[^\s\"'<>]+|(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?::[0-9]{1,5})?(?![0-9.])")

#: Order of kinds at one start.
KINDS = ("assign", "access", "hex", "login", "blob", "endpoint")
#: Roles that complete a weak part: an identifier or a place needs a secret, a secret one of those.
COMPLEMENT = {"login": ("assign", "hex", "blob"), "blob": ("access", "login", "endpoint"),
              "endpoint": ("assign", "hex", "blob")}


def strong_parts(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the findings that need no partner."""
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def weak_parts(text: str) -> list[tuple[int, int, int]]:
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), 3, m.end()) for m in LOGIN.finditer(text)]
    for m in BLOB.finditer(text):
        s = m[0]
        if any(c.isdigit() for c in s) and any(c.isupper() for c in s) and any(c.islower() for c in s):
            out.append((m.start(), 4, m.end()))
    out += [(m.start(), 5, m.end()) for m in ENDPOINT.finditer(text)]
    return sorted(out)


def _spans(parts: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in parts)


_PARTS = "array<struct<start:int,kind:int,stop:int>>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("stop", pa.int32())]))
    for b in batches:
        strong, weak = [], []
        for t in b.column("text"):
            t = t.as_py() or ""
            strong.append(strong_parts(t))
            weak.append(weak_parts(t))
        n = [[sum(p[1] == k for p in s) for s in strong] for k in range(3)]
        structs = [[{"start": s, "kind": k, "stop": e} for s, k, e in p] for p in strong]
        weaks = [[{"start": s, "kind": k, "stop": e} for s, k, e in p] for p in weak]
        sha = [hashlib.sha256(_spans(s).encode()).hexdigest() for s in strong]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("rk"), *(pa.array(x, pa.int64()) for x in n), pa.array(sha),
             pa.array(structs, part), pa.array(weaks, part)],
            names=["doc_id", "rk", "n_assign", "n_access", "n_hex", "base_sha256", "strong", "weak"])


def scan_secrets(docs: DataFrame, *, scope: int = 200) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): counts, digest and every reported part.

    ``strong`` and ``linked`` are arrays of (start, kind, stop); ``linked``
    holds the weak parts that a complementary part completes within ``scope``
    characters (distance between the nearer ends, 0 if they overlap).
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    parts = stored(
        docs.select("doc_id", row_key().alias("rk"), "text").mapInArrow(
            _scan, f"doc_id {id_type}, rk long, n_assign long, n_access long, n_hex long, base_sha256 string, "
                   f"strong {_PARTS}, weak {_PARTS}"), "parts")
    # parts of texts that hold a weak part; equal rows need linking once
    some = (parts.filter(F.size("weak") > 0)
            .select("doc_id", "rk", F.inline(F.concat("strong", "weak")), ).distinct())
    bins = F.floor(F.col("start") / scope)
    last = F.floor(F.col("stop") / scope)              # ends count as points, so a gap of exactly scope is one bin
    # a part stands in every bin that it touches; a weak part looks one bin further on either side
    whole = some.withColumn("bin", F.explode(F.sequence(bins, last))).select(
        "doc_id", "rk", "bin", F.col("start").alias("o_start"), F.col("kind").alias("o_kind"),
        F.col("stop").alias("o_stop"))
    weak = some.filter(F.col("kind") >= 3).withColumn("bin", F.explode(F.sequence(bins - 1, last + 1)))
    completes = F.lit(False)
    for kind, others in COMPLEMENT.items():
        completes |= (F.col("w.kind") == KINDS.index(kind)) & F.col("o.o_kind").isin([KINDS.index(o) for o in others])
    near = (F.col("o.o_start") - F.col("w.stop") <= scope) & (F.col("w.start") - F.col("o.o_stop") <= scope)
    linked = (weak.alias("w").join(
                  whole.alias("o"),
                  F.col("w.doc_id").eqNullSafe(F.col("o.doc_id")) & (F.col("w.rk") == F.col("o.rk"))
                  & (F.col("w.bin") == F.col("o.bin")) & completes & near, "left_semi")
              .groupBy("doc_id", "rk").agg(F.collect_set(F.struct("start", "kind", "stop")).alias("linked")))
    l2 = linked.select(F.col("doc_id").alias("l_id"), F.col("rk").alias("l_rk"), "linked")
    return (parts.join(l2, F.col("doc_id").eqNullSafe(F.col("l_id")) & (F.col("rk") == F.col("l_rk")), "left")
            .select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "strong",
                    F.coalesce("linked", F.expr(f"cast(array() as {_PARTS})")).alias("linked")))


def span_text(parts) -> "F.Column":
    """kind:start:stop of each part, by start, then kind, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(parts), lambda p: F.concat_ws(
        ":", F.element_at(names, p["kind"] + 1), p["start"].cast("string"), p["stop"].cast("string"))), ",")


def secrets_digest(docs: DataFrame) -> DataFrame:
    r = scan_secrets(docs)
    return r.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256",
                    span_text(F.concat("strong", "linked")).alias("spans"),
                    F.size("linked").cast("long").alias("n_linked"))
