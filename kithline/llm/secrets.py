"""Secrets in text, with multipart credentials found by linking their parts.

Patterns with an unmistakable shape (``assign``, ``access``, ``hex``) are reported wherever they stand. A credential
also has parts that alone prove nothing: a client or user id (``ident``), a random-looking key (``key``), an address to
log in to (``endpoint``). Such weak candidates are reported only when complementary parts stand within ``reach`` code
points in the same scope, a paragraph: an identifier with a secret, an endpoint with both. The link is an interval join:
parts meet in cells of ``reach`` code points, each part being sent to all cells that it covers and a weak one also to
the neighbours at both ends, and the distance decides. A cell holds at most as many parts as fit into it, so no group
grows with the input.

Defined results: a null text is empty; repeated rows each get a result; other columns are ignored.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kithline.llm.common import met
from kithline.plans.staging import Staging

# The base patterns, in the order in which kinds are listed, and the least length of each.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LEAST = 8

IDENT = re.compile(
    r"""(?:access[_-]?key(?:[_-]?id)?|client[_-]?id|account[_-]?id|user(?:[_-]?(?:id|name))?|login)"""
    r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9][A-Za-z0-9._@+-]{2,}""", re.A | re.I)
KEY = re.compile(r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/_-]{24,}={0,2}(?![A-Za-z0-9+/=_-])")
ENDPOINT = re.compile(r"""(?:(?:host|endpoint|server)["']?\x20*[:=]\x20*["']?)?[a-z][a-z0-9+.-]{1,15}://[^\s"'<>]+|(?:host|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]+(?::\d+)?""", re.A | re.I)
BLANK_LINE = re.compile(r"\n[ \t\r]*\n")

KINDS = ("assign", "access", "hex", "ident", "key", "endpoint")
_ROLE = {"assign": "secret", "hex": "secret", "access": "identifier", "ident": "identifier", "key": "secret", "endpoint": "endpoint"}
_SPAN = "struct<start: int, rank: int, end: int>"
_PART = "struct<start: int, rank: int, end: int, scope: int, role: string>"


@dataclass(frozen=True)
class SecretScan:
    reach: int = 300


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, rank of the kind, end) of the base patterns, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _random_looking(value: str) -> bool:
    return any(c.isdigit() for c in value) and any(c.islower() for c in value) and any(c.isupper() for c in value)


def parts(text: str, base: list[tuple[int, int, int]]) -> list[dict]:
    """All parts of possible multipart credentials, with their paragraph; nothing if there is no identifier."""
    found = list(base) + [(m.start(), 3, m.end()) for m in IDENT.finditer(text)]
    if not any(_ROLE[KINDS[rank]] == "identifier" for _, rank, _ in found):
        return []
    covered = sorted((start, end) for start, rank, end in base)
    starts = [s for s, _ in covered]

    def free(start: int, end: int) -> bool:
        at = bisect.bisect_right(starts, start) - 1
        return not (at >= 0 and covered[at][1] > start) and not (at + 1 < len(covered) and covered[at + 1][0] < end)

    found += [(m.start(), 4, m.end()) for m in KEY.finditer(text) if _random_looking(m[0]) and free(m.start(), m.end())]
    found += [(m.start(), 5, m.end()) for m in ENDPOINT.finditer(text)]
    if all(rank < 3 for _, rank, _ in found):
        return []
    gaps = [m.start() for m in BLANK_LINE.finditer(text)]
    return [{"start": s, "rank": r, "end": e, "scope": bisect.bisect_right(gaps, s), "role": _ROLE[KINDS[r]]}
            for s, r, e in sorted(found)]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32())])
    part = pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32()), ("scope", pa.int32()), ("role", pa.string())])
    for batch in batches:
        spans, candidates = [], []
        for value in batch.column("text"):
            text = value.as_py()
            base = base_spans(text)
            spans.append([{"start": s, "rank": r, "end": e} for s, r, e in base])
            candidates.append(parts(text, base))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("tag"), pa.array(spans, pa.list_(span)), pa.array(candidates, pa.list_(part))],
            names=["doc_id", "tag", "base", "parts"])


def linked_parts(scanned: DataFrame, cfg: SecretScan) -> DataFrame:
    """(doc_id, tag, linked) with the weak parts that complementary ones stand near to."""
    row = ["doc_id", "tag", "scope"]
    part = scanned.where(F.size("parts") > 0).select("doc_id", "tag", F.explode("parts").alias("p")).select(
        "doc_id", "tag", "p.*").distinct()
    first, last = (F.floor(F.col(c) / cfg.reach) for c in ("start", "end"))
    weak = part.where("rank >= 3").withColumn("cell", F.explode(F.sequence(first - 1, last + 1)))
    # A long part may also lie around a weak one, with both of its ends out of reach.
    other = part.withColumn("cell", F.explode(F.sequence(first, last))).select(
        *row, "role", F.col("start").alias("other_start"), F.col("end").alias("other_end"), "cell")
    gap = F.greatest(F.col("other_start") - F.col("end"), F.col("start") - F.col("other_end"))
    near = weak.withColumnRenamed("role", "own").join(other, [*row, "cell"]).where((gap <= cfg.reach) & (F.col("own") != F.col("role")))
    seen = near.groupBy("doc_id", "tag", "start", "rank", "end", "own").agg(
        F.max((F.col("role") == "secret").cast("int")).alias("secret"), F.max((F.col("role") == "identifier").cast("int")).alias("identifier"))
    complete = seen.where("(own = 'identifier' and secret = 1) or (own = 'secret' and identifier = 1) or "
                          "(own = 'endpoint' and secret = 1 and identifier = 1)")
    return complete.groupBy("doc_id", "tag").agg(F.collect_set(F.struct("start", "rank", "end")).alias("linked"))


def scan(docs: DataFrame, staging: Staging, cfg: SecretScan = SecretScan()) -> DataFrame:
    """(doc_id, tag, base, found) per row of ``docs(doc_id, text)``: base spans, and all spans, as sorted arrays.

    The texts are read once; what is found in them is written, as the linking reads it from several sides."""
    scanned = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("tag", F.xxhash64("text")).mapInArrow(
        _scan, f"doc_id long, tag long, base array<{_SPAN}>, parts array<{_PART}>")
    scanned = staging.put(scanned, "spans").df
    links = linked_parts(scanned, cfg)
    return scanned.join(links, ["doc_id", "tag"], "left").select(
        F.nullif("doc_id", F.lit(-(2**63))).alias("doc_id"), "tag", "base",
        F.array_sort(F.concat("base", F.coalesce("linked", F.array().cast(f"array<{_SPAN}>")))).alias("found"))


def as_text(spans):
    """kind:start:end of sorted spans, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans, kind: str):
    return F.size(F.filter(spans, lambda s: s["rank"] == KINDS.index(kind))).cast("long")


def _redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for value, spans in zip(batch.column("text"), batch.column("_row_spans").to_pylist()):
            text, out, at = value.as_py(), [], 0
            if text is not None and spans:
                for span in spans:
                    if span["end"] > at:
                        if span["start"] >= at:
                            out += [text[at:span["start"]], "[secret]"]
                        at = span["end"]
                text = "".join([*out, text[at:]])
            texts.append(text)
        columns = [pa.array(texts, pa.string()) if name == "text" else batch.column(name) for name in batch.schema.names]
        yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)


def redact(docs: DataFrame, staging: Staging, cfg: SecretScan = SecretScan()) -> DataFrame:
    """``docs(doc_id, text, ...)`` with every span replaced by ``[secret]``; overlapping spans become one. Further columns
    stay, whatever their names."""
    own = [f"_own_{k}" for k in range(len(docs.columns))]
    named = docs.toDF(*own)  # names of this function cannot clash with these
    doc_id, text = (F.col(own[docs.columns.index(c)]) for c in ("doc_id", "text"))
    row = {"_row_id": F.coalesce(doc_id.cast("long"), F.lit(-(2**63))), "_row_tag": F.xxhash64(F.coalesce(text, F.lit("")))}
    found = scan(docs, staging, cfg).where(F.size("found") > 0).select(
        F.coalesce("doc_id", F.lit(-(2**63))).alias("_row_id"), F.col("tag").alias("_row_tag"), F.col("found").alias("_row_spans"),
    ).groupBy("_row_id", "_row_tag").agg(F.first("_row_spans").alias("_row_spans"))
    found = staging.put(found, "redactions")
    marked = named.withColumns(row).join(met(found), [*row], "left").select(*own, "_row_spans").withColumnRenamed(own[docs.columns.index("text")], "text")
    schema = ", ".join([*[f"`{n}` {t}" for n, t in marked.dtypes]])
    return marked.mapInArrow(_redact, schema).drop("_row_spans").toDF(*docs.columns)
