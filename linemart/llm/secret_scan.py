"""Secret scans with multipart credential linking.

A helper finds parts of credentials in each whole text: identifiers, secrets and endpoints. Strong parts (assigned
secrets, access identifiers, long hexadecimal runs) are always reported. Weak parts mean little alone; an interval
join inside each document reports them only if a complementary part starts or ends within `reach` code points: a
weak identifier or an endpoint beside a secret, a weak secret beside an identifier or an endpoint.

The join's key is (row, stretch of `reach` code points), so a key holds at most a few parts, whatever a document
holds. Null and empty texts have no parts and give a row with counts of zero. Repeated rows are scanned one by one
and each gives a row. An empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linemart.llm.shared import checkpointed, renamed, restored

#: Kinds in the order in which they are listed at equal starts, the class of each, and whether it is weak.
KINDS = ["assign", "access", "hex", "weak_id", "weak_secret", "endpoint"]
PART_CLASS = {"assign": "secret", "access": "id", "hex": "secret", "weak_id": "id", "weak_secret": "secret", "endpoint": "endpoint"}
WEAK = ["weak_id", "weak_secret", "endpoint"]
KEYWORDS = ["password", "passwd", "secret", "token", "apikey", "api_key"]

ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
WEAK_ID = re.compile(r"\bA[GINRS][A-Z]A[A-Z0-9]{12,}")
NAMED_ID = re.compile(
    r"""\b(?:user(?:_?name)?|login|account|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}""",
    re.ASCII | re.IGNORECASE,
)
WEAK_SECRET = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")
#: What may follow `://`, and an endpoint by its name; a scheme is looked for backwards from each `://`.
AUTHORITY = re.compile(r"[A-Za-z0-9.-]+(?::\d+)?", re.ASCII)
NAMED_ENDPOINT = re.compile(r"""\b(?:host|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]{3,}(?::\d+)?""", re.ASCII)
SCHEME = frozenset("abcdefghijklmnopqrstuvwxyz0123456789+.-")
WORD = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_")
HINTS = ["://", "user", "login", "account", "client", "access", "host", "endpoint", "server"]


def _mixed(s: str) -> bool:
    """A weak secret has lower and upper case letters and digits, unlike words and numbers."""
    return any(c.isdigit() for c in s) and any(c.islower() for c in s) and any(c.isupper() for c in s)


def endpoints(text: str) -> list[tuple[int, int]]:
    """Urls up to their port, and hosts by name: the leftmost first, none that overlaps the one before. Linear in the text."""
    found = [m.span() for m in NAMED_ENDPOINT.finditer(text)]
    at = text.find("://")
    floor = 0
    while at >= 0:
        if end := AUTHORITY.match(text, at + 3):
            start, k = None, at
            while k > floor and text[k - 1] in SCHEME:
                k -= 1
                if "a" <= text[k] <= "z" and (k == 0 or text[k - 1] not in WORD):
                    start = k
            if start is not None:
                found.append((start, end.end()))
        floor = at + 3
        at = text.find("://", floor)
    out: list[tuple[int, int]] = []
    for s, e in sorted(found):
        if not out or s >= out[-1][1]:
            out.append((s, e))
    return out


def find_parts(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every part of one text, in code points; weak ones not yet linked."""
    found = []
    lower = text.lower()
    if any(k in lower for k in KEYWORDS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    strong = _merged([x[1:] for x in found])
    more = [("weak_id", m.start(), m.end()) for m in WEAK_ID.finditer(text)]
    if any(k in lower for k in HINTS):
        more += [("weak_id", m.start(), m.end()) for m in NAMED_ID.finditer(text)]
        more += [("endpoint", *x) for x in endpoints(text)]
    if more or any(k == "access" for k, *_ in found):
        more += [("weak_secret", m.start(), m.end()) for m in WEAK_SECRET.finditer(text) if _mixed(m[0])]
    return found + [x for x in more if not _touches(strong, x[1], x[2])]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _touches(merged: list[tuple[int, int]], start: int, end: int) -> bool:
    k = bisect.bisect_left(merged, (end, 0)) - 1
    return k >= 0 and merged[k][1] > start


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, id, text) to a row for each part, and one with a null kind for each row."""
    for b in batches:
        place, kind, start, end = [], [], [], []
        for i, text in enumerate(b.column(2).to_pylist()):
            for k, s, e in [(None, None, None), *find_parts(text or "")]:
                place.append(i), kind.append(k), start.append(s), end.append(e)
        took = pa.array(place, pa.int64())
        cols = [b.column(0).take(took), b.column(1).take(took), pa.array(kind, pa.string()), pa.array(start, pa.int32()), pa.array(end, pa.int32())]
        yield pa.RecordBatch.from_arrays(cols, names=["row", "id", "kind", "start", "end"])


def linked(parts: DataFrame, reach: int = 200) -> DataFrame:
    """Parts (row, kind, start, end) to report: all strong ones, and weak ones with a complementary part within `reach`."""
    classed = parts.withColumn("class", F.create_map(*[F.lit(x) for kv in PART_CLASS.items() for x in kv])[F.col("kind")])
    stretch = lambda a, b: F.explode(F.sequence(F.floor(a / reach), F.floor(b / reach)))
    weak = classed.filter(F.col("kind").isin(WEAK)).withColumn("stretch", stretch(F.col("start") - reach, F.col("end") + reach))
    sides = classed.select(
        F.col("row").alias("r"), F.col("class").alias("other"), F.col("start").alias("s"), F.col("end").alias("e"),
        stretch(F.col("start"), F.col("end")).alias("at"),
    )
    near = weak.join(
        sides,
        (F.col("row") == F.col("r")) & (F.col("stretch") == F.col("at"))
        & (F.col("s") <= F.col("end") + reach) & (F.col("e") >= F.col("start") - reach)
        & ((F.col("class") == "secret") != (F.col("other") == "secret")),
        "left_semi",
    )
    return parts.filter(~F.col("kind").isin(WEAK)).unionByName(near.select(*parts.columns).distinct())


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = 200) -> DataFrame:
    """One row per row of docs: the id, `text_hash` and `found`, an array of (start, place, kind, end) in order.

    The texts are read once; what is joined afterwards is the parts, checkpointed with a number for each row.
    """
    keyed = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash")).alias("id"),
        F.col(text_col).alias("text"),
    )
    kept = checkpointed(keyed.mapInArrow(_scan, f"row long, id {keyed.schema['id'].dataType.simpleString()}, kind string, start int, end int"))
    parts = linked(kept.filter(F.col("kind").isNotNull()).select("row", "kind", "start", "end"), reach)
    place = F.array_position(F.lit(KINDS), F.col("kind")).cast("int")
    spans = parts.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", place.alias("place"), "kind", "end"))).alias("found"))
    empty = F.array().cast("array<struct<start:int,place:int,kind:string,end:int>>")
    rows = kept.filter(F.col("kind").isNull()).select("row", F.col("id.id").alias(id_col), F.col("id.hash").alias("text_hash"))
    return rows.join(spans, "row", "left").select(id_col, "text_hash", F.coalesce("found", empty).alias("found"))


def span_list(found: str = "found", base_only: bool = False) -> Column:
    """kind:start:end, comma-joined, of an array that `scan` made."""
    c = F.filter(found, lambda x: ~x["kind"].isin(WEAK)) if base_only else F.col(found)
    return F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(text: str, spans: list[tuple[int, int]], mask: str = "[secret]") -> str:
    """text with each span, overlapping ones together, replaced by mask."""
    out, done = [], 0
    for s, e in _merged(spans):
        out += [text[done:s], mask]
        done = e
    return "".join(out) + text[done:]


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = 200, mask: str = "[secret]") -> DataFrame:
    """docs with every span that `scan` reports masked in the text; other columns as they are.

    Spans come back to their texts by id and text hash, so rows that repeat get the same ones. Columns of any name pass.
    """
    own, name = renamed(docs)
    i, t = name[id_col], name[text_col]
    hits = (
        scan(own, i, t, reach).filter(F.size("found") > 0).dropDuplicates([i, "text_hash"])
        .select(F.col(i).alias("_id"), F.col("text_hash").alias("_hash"), F.expr("transform(found, x -> struct(x.start, x.end))").alias("_spans"))
    )
    both = own.join(hits, own[i].eqNullSafe(hits["_id"]) & (F.xxhash64(own[t]) == hits["_hash"]), "left").drop("_id", "_hash")
    k = own.columns.index(t)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans = b.column(b.num_columns - 1).to_pylist()
            out = b.select(range(b.num_columns - 1))
            if any(spans):
                new = [redact(t, [tuple(x.values()) for x in s], mask) if s and t else t for t, s in zip(b.column(k).to_pylist(), spans, strict=True)]
                out = out.set_column(k, out.schema.field(k), pa.array(new, out.schema.field(k).type))
            yield out

    return both.mapInArrow(run, own.schema).select(*restored(name))
