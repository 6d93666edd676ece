"""How document filters interact: what each removes alone, after others, and on average over all orders of them.

`flagged` reads every text once and gives each document its part, a mask with a bit for each filter that it fails, and the
SHA-256 of its whole text, by which texts are told apart from there on. Whether a text repeats another one is found behind a
counting Bloom prepass (`failing_repeats`): each task counts the positions of its texts, three for each in a segment of
32,768 counters; the merged counts show with certainty that a text is unique if any of its positions is counted once.
Only possible repeats are shuffled for the exact minimum id of each text. What fails by it moves between masks, so that
filters meet in additive counts of (part, mask), some 32 rows a part, and every order is computed from these alone.

Texts count by whole content: null as empty. A document fails as a repeat if its text is also that of a smaller id; rows
of the smallest id do not, however often it occurs, and null ids are not compared at all. Labels count if any row of the
id has them; labels of null or unknown ids count nowhere. Null parts are the empty string. An empty table gives an
empty result. Other columns of the inputs, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linemart.llm.shared import stored

#: Filters by letter; bit k of a mask is the kth.
FILTERS = "ABCDE"
REPEAT = 1 << FILTERS.index("E")
UPPER, SIGNS, INNER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|", bytes(range(0x80, 0xC0))
#: Counters of a segment of the Bloom filter (as many as a bitmap of Spark has bits), and counters for each text.
SEGMENT, COUNTERS = 32768, 8


def text_mask(text: bytes) -> int:
    """Filters A to D of a text in UTF-8: few words, few distinct words, many capitals, signs."""
    words = text.split()  # of bytes: at space and 9 to 13
    capitals, points = len(text) - len(text.translate(None, UPPER)), len(text.translate(None, INNER))
    failed = (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * capitals > 3 * points, len(text.translate(None, SIGNS)) < len(text))
    return sum(bad << k for k, bad in enumerate(failed))


def _masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        mask, digest = [], []
        for at in range(0, batch.num_rows, 512):
            for text in batch.column("text").slice(at, 512).to_pylist():
                mask.append(text_mask(text or b"")), digest.append(hashlib.sha256(text or b"").digest())
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("part"), pa.array(mask, pa.int32()), pa.array(digest, pa.binary())], ["id", "part", "mask", "digest"])


def flagged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(id, part, mask, digest) of each document, in one read of the texts."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.col(text_col).cast("binary").alias("text"))
    added = [T.StructField("part", T.StringType()), T.StructField("mask", T.IntegerType()), T.StructField("digest", T.BinaryType())]
    return rows.mapInArrow(_masks, T.StructType([T.StructField("id", rows.schema["id"].dataType), *added]))


def _bit(bitmap: str, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(F.col(bitmap), (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, place.bitwiseAND(F.lit(7)).cast("int")) == 1


def possible_repeats(rows: DataFrame, n: int) -> DataFrame:
    """The rows (with a digest) whose text the counting Bloom filter does not clear as unique; every true repeat is among them.

    A segment holds few texts, so its bitmap of counters above one is small, and all bitmaps are a byte for each text:
    the join by segment broadcasts them where they are small and else moves rows without texts.
    """
    segments = max(1, -(-n * COUNTERS // SEGMENT))
    mixed = F.xxhash64("digest")
    slot = lambda k: F.shiftrightunsigned(mixed, 15 * k).bitwiseAND(F.lit(SEGMENT - 1).cast("long"))
    placed = rows.withColumns({"_segment": F.pmod(F.xxhash64("digest", F.lit(1)), F.lit(segments))} | {f"_p{k}": slot(k) for k in range(3)})
    places = placed.select("_segment", F.explode(F.array_distinct(F.array("_p0", "_p1", "_p2"))).alias("p"))
    counted = places.groupBy("_segment", "p").agg(F.count("*").alias("n")).filter("n > 1")
    full = counted.groupBy("_segment").agg(F.bitmap_construct_agg("p").alias("_full"))
    met = placed.join(full, "_segment")
    return met.filter(_bit("_full", F.col("_p0")) & _bit("_full", F.col("_p1")) & _bit("_full", F.col("_p2"))).select(*rows.columns)


def failing_repeats(rows: DataFrame, n: int) -> DataFrame:
    """The rows whose text a smaller id has too."""
    maybe = possible_repeats(rows.filter("id is not null"), n)
    first = maybe.groupBy("digest").agg(F.min("id").alias("_first"), F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    return maybe.join(first, "digest").filter(F.col("id") > F.col("_first")).select(*rows.columns)


def mask_counts(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part that fail exactly the filters of the mask."""
    marks = labels.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), (F.col("quality") == 1).alias("g"), (F.col("toxic") == 1).alias("t"))
    marks = marks.filter("g or t").groupBy("id").agg(F.max(F.coalesce("g", F.lit(False))).cast("long").alias("good"), F.max(F.coalesce("t", F.lit(False))).cast("long").alias("toxic"))
    told = rows.join(marks, "id", "left").select("id", "part", "mask", "digest", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    held = stored(told)  # narrow, and read three times
    moved = failing_repeats(held, held.count())
    out = [F.col("part"), F.col("mask"), F.lit(1).alias("sign"), "good", "toxic"]
    moves = moved.select("part", F.explode(F.array(F.struct("mask", F.lit(-1).alias("sign")), F.struct(F.col("mask").bitwiseOR(F.lit(REPEAT)).alias("mask"), F.lit(1).alias("sign")))).alias("m"), "good", "toxic")
    both = held.select(*out).unionByName(moves.select("part", "m.mask", "m.sign", "good", "toxic"))
    sums = {"n": F.sum("sign"), "good": F.sum(F.col("sign") * F.col("good")), "toxic": F.sum(F.col("sign") * F.col("toxic"))}
    return both.groupBy("part", "mask").agg(*[v.alias(c) for c, v in sums.items()])


def orders_of(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of all orders.

    Counts of masks are met with each order and step (n! * n of them, so for few filters) and summed at once.
    """
    if len(filters) > 6:
        raise ValueError("all orders of more than six filters are too many")
    orders = ["".join(p) for p in permutations(filters)]
    steps = [(o, s, 1 << filters.index(o[s]), sum(1 << filters.index(x) for x in o[:s])) for o in orders for s in range(len(filters))]
    at = lambda values: F.get(F.lit(values), F.col("k"))
    met = counts.select("*", F.explode(F.sequence(F.lit(0), F.lit(len(steps) - 1))).alias("k"))
    met = met.select("*", F.col("mask").bitwiseAND(at([x[2] for x in steps])).alias("own"), F.col("mask").bitwiseAND(at([x[3] for x in steps])).alias("before"))
    removed, kept = (F.col("own") != 0) & (F.col("before") == 0), (F.col("own") == 0) & (F.col("before") == 0)
    of = lambda condition, c: F.sum(F.when(condition, F.col(c)).otherwise(0)).alias
    out = met.groupBy("part", "k").agg(
        of(kept, "n")("kept"), of(removed, "n")("removed"), of((F.col("own") != 0) & (F.col("before") != 0), "n")("redundant"),
        of((F.col("own") != 0) & (F.col("own") == F.col("mask")), "n")("unique_fails"), of(removed, "good")("good_lost"), of(removed, "toxic")("toxic_lost"),
    )
    named = out.select("part", at([x[0] for x in steps]).alias("filter_order"), at([x[1] + 1 for x in steps]).alias("step"), *out.columns[2:])
    own = F.substring(F.col("filter_order"), F.col("step"), F.lit(1))
    return named.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", own)))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """The interaction of the filters A to E over all documents, for each part, order and step."""
    return orders_of(mask_counts(flagged(docs, id_col, text_col, part_col), labels, id_col))
