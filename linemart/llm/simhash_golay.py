"""SimHash near-duplicates by Golay-code fuzzy hashing.

Fingerprints of 64 bits are cut into segments of 22, 21 and 21 bits, each a word of 23 bits of the perfect binary
Golay code. A word decodes to its codeword, at most three bits away; if exactly three, to the five codewords at
distance four as well. Two words that differ in one bit then share a codeword, so each word has one or six keys.

Links are fingerprints that differ in at most two bits. Two errors over three segments leave some segment without
error whose successor (in a circle) has one error at most: the keys are (segment, exact value, codeword of the
successor). Small buckets are joined and verified pair by pair. A bucket with more than `small` fingerprints takes
another exact way: each fingerprint gives itself and its 64 neighbours, and fingerprints within two bits meet in a
neighbour, where a star to the smallest stands for all pairs. Components follow by large and small stars.

Equal fingerprints are one node throughout, so copies add no keys, pairs or links. Null texts are empty and have
the fingerprint zero. Rows that repeat an id are judged one by one. A null id names a component only if no other id is
there; where one of each group stays, it counts as the smallest. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linemart.llm.shared import bucketed, checkpointed, stored

SEED = 42
#: Generator polynomial of the binary Golay code: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
SEGMENTS = [(0, 22), (22, 21), (43, 21)]


@cache
def golay() -> tuple[np.ndarray, np.ndarray]:
    """Remainders of x^k, and by syndrome of 11 bits the six error patterns of weight 3 and 4, or the lighter one repeated."""
    basis = np.zeros(23, np.uint32)
    for k in range(23):  # remainder of x^k
        r = 1 << k
        for top in range(k, 10, -1):
            if r >> top & 1:
                r ^= GENERATOR << (top - 11)
        basis[k] = r
    keys = np.zeros((1 << 11, 6), np.uint32)
    count = np.zeros(1 << 11, np.int64)
    for weight in (1, 2, 3, 4):
        for at in combinations(range(23), weight):
            syndrome = int(np.bitwise_xor.reduce(basis[list(at)]))
            pattern = sum(1 << k for k in at)
            if weight < 4:
                keys[syndrome] = pattern
                count[syndrome] = 1 if weight == 3 else 9
            elif count[syndrome] < 9:
                keys[syndrome, count[syndrome]] = pattern
                count[syndrome] += 1
    return basis, keys


def syndromes(words: np.ndarray) -> np.ndarray:
    basis, _ = golay()
    out = np.zeros(len(words), np.uint32)
    for k in range(23):
        out ^= np.where(words >> np.uint32(k) & np.uint32(1), basis[k], np.uint32(0)).astype(np.uint32)
    return out


def codewords(words: np.ndarray) -> np.ndarray:
    """Six codewords for each word of 23 bits; all the same where one is enough. The top 12 bits name a codeword."""
    return (words[:, None] ^ golay()[1][syndromes(words)]) >> np.uint32(11)


def fuzzy_keys(prints: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(places in prints, keys) for each of the three segments."""
    parts = [((prints >> np.uint64(a)) & np.uint64((1 << n) - 1)).astype(np.uint32) for a, n in SEGMENTS]
    out = []
    for i in range(3):
        near = codewords(parts[(i + 1) % 3])
        key = (np.uint64(i) << np.uint64(40)) | (parts[i].astype(np.uint64)[:, None] << np.uint64(12)) | near.astype(np.uint64)
        one = (near == near[:, :1]).all(axis=1)
        keep = np.ones(key.shape, bool)
        keep[one, 1:] = False
        out.append((np.nonzero(keep)[0], key[keep]))
    return out


def shingle_hashes(text: bytes, size: int, lower: bool = True) -> np.ndarray:
    """XXH64 (seed 42) of the text's word shingles, repeats included; of the whole sequence if it is shorter."""
    w = (text.lower() if lower else text).split()  # of bytes: A-Z only, white space as in SPACE_CLASS
    if not w:
        return np.zeros(0, np.uint64)
    h = xxhash.xxh64_intdigest
    n = len(w) - size + 1
    if n < 1:
        return np.array([h(b" ".join(w), SEED)], np.uint64)
    return np.fromiter((h(b" ".join(x), SEED) for x in zip(*(w[k:] for k in range(size)), strict=False)), np.uint64, n)


def majority(h: np.ndarray) -> int:
    """Bits that are set in over half of h; zero for none."""
    total = np.zeros(64, np.int64)
    for k in range(0, len(h), 1 << 16):
        bits = np.unpackbits(h[k : k + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > len(h), bitorder="little").tobytes(), "little")


def heavy_weights(h: np.ndarray, seed: int) -> np.ndarray:
    """1 / u^2 with u a hash of the shingle in (0, 1]: equal in every text, and so uneven that few shingles decide."""
    mixed = (h ^ np.uint64((seed * 0x9E3779B97F4A7C15 + 1) & (2**64 - 1))) * np.uint64(0xD6E8FEB86659FD93)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    return (((mixed >> np.uint64(11)).astype(np.float64) + 1) / 2.0**53) ** -2


def heavy_prints(h: np.ndarray, count: int) -> list[int]:
    """`count` weighted fingerprints of a set of shingles."""
    h = np.unique(h)
    if not len(h):
        return [0] * count
    w = np.stack([heavy_weights(h, r) for r in range(count)])
    total = np.zeros((count, 64))
    for k in range(0, len(h), 1 << 14):
        bits = np.unpackbits(h[k : k + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += w[:, k : k + (1 << 14)] @ bits.astype(np.float64)
    ones = np.packbits(total * 2 > w.sum(1)[:, None], axis=1, bitorder="little")
    return ones.view("<u8").ravel().tolist()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp long) per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [majority(shingle_hashes(t or b"", shingle)) for t in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.array(made, np.uint64).view(np.int64))], names=["id", "fp"])

    cols = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return cols.mapInArrow(run, f"id {cols.schema['id'].dataType.simpleString()}, fp long")


def _with_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fp = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        r = b.column("r").to_numpy(zero_copy_only=False)
        for at, key in fuzzy_keys(fp):
            key = key | (r[at].astype(np.uint64) << np.uint64(44))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(r[at]), pa.array(fp[at].view(np.int64))], names=["key", "r", "fp"])


def links(prints: DataFrame, small: int = 64) -> DataFrame:
    """Links between distinct fingerprints (r, fp) of one r at two differing bits or fewer: (r, a, b), a < b.

    All links inside small buckets; for large ones a set of links with the same components.
    """
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # each row gives fifteen, so all tasks take part
    keyed = prints.repartition(parts, "r", "fp").mapInArrow(_with_keys, "key long, r int, fp long")
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = checkpointed(keyed.join(sizes, "key"))
    few = shared.filter(F.col("n") <= small)
    close = F.bit_count(F.col("fp").bitwiseXOR(F.col("b"))) <= 2
    pairs = few.select("key", "r", "fp").join(few.select("key", F.col("fp").alias("b")), "key").filter((F.col("fp") < F.col("b")) & close)
    # the other exact way: a ball of radius one about each fingerprint
    many = shared.filter(F.col("n") > small).select("r", "fp").distinct()
    flips = [1 << k for k in range(63)] + [-(1 << 63)]
    ball = F.array("fp", *[F.col("fp").bitwiseXOR(F.lit(x).cast("long")) for x in flips])
    balls = many.select("r", "fp", F.explode(ball).alias("at"))
    centre = balls.groupBy("r", "at").agg(F.min("fp").alias("a"), F.count("*").alias("n")).filter("n > 1").select("r", "at", "a")
    stars = balls.join(centre, ["r", "at"]).filter("fp <> a").select("r", "a", F.col("fp").alias("b"))
    return pairs.select("r", F.col("fp").alias("a"), "b").unionByName(stars).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b): root is the smallest node reachable.

    Alternates large and small stars until nothing changes, which takes few rounds at any size and has no limit.
    """
    now = checkpointed(edges.select("a", "b").filter("a <> b").distinct())
    before = None
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        now = checkpointed(small.filter("a <> b").distinct())
        mark = now.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
        before = mark


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp, component_id) per row of docs; component_id is the smallest id reachable over links."""
    prints = checkpointed(fingerprints(docs, id_col, text_col, shingle))
    nodes = prints.groupBy("fp").agg(F.min("id").alias("first"))
    edges = links(nodes.select(F.lit(0).alias("r"), "fp"))
    roots = components(edges)
    named = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = checkpointed(named)
    lowest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = named.join(lowest, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def _verified(shingle: int, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[int, np.ndarray] = {}  # of first texts, which repeat where they are a centre

        def made(text: bytes | None) -> np.ndarray:
            return np.unique(shingle_hashes(text or b"", shingle))

        for b in batches:
            first, texts = b.column(0).to_pylist(), [b.column(k).cast(pa.binary()) for k in (2, 3)]
            keep = []
            for k, a in enumerate(first):
                if a not in sets:
                    if len(sets) >= 64:
                        sets.clear()
                    sets[a] = made(texts[0][k].as_py())
                x, y = sets[a], made(texts[1][k].as_py())
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= similarity * (len(x) + len(y) - both))
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


#: Shingles counted at once, how often one is there to be sent on, and bits of a set's parity signature.
COUNTED, OFTEN, BITS = 1 << 21, 3, 1024
#: Frequent shingles of a text that are listed with each of them, at most.
LISTED = 1024


def parities(h: np.ndarray) -> np.ndarray:
    """16 longs: whether the number of shingles whose hash names a bit is odd. Two sets differ in at least as many shingles as bits."""
    odd = np.bincount((h >> np.uint64(17)).astype(np.int64) & (BITS - 1), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _prints_and_counts(shingle: int, prints: int):
    """(v, n, prints, bits) for each text, n shingles in all, and (count, null, [shingle], null) for shingles that many texts of a task share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def batch(v: list[int], n: list, made: list, bits: list) -> pa.RecordBatch:
            longs = pa.list_(pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()), pa.array(n, pa.int32()), pa.array(made, longs), pa.array(bits, longs)], names=["v", "n", "prints", "bits"])

        def counts() -> pa.RecordBatch:
            h, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *held]), return_counts=True)
            held.clear()
            h, n = h[n >= OFTEN].view(np.int64), n[n >= OFTEN]
            return batch(n.tolist(), [None] * len(h), [[x] for x in h.tolist()], [None] * len(h))

        for b in batches:
            n, made, bits = [], [], []
            for text in b.column(1).cast(pa.binary()).to_pylist():
                h = np.unique(shingle_hashes(text or b"", shingle))
                n.append(len(h)), made.append(np.array(heavy_prints(h, prints), np.uint64).view(np.int64)), bits.append(parities(h))
                held.append(h)
                size += len(h)
                if size >= COUNTED:
                    yield counts()
                    size = 0
            yield batch(b.column(0).to_pylist(), n, made, bits)
        yield counts()

    return run


def _postings(shingle: int, similarity: float, common: np.ndarray, counts: np.ndarray, hot: int):
    """(shingle, v, place) for the prefix of each text; place holds the number of shingles and which one this is,
    negative (bitwise not) for shingles known to be in more than `hot` texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes, places, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], []
            for text in b.column(1).cast(pa.binary()).to_pylist():
                h = np.unique(shingle_hashes(text or b"", shingle))
                if not len(h):  # without words: such texts are equal, and differ in white space only
                    hashes.append(np.zeros(1, np.uint64)), places.append(np.zeros(1, np.int64)), sizes.append(1)
                    continue
                often = np.zeros(len(h), np.int64)
                if len(common):
                    at = np.minimum(np.searchsorted(common, h), len(common) - 1)
                    often = np.where(common[at] == h, counts[at], 0)
                order = np.lexsort((h, often))[: len(h) - int(np.ceil(similarity * len(h) - 1e-6)) + 1]
                place = (len(h) << 32) + np.arange(len(order), dtype=np.int64)
                hashes.append(h[order]), places.append(np.where(often[order] > hot, ~place, place)), sizes.append(len(order))
            v = b.column(0).take(pa.array(np.repeat(np.arange(b.num_rows), sizes)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(hashes).view(np.int64)), v, pa.array(np.concatenate(places))], names=["shingle", "v", "place"])

    return run


def _meetings(similarity: float, small: int):
    """From postings sorted by shingle: (null, a, b, null) for pairs in small buckets, (shingle, a, null, place) for rows of large ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["shingle", "a", "b", "place"]
        none = lambda n: pa.nulls(n, pa.int64())
        held = np.zeros((3, 0), np.int64)
        large: int | None = None  # the shingle of held if its bucket is known to be large

        def met(x: np.ndarray, last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, large
            starts = np.flatnonzero(np.r_[True, x[0, 1:] != x[0, :-1]]) if x.shape[1] else np.zeros(0, np.int64)
            sizes = np.diff(np.r_[starts, x.shape[1]])
            is_large = (sizes > small) | (x[2, starts] < 0)
            if len(starts) and large is not None and x[0, 0] == large:
                is_large[0] = True
            held, large = np.zeros((3, 0), np.int64), None
            if len(starts) and not last:
                if is_large[-1]:
                    large = int(x[0, -1])
                else:
                    held, starts, sizes, is_large = x[:, starts[-1] :], starts[:-1], sizes[:-1], is_large[:-1]
            rows = np.repeat(is_large, sizes)
            if rows.any():
                y = x[:, : len(rows)][:, rows]
                yield pa.RecordBatch.from_arrays([pa.array(y[0]), pa.array(y[1]), none(y.shape[1]), pa.array(np.where(y[2] < 0, ~y[2], y[2]))], names=names)
            n = x[2] >> 32
            left = n - (x[2] & 0xFFFFFFFF)
            for m in np.unique(sizes[~is_large]):
                if m < 2:
                    continue
                one, two = np.triu_indices(m, 1)
                step = max(1, (1 << 18) // len(one))
                own = starts[~is_large & (sizes == m)]
                for k in range(0, len(own), step):
                    i, j = ((own[k : k + step, None] + z).ravel() for z in (one, two))
                    enough = (np.minimum(left[i], left[j]) >= similarity / (1 + similarity) * (n[i] + n[j]) - 1e-6) & (np.minimum(n[i], n[j]) >= similarity * np.maximum(n[i], n[j]) - 1e-6)
                    pairs = np.unique(x[1][np.stack([i[enough], j[enough]])], axis=1)
                    yield pa.RecordBatch.from_arrays([none(pairs.shape[1]), pa.array(pairs[0]), pa.array(pairs[1]), none(pairs.shape[1])], names=names)

        for b in batches:
            yield from met(np.concatenate([held, np.stack([b.column(k).to_numpy(zero_copy_only=False) for k in range(3)])], axis=1), False)
        yield from met(held, True)

    return run


def prefix_meetings(texts: DataFrame, shingle: int, similarity: float, often: DataFrame | None = None, small: int = 64) -> DataFrame:
    """Every pair of similar texts (v, text) meets here: (null, a, b, null) in a small bucket, or (shingle, a, null, place) twice in a large one.

    Two sets of this Jaccard similarity have a shingle in common among the first 1 - similarity of each, in whatever
    order all shingles are put. Here those of `often` (shingle, n), the 2^16 most frequent of all texts, come last, so
    that a shared passage makes no bucket. Their counts have an effect on speed only; the rows of a shingle that they
    put over `small` are dealt to many tasks.
    """
    common, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if often is not None:
        most = often.orderBy(F.desc("n"), "shingle").limit(1 << 16).toArrow()
        common, counts = most.column("shingle").to_numpy().view(np.uint64), most.column("n").to_numpy()
        order = np.argsort(common)
        common, counts = common[order], counts[order]
    postings = texts.select("v", "text").mapInArrow(_postings(shingle, similarity, common, counts, small), "shingle long, v long, place long")
    spread = F.when(F.col("place") < 0, F.pmod("v", F.lit(256))).otherwise(F.lit(0).cast("long"))
    dealt = postings.repartition("shingle", spread).sortWithinPartitions("shingle")
    return dealt.mapInArrow(_meetings(similarity, small), "shingle long, a long, b long, place long")


def similar_links(texts: DataFrame, shingle: int = 5, similarity: float = 0.8, prints: int = 6, small: int = 64) -> DataFrame:
    """Links (a, b) between numbers of different texts (v, text), each there once, whose sets of word shingles have at least this Jaccard similarity.

    All components, though not all pairs inside them. A plain SimHash differs in about ten bits at a similarity of 0.8.
    Here each text has several fingerprints whose shingles have heavy-tailed weights, the same in every text: mostly
    one shingle decides, so two fingerprints are within two bits about as often as the texts are similar. They give
    stars: a text and the first of its fingerprint, of two successive fingerprints, and of a linked fingerprint. These
    put large groups together at a cost in proportion to their size. What they leave apart, as texts that are not
    similar to their centre but to each other, meets by `prefix_meetings`. Each pair is verified on whole texts.

    Parity signatures of all shingles tell most pairs that are not from a count of the bits that differ, exactly and
    before any text is read: a set of members that are all just short of similar makes many such pairs.

    texts is read several times and joined by v, so it should be bucketed by it.
    """
    read = checkpointed(texts.select("v", "text").mapInArrow(_prints_and_counts(shingle, prints), "v long, n int, prints array<long>, bits array<long>"))
    often = read.filter("n is null").groupBy(F.col("prints")[0].alias("shingle")).agg(F.sum("v").alias("n"))
    read = read.filter("n is not null")
    made = read.select("v", F.posexplode("prints").alias("r", "fp"))
    first = made.groupBy("r", "fp").agg(F.min("v").alias("a"))
    near = links(first.select("r", "fp"))
    of = lambda name: first.select("r", F.col("fp").alias(name), F.col("a").alias(f"v_{name}"))
    linked = near.join(of("a"), ["r", "a"]).join(of("b"), ["r", "b"]).select(F.col("v_a").alias("a"), F.col("v_b").alias("b"))
    pairs = read.select("v", F.posexplode(F.transform("prints", lambda x, k: F.struct(x.alias("fp"), F.col("prints")[F.pmod(k + 1, F.lit(prints))].alias("fp2")))).alias("r", "two")).select("v", "r", "two.*")
    first2 = pairs.groupBy("r", "fp", "fp2").agg(F.min("v").alias("a"))
    stars = made.join(first, ["r", "fp"]).select("a", F.col("v").alias("b"))
    stars2 = pairs.join(first2, ["r", "fp", "fp2"]).select("a", F.col("v").alias("b"))
    ordered = lambda df: df.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    signature = lambda name: read.select(F.col("v").alias(name), F.struct("n", *[F.col("bits")[k].alias(f"w{k}") for k in range(BITS // 64)]).alias(f"s_{name}"))

    def possible(x: str, y: str) -> Column:
        """Whether sets with these signatures can be similar: sizes, and shingles that are in one of them only."""
        n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
        apart = sum((F.bit_count(F.col(f"{x}.w{k}").bitwiseXOR(F.col(f"{y}.w{k}"))) for k in range(1, BITS // 64)), F.bit_count(F.col(f"{x}.w0").bitwiseXOR(F.col(f"{y}.w0"))))
        return (apart <= (n + m) * F.lit((1 - similarity) / (1 + similarity)) + 1e-6) & (F.least(n, m) >= F.lit(similarity) * F.greatest(n, m) - 1e-6)

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs that are similar. First texts, which may repeat, go to their pairs by a join that can be split; then these go to the second ones."""
        pairs = checkpointed(pairs.join(signature("a"), "a").join(signature("b"), "b").filter(possible("s_a", "s_b")).select("a", "b"))
        firsts = stored(texts.select(F.col("v").alias("a"), F.col("text").alias("x")).join(pairs.select("a").distinct(), "a", "left_semi"))
        both = pairs.join(firsts, "a").join(texts.select(F.col("v").alias("b"), F.col("text").alias("y")), "b")
        return checkpointed(both.select("a", "b", "x", "y").mapInArrow(_verified(shingle, similarity), "a long, b long"))

    found = verified(ordered(stars.union(stars2).union(linked)))
    meetings = checkpointed(prefix_meetings(texts, shingle, similarity, often, small).distinct())
    crowds = meetings.filter("shingle is not null").select("shingle", "a")

    def rooted(df: DataFrame, name: str, roots: DataFrame) -> DataFrame:
        return df.join(roots.select(F.col("node").alias(name), F.col("root").alias(f"root_{name}")), name, "left").withColumn(f"root_{name}", F.coalesce(f"root_{name}", name))

    # members of a group that have no link to its centre mostly have one to some of their neighbours in a random order of those that share a frequent shingle
    roots = checkpointed(components(found))
    sized = crowds.join(crowds.groupBy("shingle").agg(F.count("*").alias("n")), "shingle").withColumn("order", F.xxhash64("a", "shingle"))
    row = Window.partitionBy("shingle", F.pmod("order", F.ceil(F.col("n") / 256))).orderBy("order", "a")
    beside = sized.select("a", F.array(F.lag("a", 1).over(row), F.lag("a", 2).over(row)).alias("two")).select("a", F.explode("two").alias("b")).filter("b is not null")
    apart = rooted(rooted(ordered(beside), "a", roots), "b", roots).filter("root_a <> root_b")
    found = found.union(verified(apart.select("a", "b")))
    roots = checkpointed(components(found))
    met = rooted(rooted(ordered(meetings.filter("shingle is null").select("a", "b")), "a", roots), "b", roots).filter("root_a <> root_b").select("a", "b")
    large = checkpointed(rooted(crowds, "a", roots).withColumnRenamed("root_a", "root"))
    mixed = large.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("shingle")
    large = checkpointed(large.join(mixed, "shingle"))
    # a pair that shares many of these shingles is asked for at the smallest one; long lists are left out, and then it may be asked for more than once
    shared = large.groupBy("a").agg(F.sort_array(F.collect_set("shingle")).alias("l")).select(F.col("a").alias("v"), F.when(F.size("l") <= LISTED, F.col("l")).alias("l"))
    large = large.join(shared.withColumnRenamed("v", "a"), "a").join(signature("a"), "a")
    other = large.select("shingle", F.col("a").alias("b"), F.col("root").alias("root_b"), F.col("s_a").alias("s_b"), F.col("l").alias("l_b"))
    here = F.coalesce(F.array_min(F.array_intersect("l", "l_b")) == F.col("shingle"), F.lit(True))
    crossed = large.join(other, "shingle").filter(F.expr("a < b and root <> root_b") & possible("s_a", "s_b") & here).select("a", "b")
    return found.union(verified(met.union(crossed).distinct()))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """docs without near copies: of each group of similar texts the row with the smallest id stays, its columns as they are.

    Equal texts are folded first: the row with the smallest id of each text is stored in buckets, and from then on texts
    stay where they are. A text is known by a number, the 64-bit hash of its MD5 and its smallest id; two texts that share a
    number by chance both stay if either does.
    """
    key = F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    rows = docs.select(F.struct("*").alias("row"), key.alias("key"), F.col(id_col).alias("id"))
    lowest = rows.groupBy("key").agg(F.min(F.struct("id")).alias("low")).select(F.xxhash64("key", "low.id").alias("v"))
    own = rows.select("row", "key", F.xxhash64("key", "id").alias("v")).join(lowest, "v", "left_semi").dropDuplicates(["v", "key"]).drop("key")
    once = bucketed(own, "v")
    roots = components(similar_links(once.select("v", F.col("row")[text_col].cast("string").alias("text")), shingle, similarity))
    rooted = once.select("v", F.col("row")[id_col].alias("id")).join(roots, once["v"] == roots["node"], "left").select("v", "id", F.coalesce("root", "v").alias("root"))
    stay = rooted.groupBy("root").agg(F.min(F.struct("id", "v")).alias("s")).select("s.v")
    return once.join(stay, "v", "left_semi").select("row.*")
