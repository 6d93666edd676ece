"""Centroid clustering, packing and the filter audit against brute force, and on awkward rows."""

import hashlib
import random
import zlib
from collections import defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from linemart.llm import centroids, filter_audit, packing

TOKENIZER = __import__("public_tokenizers").path("byte_bpe_50k.json")
VECTORS = "vec_id long, embedding array<float>, cluster string"


def floors(x, scale):
    return [int(np.floor(float(v) * scale)) for v in x]


def clustered(rows, k, rounds, width, scale=64.0):
    """(id, vector) -> sorted (id, cluster, distance), centroids; plain Python."""
    kept = [(i, floors(x, scale)) for i, x in rows if x is not None and len(x) == width and all(v is not None and np.isfinite(v) for v in x)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    c = [x for _, x in order[:k]]
    away = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b, strict=True))
    near = lambda x: min((away(x, y), j) for j, y in enumerate(c))
    for _ in range(rounds):
        of = defaultdict(list)
        for _, x in kept:
            of[near(x)[1]].append(x)
        c = [[sum(v) // len(of[j]) for v in zip(*of[j], strict=True)] if of[j] else y for j, y in enumerate(c)]
    return sorted(((i, near(x)[1], near(x)[0]) for i, x in kept), key=str), c


def some_vectors(n=300, width=8, seed=3):
    r = random.Random(seed)
    rows = [(k, [r.choice([-1, 0, 1]) * r.random() for _ in range(width)]) for k in range(n)]
    rows += [(k, [1.0] * width) for k in range(n, n + 150)]  # a hot vector
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[3][1]), (900, None), (901, []), (902, [None] * width), (903, [float("nan")] * width), (904, [float("inf")] * width), (905, [1.0] * (width - 1))]
    return [(i, None if x is None else [None if v is None else float(np.float32(v)) for v in x], "own") for i, x in rows]


@pytest.mark.parametrize("k,rounds,scale", [(16, 3, 64.0), (5, 0, 3.0), (1, 2, 64.0), (16, 2, 1.0)])
def test_clusters_are_those_of_brute_force(spark, k, rounds, scale):
    rows = some_vectors()
    assigned, found = centroids.cluster(spark.createDataFrame(rows, VECTORS).repartition(5), k=k, rounds=rounds, width=8, scale=scale)
    expected, c = clustered([r[:2] for r in rows], k, rounds, 8, scale)
    assert sorted((tuple(r) for r in assigned.select("vec_id", "cluster", "distance").collect()), key=str) == expected
    got = {r["cluster"]: r for r in found.collect()}
    assert [got[j]["centroid"] for j in range(len(c))] == c
    for j, r in got.items():
        assert (r["n"], r["inertia"]) == (sum(1 for x in expected if x[1] == j), sum(x[2] for x in expected if x[1] == j))


def test_ties_go_to_the_smaller_number_and_large_components_are_exact():
    sides = centroids.Bisectors([[0, 0], [2, 0], [0, 2], [2, 0]])
    assert sides.nearest(np.array([[1, 0], [1, 1], [2, 0], [0, 2]]))[0].tolist() == [0, 0, 1, 2]
    big = 2**40
    sides = centroids.Bisectors([[big, 0], [big + 2, 0], [-big, 5]])
    assert sides.large
    won, away = sides.nearest(np.array([[big + 1, 0], [big + 2, 1], [-big, 4]], object))
    assert won.tolist() == [0, 1, 2] and away.tolist() == [1, 1, 1]


def test_few_or_no_vectors(spark):
    assigned, found = centroids.cluster(spark.createDataFrame([], VECTORS), width=2)
    assert assigned.count() == found.count() == 0
    assigned, found = centroids.cluster(spark.createDataFrame([(1, [0.5, 1.0], "x"), (2, [0.5, 1.0], "x")], VECTORS), width=2)
    assert found.count() == 2 and {r["cluster"] for r in assigned.collect()} == {0}  # of equal centroids the smaller number
    with pytest.raises(Exception, match="[Oo]verflow|out of bounds|too (large|big)|int64"):
        centroids.cluster(spark.createDataFrame([(1, [1e30, 0.0], "x"), (2, [-1e30, 0.0], "x")], VECTORS), width=2)[0].collect()


def awkward_texts():
    r = random.Random(5)
    marks = ["a", "Straße", "don't", "x" * 60, "12345", "<|endoftext|>", "　", "日本語", "\x1c", "\x85", "é\n\nnew", "%%%", "’s", " ", "😀"]
    out = [r.choice([" ", "  ", "\n", " \n", "\t"]).join(r.choice(marks) for _ in range(r.randint(0, 40))) for _ in range(200)]
    return [*out, "", None, " ", "  ", " lead", "trail ", "\n", " \n ", "word " * 3000, "y" * 9000, " " * 5000, "one two", "one two"]


def test_ids_are_those_of_the_tokenizers_library():
    encoder = packing.Encoder(TOKENIZER)
    texts = [t or "" for t in awkward_texts()]
    for _ in range(2):  # the second time words are known
        for text, own in zip(texts, encoder.encode(texts), strict=True):
            assert np.frombuffer(own, "<u4").tolist() == encoder.slow.encode(text, add_special_tokens=False).ids, text[:80]


def test_pieces_are_whole_and_packed_without_gaps(spark):
    texts = awkward_texts()
    docs = spark.createDataFrame([(k if k % 50 else None, t, "x", "own") for k, t in enumerate(texts)], "doc_id long, text string, piece string, offset string").repartition(3)
    pieces = packing.tokenize(docs.withColumn("key", F.coalesce("text", F.lit(""))), TOKENIZER, capacity=64)
    packed = packing.pack(pieces, capacity=64, open_bins=5, run=32, shard_tokens=4096)
    rows = packed.collect()
    slow, bins = packing.Encoder(TOKENIZER).slow, defaultdict(list)
    of = defaultdict(list)
    for r in rows:
        assert r["length"] == len(r["ids"]) // 4 and zlib.crc32(r["ids"]) >= 0
        of[r["doc_id"], r["key"]].append(r)
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for (_, text), parts in of.items():
        ids = [*slow.encode(text, add_special_tokens=False).ids, 0]
        n = len({r["piece"] for r in parts})
        assert n == -(-len(ids) // 64)
        for r in parts:
            assert np.frombuffer(r["ids"], "<u4").tolist() == ids[r["start"] : r["start"] + r["length"]]
            assert r["piece"] == 0 or r["length"] == 64
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)
    for parts in bins.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:], strict=False)) and sum(parts[-1]) <= 64
    made = packing.sequences(packed).collect()
    assert {r["sequence_id"]: len(r["ids"]) // 4 for r in made} == {s: sum(p[-1]) for s, p in bins.items()}
    assert sum(r["n_pieces"] for r in made) == len(rows)


def test_best_fit_by_a_plain_list_of_bins():
    r = random.Random(9)
    for open_bins, run in ((1, 1), (3, 1), (8, 16), (500, 64)):
        lengths = [r.randint(1, 100) if r.random() < 0.7 else 30 for _ in range(700)]
        got, offsets, most = packing.best_fit(lengths, 100, open_bins, run)
        free, opened = {}, 0  # open bins by number
        expected = {}
        for base in range(0, len(lengths), run):
            for k in sorted(range(base, min(base + run, len(lengths))), key=lambda k: -lengths[k]):
                fits = [f for f in free.values() if f >= lengths[k]]
                if fits:
                    best = min(fits)
                    b = got[k]
                    assert free[b] == best  # any bin of the best free space
                else:
                    b, opened = opened, opened + 1
                    free[b] = 100
                    assert got[k] == b
                expected[k] = 100 - free[b]
                left = free.pop(b) - lengths[k]
                if left:
                    if len(free) == open_bins:
                        closed = min(free, key=free.get)
                        later = {got[j] for j in range(base, len(lengths)) if j not in expected}
                        same = [x for x in free if free[x] == free[closed]]
                        free.pop(next((x for x in same if x not in later), closed))
                    free[b] = left
        assert offsets == [expected[k] for k in range(len(lengths))] and most <= open_bins
    with pytest.raises(ValueError):
        packing.best_fit([101], 100, 4, 4)


def test_few_sequences_are_used():
    r = random.Random(2)
    lengths = [min(2048, int(r.lognormvariate(6.3, 1)) + 1) for _ in range(20000)]
    bins, _, _ = packing.best_fit(lengths, 2048, 2048, 4096)
    assert len(set(bins)) <= 1.01 * sum(lengths) / 2048


def test_nothing_to_pack(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(packing.tokenize(none, TOKENIZER)).count() == 0


def audited(docs, labels):
    smallest = {}
    for i, t, _ in docs:
        if i is not None:
            smallest[t or ""] = min(i, smallest.get(t or "", i))
    rows = defaultdict(list)
    for i, t, lang in docs:
        t = t or ""
        w = t.encode().split()
        bad = [len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t), any(c in "#$%&*|" for c in t), i is not None and i > smallest[t]]
        mine = [x for x in labels if i is not None and x[0] == i]
        rows[lang or ""].append((bad, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    out = []
    for part, found in rows.items():
        removed_by = defaultdict(int)
        told = []
        for order in permutations(range(5)):
            left = found
            for s, f in enumerate(order):
                failing = [r for r in left if r[0][f]]
                kept = [r for r in left if not r[0][f]]
                removed_by[f] += len(failing)
                told.append((part, "".join("ABCDE"[x] for x in order), s + 1, f, len(kept), len(failing), sum(r[0][f] for r in found) - len(failing), sum(r[0][f] and sum(r[0]) == 1 for r in found), sum(r[1] for r in failing), sum(r[2] for r in failing)))
                left = kept
        out += [(*r[:3], *r[4:], removed_by[r[3]]) for r in told]
    return sorted(out)


def audit_rows():
    r = random.Random(11)
    texts = [r.choice([" ", "\n", "  "]).join(r.choice(["a", "Bc", "d%", "éé", "f", "g" + str(r.randint(0, 400))]) for _ in range(r.choice([0, 3, 190, 260]))) for _ in range(60)]
    docs = [(k, r.choice(texts), r.choice(["en", "de", "", None])) for k in range(400)]
    docs += [(1000 + k, "hot text " * 30, "en") for k in range(300)] + [docs[5], docs[5], (None, docs[7][1], "en"), (None, "only null", None), (2000, None, "en"), (2001, "", "xx"), (2002, "w " * 40000, "de")]
    labels = [(k, r.choice([0, 1, None]), r.choice([0, 1, None])) for k in range(0, 400, 3)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1), (99999, 1, 1)]
    return docs, labels


def test_audit_is_that_of_brute_force(spark):
    docs, labels = audit_rows()
    df = spark.createDataFrame([(*x, "own", 1) for x in docs], "doc_id long, text string, lang string, part string, mask int").repartition(6)
    marks = spark.createDataFrame([(*x, "own") for x in labels], "doc_id long, quality int, toxic int, part string")
    got = filter_audit.audit(df, marks).select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    assert sorted(tuple(r) for r in got.collect()) == audited(docs, labels)


def test_audit_of_empty_tables(spark):
    docs, labels = spark.createDataFrame([], "doc_id long, text string, lang string"), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs, labels).count() == 0
    one = spark.createDataFrame([(1, "x", "en")], "doc_id long, text string, lang string")
    assert filter_audit.audit(one, labels).count() == 600


def test_the_prepass_clears_most_unique_texts_and_no_repeat(spark):
    rows = spark.createDataFrame([(k, "en", 0, hashlib.sha256(str(k if k % 10 else 0).encode()).digest()) for k in range(5000)], "id long, part string, mask int, digest binary")
    maybe = {r["id"] for r in filter_audit.possible_repeats(rows, 5000).collect()}
    assert maybe >= {k for k in range(5000) if k % 10 == 0}
    assert len(maybe) < 500 + 0.08 * 4500
    assert {r["id"] for r in filter_audit.failing_repeats(rows, 5000).collect()} == {k for k in range(10, 5000, 10)}
