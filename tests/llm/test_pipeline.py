"""Each stage of the corpus pipeline against plain Python on the smallest table, and the whole run."""

from collections import Counter

import duckdb
import public_tokenizers
import sentencepiece
import xxhash

import corpus_pipeline
from linemart.llm import secret_scan, shared
from linemart.llm.queries import OP7_SQL
from linemart.llm.shared import stored

SF = "/root/testdata/sf0.001"


def near_copies(rows):
    """Ids to keep: the smallest of each group of texts with 0.8 of their five-word shingles in common."""
    sets = {}
    for r in rows:
        w = (r.text or "").encode().lower().split()
        sets[r.doc_id] = {xxhash.xxh64_intdigest(b" ".join(w[i : i + 5]), 42) for i in range(max(len(w) - 4, 1))} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {find(d) for d in ids}


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, stages = zip(*corpus_pipeline.STAGES, strict=True)
    assert len(names) == 5
    kept = []
    for stage in stages:
        docs = stored(stage(spark, docs, SF))
        kept.append(docs.collect())
    assert all(r.__fields__ == corpus_pipeline.COLUMNS for rows in kept[:4] for r in rows[:1])
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    good = {d for d, k in db.execute(f"SELECT doc_id, kept FROM ({OP7_SQL})").fetchall() if k}
    assert {r.doc_id for r in kept[0]} == good
    assert {r.doc_id for r in kept[1]} == near_copies(kept[0])
    before = {r.doc_id: r.text for r in kept[1]}
    for r in kept[2]:
        spans = secret_scan.find_parts(before[r.doc_id])
        strong = [before[r.doc_id][s:e] for k, s, e in spans if k not in secret_scan.WEAK]
        assert not any(x in r.text for x in strong) and (spans or r.text == before[r.doc_id]) and r.n_chars == len(r.text)
    times = Counter(r.doc_id for r in kept[3])
    assert set(times) <= set(before) and max(times.values()) <= 2 and len(kept[3]) > 0.9 * len(before)
    own = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    masked = {r.doc_id: r.text for r in kept[2]}
    assert all(r.ids == own.encode(masked[r.doc_id]) for r in kept[4]) and len(kept[4]) == len(kept[3])


def test_run_gives_the_last_stage(spark):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "source", "n_ids", "ids", "decoded_sha256"]


AWKWARD = "doc_id long, text string, lang string, source string, n_chars long, _id string, _hash long, root long, text_hash string"


def awkward(spark):
    """Nulls in every column, empty and long texts, repeats, near copies, and columns with the operators' own names."""
    prose = lambda k, n=120: " ".join(f"word{(k * 7919 + j * j) % 1000003} flows" for j in range(n))
    rows = [(k, prose(k), "en", f"s{k % 3}", 9, "x", 1, 2, "h") for k in range(1, 40)]
    rows += [(50, prose(3) + " end", "en", "s1", 9, None, None, None, None), (51, prose(4), None, None, None, "x", 1, 2, "h"), (None, prose(77), "en", "s1", 9, "x", 1, 2, "h")]
    rows += [(60, None, "en", "s1", 0, "x", 1, 2, "h"), (61, "", "en", "s2", 0, "x", 1, 2, "h"), (62, " \n ", None, None, None, "x", 1, 2, "h"), (63, "short", "en", "s0", 5, "x", 1, 2, "h")]
    rows += [(70, prose(500, 30_000), "en", "s2", 9, "x", 1, 2, "h"), (71, prose(600) + " password = 'hunter2secret99' and more " + prose(601), "en", "s0", 9, "x", 1, 2, "h")]
    return spark.createDataFrame([*rows, rows[0], rows[0], rows[-1]], AWKWARD).repartition(3)


def test_stages_take_awkward_documents(spark):
    docs = awkward(spark)
    kept = corpus_pipeline.quality(spark, docs, "").collect()
    assert {r.doc_id for r in kept} == {*range(1, 40), 50, 51, None, 70, 71} and len(kept) == 47
    once = corpus_pipeline.near_copies(spark, docs, "").collect()
    assert {3, 4, 70, 71, None, 60, 63} <= {r.doc_id for r in once} and not {50, 51, 61} & {r.doc_id for r in once} and len({r.doc_id for r in once}) == len(once)
    masked = corpus_pipeline.secrets(spark, docs, "").collect()
    assert len(masked) == docs.count() and all("hunter2" not in (r.text or "") for r in masked) and {r.text for r in masked if r.doc_id == 60} == {None}
    assert {r.text for r in masked if r.doc_id == 3} == {r.text for r in docs.filter("doc_id = 3").collect()}
    mixed = corpus_pipeline.mixture(spark, docs, "").collect()
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in docs.collect()} and {61, 62} <= {r.doc_id for r in mixed}
    ids = corpus_pipeline.pieces(spark, docs, "").collect()
    assert len(ids) == docs.count() and {r.n_ids for r in ids if r.doc_id in (60, 61)} == {0}


def test_stages_of_no_documents(spark):
    none = awkward(spark).limit(0)
    assert [stage(spark, none, "").count() for _, stage in corpus_pipeline.STAGES] == [0] * 5


def test_tables_of_earlier_stages_leave_no_names(spark):
    before, mark = {t.name for t in spark.catalog.listTables()}, len(shared.tables())
    held = shared.stored(corpus_pipeline.near_copies(spark, awkward(spark), ""))
    shared.removed_after(spark, mark, but=held)
    assert {t.name for t in spark.catalog.listTables()} == before and held.count() > 0
