"""The registered queries of this subpackage, each over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linemart.llm import centroids, filter_audit, html_wrapper, mixing, packing, quality_rules, secret_scan, sentencepiece_sa, simhash_golay, substring_dedup, topk, url_filter, warc
from linemart.llm.shared import table

Query = Callable[[SparkSession, str], DataFrame]


#: The rules that the contract of op1 names, and words of hosts that label a url as one to block.
URL_RULES = [url_filter.UrlRule("block", "net/"), url_filter.UrlRule("allow", "example.net/en/"), url_filter.UrlRule("block", "example.com/de/"), url_filter.UrlRule("allow", "org/fr/")]
BLOCK_WORDS = ["ads", "adult", "bets", "casino", "pills", "porn", "spam", "track"]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labelled = pages.select("url", url_filter.host_of(F.col("url")).rlike(r"(?:^|[.-])(?:" + "|".join(BLOCK_WORDS) + r")(?:[.-]|$)").cast("int").alias("label"))
    return url_filter.judge(pages, URL_RULES, url_filter.fit(labelled)).select("page_id", "host", "path", "rule", "verdict")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    of = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", of("assign"), of("access"), of("hex"),
        F.sha2(secret_scan.span_list(base_only=True), 256).alias("base_sha256"), secret_scan.span_list().alias("spans"),
    )


def op3_sentencepiece(spark: SparkSession, sf_dir: str, model_path: str | None = None) -> DataFrame:
    import public_tokenizers

    path = model_path or public_tokenizers.path("piece_bpe_32k.model")
    back = sentencepiece_sa.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, decoded_col="decoded")
    return back.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.dedup_substrings(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM docs WHERE len(w) >= 20),
wins AS (SELECT doc_id, s, array_to_string(list_slice(w, s, s + 19), ' ') AS g FROM starts),
ranked AS (SELECT doc_id, s, row_number() OVER (PARTITION BY g ORDER BY doc_id, s) AS k FROM wins),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM ranked WHERE k > 1),
placed AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM docs),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM placed ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""


def op5_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = simhash_golay.near_duplicates(table(spark, sf_dir, "documents"))
    return near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "source", "n_tokens", F.col("epoch").cast("long").alias("epoch"), "block", F.col("slot").cast("long").alias("slot"))


def _op6_sql() -> str:
    rounds = ["b0 AS (SELECT 0.0::DOUBLE AS low, 1.0::DOUBLE AS high)"]
    for k in range(mixing.ROUNDS):
        rounds.append(f"""
t{k} AS (SELECT i, low + i * ((high - low) / {mixing.POINTS}) AS a FROM b{k}, range({0 if k == 0 else 1}, {mixing.POINTS}) AS r(i)),
o{k} AS (SELECT i FROM (SELECT i, sum(pow(p, a)) AS z, max(pow(p, a) / tokens) AS most FROM t{k}, shares GROUP BY i) WHERE most / z * (SELECT total::DOUBLE FROM tot) <= 1.25),
b{k + 1} AS (SELECT low + (n - 1) * ((high - low) / {mixing.POINTS}) AS low, low + n * ((high - low) / {mixing.POINTS}) AS high FROM b{k}, (SELECT coalesce(min(i), {mixing.POINTS}) AS n FROM o{k}))""")
    return rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens,
                  md5('7:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS key FROM documents),
src AS (SELECT source, sum(n_tokens)::BIGINT AS tokens FROM d GROUP BY source),
tot AS (SELECT sum(tokens)::BIGINT AS total FROM src),
shares AS (SELECT tokens / (SELECT total::DOUBLE FROM tot) AS p, tokens FROM src WHERE tokens > 0),
{', '.join(rounds)},
a AS (SELECT CASE WHEN EXISTS (SELECT 1 FROM o0 WHERE i = 0) THEN 0.0 ELSE (SELECT high FROM b{mixing.ROUNDS}) END AS a),
u AS (SELECT source, tokens, CASE WHEN tokens > 0 THEN pow(tokens / (SELECT total::DOUBLE FROM tot), (SELECT a FROM a)) ELSE 0 END AS u FROM src),
q AS (SELECT source, tokens, floor(u / (SELECT sum(u) FROM u) * (SELECT total FROM tot))::BIGINT AS quota FROM u),
p AS (SELECT d.*, tokens, quota, CASE WHEN tokens > 0 THEN quota // tokens ELSE 1 END AS passes,
             coalesce(sum(n_tokens) OVER (PARTITION BY d.source ORDER BY spread % slices, key, n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS place
      FROM (SELECT *, ('0x' || substr(key, 1, 12))::BIGINT AS spread, (SELECT greatest(1, ceil(count(*) / 256.0))::BIGINT FROM d) AS slices FROM d) d
      JOIN q ON d.source IS NOT DISTINCT FROM q.source),
c AS (SELECT *, unnest(range(0, passes + CASE WHEN place < quota - passes * tokens THEN 1 ELSE 0 END)) AS epoch FROM p),
n AS (SELECT greatest(1, ceil(total / 1048576.0))::BIGINT AS blocks FROM tot),
k AS (SELECT *, CASE WHEN tokens = 0 THEN spread % (SELECT blocks FROM n)
                     ELSE least(floor((epoch * tokens + place) * (SELECT blocks FROM n) / greatest(quota, 1)::DOUBLE)::BIGINT, (SELECT blocks FROM n) - 1) END AS block FROM c)
SELECT doc_id, source, n_tokens, epoch::BIGINT AS epoch, block,
       row_number() OVER (PARTITION BY block ORDER BY md5('8:' || key || ':' || epoch), key)::BIGINT AS slot
FROM k
"""


def op7_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


OP7_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
wins AS (
  SELECT doc_id, s, array_to_string(list_slice(w, s, s + 2), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS s FROM docs WHERE len(w) >= 3)),
twice AS (SELECT doc_id, s FROM wins QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(s, s + 3)) AS p FROM twice) GROUP BY doc_id),
m AS (
  SELECT doc_id, t, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
         length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS upper_n,
         length(t) - length(regexp_replace(t, '[a-z]', '', 'g')) AS lower_n,
         length(t) - length(replace(t, '!', '')) AS bangs
  FROM docs LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT (base_failed OR n_symbols > n_words * 0.3 OR upper_n > lower_n OR bangs > n_words * 0.5
            OR n_dup_lines > n_lines * 0.5 OR length(t) > (n_words + 1) * 25) AS kept
FROM b
"""


def op8_html_wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = html_wrapper.extract(table(spark, sf_dir, "pages"))
    return read.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP9_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT page_id, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> s) & 31)::INT + 1, 1), '' ORDER BY i, s DESC) AS payload_digest
      FROM (SELECT page_id, i, ('0x' || substr(h, 5 * i + 1, 5))::INT AS v, unnest([15, 10, 5, 0]) AS s FROM p, range(8) AS r(i)) GROUP BY page_id),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM p JOIN g USING (page_id))
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""


def op10_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, vectors.filter("vec_id % 50 = 0"))


OP10_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""


def op11_centroid_bisectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, found = centroids.cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    digest = F.sha2(F.array_join(F.transform("centroid", lambda v: v.cast("string")), ","), 256)
    total = F.sum("inertia").over(Window.partitionBy())  # of one row for each centroid
    named = found.select("cluster", F.col("inertia").alias("cluster_inertia"), total.alias("inertia"), digest.alias("centroid_sha256"))
    return assigned.join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _op11_sql(rounds: int = 3) -> str:
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS (SELECT n, arg_min(j, struct_pack(d := d, j := j))::INT AS cluster, min(d)::BIGINT AS distance
        FROM (SELECT n, j, list_sum(list_transform(list_zip(e, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM v, c{r}) GROUP BY n)""")
        if r < rounds:
            steps.append(f"""
m{r} AS (SELECT cluster, p, sum(x)::BIGINT AS s, count(*)::BIGINT AS k FROM (SELECT cluster, unnest(e) AS x, unnest(range(64)) AS p FROM v JOIN a{r} USING (n)) GROUP BY cluster, p),
f{r} AS (SELECT cluster, list((s - ((s % k) + k) % k) // k ORDER BY p) AS c FROM m{r} GROUP BY cluster),
c{r + 1} AS (SELECT j, coalesce(f{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN f{r} ON j = cluster)""")
    return f"""
WITH v AS (SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e FROM embeddings
           WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (SELECT (row_number() OVER (ORDER BY h NULLS LAST, e) - 1)::INT AS j, e AS c FROM (SELECT sha256('1:' || vec_id) AS h, e FROM v) ORDER BY h NULLS LAST, e LIMIT 16),
{','.join(steps)}
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (n) JOIN c{rounds} ON j = cluster
"""


def op12_best_fit_packing(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    import public_tokenizers

    pieces = packing.tokenize(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path or public_tokenizers.path("byte_bpe_50k.json"))
    packed = packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return filter_audit.audit(docs, labels)


OP13_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
             [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t),
              regexp_matches(t, '[#$%&*|]'), coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false)] AS bad
      FROM d LEFT JOIN g USING (doc_id)),
c AS (SELECT part, bad, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL),
l AS (SELECT * FROM (VALUES (1), (2), (3), (4), (5)) AS v(x)),
o AS (SELECT [a.x, b.x, c.x, d.x, e.x] AS p FROM l a, l b, l c, l d, l e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT p, array_to_string(list_transform(p, lambda i: 'ABCDE'[i]), '') AS filter_order, unnest(range(1, 6))::INT AS step FROM o),
r AS (SELECT part, filter_order, step, p[step] AS own, n, good, toxic, bad[p[step]] AS fails,
             len(list_filter(list_slice(p, 1, step - 1), lambda i: bad[i])) > 0 AS gone, len(list_filter(bad, lambda x: x)) = 1 AS single
      FROM c, s),
u AS (SELECT part, filter_order, step, own, sum(CASE WHEN NOT fails AND NOT gone THEN n ELSE 0 END)::BIGINT AS kept, sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed,
             sum(CASE WHEN fails AND gone THEN n ELSE 0 END)::BIGINT AS redundant, sum(CASE WHEN fails AND single THEN n ELSE 0 END)::BIGINT AS unique_fails,
             sum(CASE WHEN fails AND NOT gone THEN good ELSE 0 END)::BIGINT AS good_lost, sum(CASE WHEN fails AND NOT gone THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
      FROM r GROUP BY ALL)
SELECT * EXCLUDE (own), (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM u
"""


def queries() -> dict[str, Query]:
    found = [
        op1_url_filter, op2_secret_scan, op3_sentencepiece, op4_substring_dedup, op5_simhash_golay,
        op6_temperature_mix, op7_quality_cascade, op8_html_wrapper, op9_warc_chunks, op10_threshold_topk,
        op11_centroid_bisectors, op12_best_fit_packing, op13_filter_audit,
    ]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op4_substring_dedup": OP4_SQL, "op6_temperature_mix": _op6_sql(), "op7_quality_cascade": OP7_SQL, "op9_warc_chunks": OP9_SQL, "op10_threshold_topk": OP10_SQL} | {"op11_centroid_bisectors": _op11_sql(), "op13_filter_audit": OP13_SQL}
