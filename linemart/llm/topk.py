"""Exact top-k search by inner product with Fagin's threshold algorithm.

Vectors are dealt into blocks; each pair of a candidate block and a query block is one group. Inside, a list of the
block's vectors is sorted for each dimension. For a query the lists are read in step, from the top where the query's
component is positive and from the bottom where it is negative; each vector met is scored in full; reading stops
when the sum of the components at the reading depth can neither beat nor equal the kth score. One block goes first and
gives each query a lower bound of its kth score, with which all other blocks begin. The block results of a query are
then merged. No list or block holds more than a bounded number of rows.

Components are scaled and floored to integers, so scores are exact. Vectors that are null, empty or hold a null or
a component that is not finite take no part. A query is compared with every row of another id; rows that repeat a
candidate's id and vector count each, rows that repeat a query count once; of different vectors of one query id the
smallest is asked for. Shorter vectors count as padded with zeros. Equal scores rank the smaller id first. With fewer
candidates than k all are returned. Null ids take no part. A score that no long can hold is an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linemart.llm.shared import checkpointed

EXACT = 2.0**53


def usable(vector: Column) -> Column:
    ok = F.forall(vector, lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False)))
    return vector.isNotNull() & (F.size(vector) > 0) & ok


def _matrix(table: pa.Table, width: int) -> np.ndarray:
    out = np.zeros((table.num_rows, width))
    vectors = table.column("x").combine_chunks()
    size = vectors.value_lengths().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(table.num_rows), size)
    column = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    out[row, column] = vectors.flatten().to_numpy(zero_copy_only=False)
    return out


def threshold_topk(x: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int, step: int = 32, least: np.ndarray | None = None):
    """(query id, id, score) of the best k rows of x for each query, equal scores by id; x and queries hold integers.

    `least` has a score for each query that k rows elsewhere reach: rows below it are of no use, and may be left out.
    """
    n, width = x.shape
    order = np.ascontiguousarray(np.argsort(x, axis=0, kind="stable").T)  # ascending, a row for each dimension
    value = np.take_along_axis(x.T, order, axis=1)
    whole = np.abs(x).sum(1).max(initial=0) * np.abs(queries).max(initial=0) >= EXACT
    for q, qid, low in zip(queries, query_ids.tolist(), [-np.inf] * len(queries) if least is None else least.tolist(), strict=True):
        down = np.nonzero(q > 0)[0]
        up = np.nonzero(q < 0)[0]
        seen = np.zeros(n, bool)
        met: list[np.ndarray] = []
        scores: list[np.ndarray] = []
        depth, grow, kth, have = 0, step, -np.inf, 0
        while depth < n:
            to = min(n, depth + grow)
            new = np.concatenate([order[down, n - to : n - depth].ravel(), order[up, depth:to].ravel()])
            if not len(down) and not len(up):
                new = np.arange(n)  # a query of zeros: all scores are equal
                to = n
            fresh = np.zeros(n, bool)
            fresh[new] = True
            fresh &= ~seen
            seen |= fresh
            at = np.nonzero(fresh)[0]
            at = at[ids[at] != qid]
            s = x[at] @ q if not whole else np.array([sum(int(a) * int(b) for a, b in zip(r, q, strict=True)) for r in x[at]], object)
            met.append(at), scores.append(s)
            have += len(at)
            if have >= k:
                every = np.concatenate(scores)
                kth = np.partition(every, have - k)[have - k] if not whole else sorted(every)[have - k]
            bound = q[down] @ value[down, n - to] + q[up] @ value[up, to - 1]
            depth, grow = to, 2 * grow
            if bound < low or have >= k and bound < kth or seen.all():
                break
        at, s = np.concatenate(met), np.concatenate(scores)
        at, s = at[s >= low], s[s >= low]
        best = sorted(zip((-s).tolist(), ids[at].tolist(), strict=True))[:k] if len(s) <= 4 * k or whole else None
        if best is None:
            keep = s >= kth
            best = sorted(zip((-s[keep]).tolist(), ids[at][keep].tolist(), strict=True))[:k]
        for neg, i in best:
            yield qid, i, int(-neg)


def _search(k: int, width: int):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table, asked: pa.Table) -> pa.Table:
        found = []
        if rows.num_rows and asked.num_rows:
            at = lambda t: t.column("id").to_numpy()
            least = asked.column("least").to_numpy()
            found = list(threshold_topk(_matrix(rows, width), at(rows), _matrix(asked, width), at(asked), k, least=np.where(np.isnan(least), -np.inf, least)))
        q, i, s = zip(*found, strict=True) if found else ((), (), ())
        if s and not -(2**63) <= min(s) <= max(s) < 2**63:
            raise OverflowError("a score is out of the range of a long")
        return pa.table({"query_id": pa.array(q, pa.int64()), "id": pa.array(i, pa.int64()), "score": pa.array(s, pa.int64())})

    return run


def top_k(
    vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5, scale: float = 256.0,
    block_rows: int = 16384, query_rows: int = 4096,
) -> DataFrame:
    """(query_id, rank, id, score): for each row of queries the k rows of vectors with the largest inner product."""
    whole_number = lambda v: F.when(F.abs(v) < EXACT, F.floor(v).cast("double")).otherwise(v)  # noqa: E731  from 2^53 on all doubles are
    whole = lambda df: df.filter(usable(F.col(vec_col)) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.transform(vec_col, lambda x: whole_number(x.cast("double") * scale)).alias("x")
    )
    rows, asked = whole(vectors), whole(queries).groupBy("id").agg(F.min("x").alias("x"))
    n, width = rows.agg(F.count("*"), F.max(F.size("x"))).first()
    m, wide = asked.agg(F.count("*"), F.max(F.size("x"))).first()
    blocks, query_blocks = max(1, -(-n // block_rows)), max(1, -(-m // query_rows))
    search = _search(k, max(width or 1, wide or 1))
    rows = rows.withColumn("c", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    asked = asked.withColumn("q", F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")

    def found_in(part: DataFrame, first: int, last: int, queries: DataFrame) -> DataFrame:
        """The best k of each query in each of these blocks."""
        both = part.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
        each = queries.withColumn("c", F.explode(F.sequence(F.lit(first), F.lit(last))))
        return both.groupBy("c", "q").cogroup(each.groupBy("c", "q")).applyInArrow(search, "query_id long, id long, score long")

    found = found_in(rows.filter("c = 0"), 0, 0, asked.withColumn("least", F.lit(float("-inf"))))
    if blocks > 1:
        found = checkpointed(found)
        known = found.groupBy(F.col("query_id").alias("id")).agg(F.min("score").cast("double").alias("least"), F.count("*").alias("n")).filter(F.col("n") >= k).drop("n")
        # a double may round a long up, so the bound is taken a little lower
        bounded = asked.join(known, "id", "left").withColumn("least", F.coalesce(F.col("least") - F.abs("least") * 2.0**-50, F.lit(float("-inf"))))
        found = found.union(found_in(rows.filter("c > 0"), 1, blocks - 1, bounded))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")
