"""Quality rules as a short-circuit cascade, in built-in expressions only.

A rule is a named Column that is true for a document to reject, and the steps (new column, expression) that it reads, if
any. `order_rules` estimates on a bounded sample how many rows each rule rejects and what it costs, and sorts the rules by
rejections per cost. `verdict` chains rules in one CASE expression, of which Spark evaluates no branch after the first
that holds; `keep` filters by the rules in turn, so that steps are computed only for rows that no earlier rule rejects.
The order has an effect on speed only: a document is rejected if any rule holds.

Null texts count as empty. A text without words is rejected by any rule on the least number of words. Repeated rows are
judged one by one and an empty table gives an empty result. Columns of the input that are named as a measure or verdict
are replaced by it in `quality`; `keep` gives all columns back unchanged, whatever their names.
"""

from __future__ import annotations

import math
import statistics
import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linemart.llm.shared import checkpointed, renamed, restored, words

#: Low bits of a packed number that hold a position: a string has under 2^30 words.
POSITION_BITS = 30
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Column
    steps: tuple[tuple[str, Column], ...] = ()


def repeated_word_count(words_col: str) -> list[tuple[str, Column]]:
    """Steps (new column, expression) that end in `n_repeat_words`: words inside three-word windows that occur
    twice or more. Each step reads the ones before it.

    A window's hash and its position are packed into one long, so a primitive sort brings equal windows together;
    what shares a hash is then compared as text.
    """
    w, mask = F.col(words_col), (1 << POSITION_BITS) - 1
    high = lambda x: F.shiftright(x, POSITION_BITS)
    packed = F.sort_array(
        F.transform(
            F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
            lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).bitwiseAND(F.lit(~mask)).bitwiseOR(i.cast("long")),
        )
    )
    s = F.col("_packed")
    alike = F.filter(s, lambda x, i: (high(x) == high(F.get(s, i + 1))) | (high(x) == high(F.get(s, i - 1))))
    at = lambda x: x.bitwiseAND(F.lit(mask)).cast("int")
    grams = F.sort_array(
        F.transform(
            F.col("_alike"),
            lambda x: F.struct(
                F.concat_ws(" ", F.get(w, at(x)), F.get(w, at(x) + 1), F.get(w, at(x) + 2)).alias("g"), at(x).alias("p")
            ),
        )
    )
    g = F.col("_grams")
    twice = F.filter(g, lambda x, i: F.coalesce(x["g"] == F.get(g, i + 1)["g"], F.lit(False)) | F.coalesce(x["g"] == F.get(g, i - 1)["g"], F.lit(False)))
    t = F.col("_twice")
    covered = F.size(F.array_distinct(F.flatten(F.transform(t, lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2)))))
    return [("_packed", packed), ("_alike", alike), ("_grams", grams), ("_twice", twice), ("n_repeat_words", F.when(F.size(t) > 0, covered).otherwise(F.lit(0)).cast("long"))]


def with_measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words (long)."""
    own, name = renamed(docs.drop(*(c for c in MEASURES if c != text_col)))
    text = F.coalesce(F.col(name[text_col]), F.lit(""))
    out = own.withColumn("_words", words(F.col(name[text_col])))
    out = out.withColumn("_lines", F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    for step, c in repeated_word_count("_words"):
        out = out.withColumn(step, c)
    return (
        out.withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("word_chars", F.length(F.array_join("_words", "")).cast("long"))
        .withColumn("n_symbols", (F.length(text) - F.length(F.regexp_replace(text, "[#*$%&|<>]", ""))).cast("long"))
        .withColumn("n_lines", F.size("_lines").cast("long"))
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .select(*restored(name), *MEASURES)
    )


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 50) | (n_repeat_words * 100 > n_words * 50)


def base_rules(text_col: str = "text") -> list[Rule]:
    """`base_failed` as two rules: too few words, and too many of them in repeated windows."""
    w = words(F.col(text_col))
    n = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    return [Rule("few_words", n < 50), Rule("repeats", F.col("n_repeat_words") * 100 > F.size("_words") * 50, (("_words", w), *repeated_word_count("_words")))]


def text_rules(text_col: str = "text") -> list[Rule]:
    """Rules for what is no prose: symbols, shouting, exclamation marks, table residue, one line over and over.

    All are ratios on the whole text, set so that ordinary prose of any language stays far from them.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    count = lambda pattern: F.length(text) - F.length(F.regexp_replace(text, pattern, ""))
    n_words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return [
        Rule("symbols", count(r"[#*$%&|<>]") > n_words * 0.3),
        Rule("shouting", count(r"[A-Z]") > count(r"[a-z]")),
        Rule("exclamations", count(r"!") > n_words * 0.5),
        Rule("same_lines", (F.size(lines) - F.size(F.array_distinct(lines))) > F.size(lines) * 0.5),
        Rule("long_words", F.length(text) > (n_words + 1) * 25),
    ]


def order_rules(docs: DataFrame, rules: list[Rule], sample_rows: int = 2000, seed: int = 7, repeats: int = 3) -> list[Rule]:
    """rules, those with most rejections per cost first; measured on about `sample_rows` rows (a bound, not a share).

    A rule's cost is the median time of a small job that evaluates it on every row of the sample, less that of one that
    reads the texts only, after a first run of each that compiles it. It counts in powers of two, so that noise seldom
    changes the order. Ties and rules that reject nothing keep the cheaper one first, then the given order. Nothing of
    the sample enters any verdict.
    """
    n = docs.count()
    if not n or len(rules) < 2:
        return list(rules)
    sample = checkpointed(docs.sample(fraction=min(1.0, sample_rows / n), seed=seed))

    def measured(rejects: Column, steps: tuple[tuple[str, Column], ...] = ()) -> tuple[int, float]:
        job, times = sample, []
        for step, c in steps:
            job = job.withColumn(step, c)
        job = job.agg(F.count(F.when(rejects, 1)))
        for _ in range(repeats + 1):
            began = time.perf_counter()
            hits = job.first()[0]
            times.append(time.perf_counter() - began)
        return hits, statistics.median(times[1:])

    _, idle = measured(F.lit(False))
    seen = []
    for k, r in enumerate(rules):
        hits, took = measured(r.rejects, r.steps)
        cost = 2.0 ** round(math.log2(max(took - idle, 1e-3)))
        seen.append((-(hits / cost), cost, k, r))
    return [r for *_, r in sorted(seen, key=lambda x: x[:3])]


def verdict(rules: list[Rule]) -> Column:
    """The first rule that holds by name, or null; later rules are then not evaluated. Steps must be there."""
    if not rules:
        return F.lit(None).cast("string")
    out = F.when(F.coalesce(rules[0].rejects, F.lit(False)), rules[0].name)
    for r in rules[1:]:
        out = out.when(F.coalesce(r.rejects, F.lit(False)), r.name)
    return out


def judge(docs: DataFrame, rules: list[Rule], sample_rows: int = 2000) -> DataFrame:
    """docs with `rejected_by`: the first rule in cascade order that rejects the row, null for rows to keep."""
    return docs.withColumn("rejected_by", verdict(order_rules(docs, rules, sample_rows)))


def quality(docs: DataFrame, text_col: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """All measures, `base_failed` and `kept`: the base rules, then the cascade on what passes them."""
    rules = text_rules(text_col) if rules is None else rules
    cascade = [Rule("base", F.col("base_failed")), *order_rules(docs.select(text_col), rules)]
    out = with_measures(docs, text_col).withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words")))
    return out.withColumn("kept", verdict(cascade).isNull())


def keep(docs: DataFrame, text_col: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """docs without what `rules` (unless given, those of base and text, by the column `_text`) reject, all in one cascade."""
    own, name = renamed(docs)
    out = own.withColumn("_text", F.col(name[text_col]))
    rules = [*base_rules("_text"), *text_rules("_text")] if rules is None else rules
    plain: list[Rule] = []
    for r in [*order_rules(out.select("_text"), rules), None]:
        if r is not None and not r.steps:
            plain.append(r)
            continue
        if plain:
            out, plain = out.filter(verdict(plain).isNull()), []
        if r is not None:
            for step, c in r.steps:
                out = out.withColumn(step, c)
            # the row number stops the optimiser from moving the condition below the steps, where each step's array
            # would be built again for every element of the next
            out = out.withColumn("_at", F.monotonically_increasing_id()).filter(~F.coalesce(r.rejects, F.lit(False)) & (F.col("_at") >= 0))
    return out.select(*restored(name))
