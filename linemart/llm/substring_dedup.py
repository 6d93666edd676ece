"""Substring dedup with a Count-min prefilter.

Every window of 20 words that also starts earlier (in a smaller id, or before in the same text) has its words
removed. Documents are dealt into blocks by a hash of id and text, and the same exchange feeds three passes over the
blocks, each of which hashes their texts anew, as that costs less than to keep 16 bytes for each window:

1. Each block sends its distinct windows to a Count-min sketch, as partition sketches in sparse form: the window's
   hash names a small sketch of two rows of 65,536 counters, and one cell in each row. A group of these sketches
   sums what all blocks sent and answers each block with a bit for each window: whether both counters reach two.
   Estimates never fall short, so no repeated window is lost; about one window in seventy passes by chance.
2. Each block sends the 128-bit fingerprint of the windows estimated repeated (or seen twice in the block) with the
   smallest id that has it; grouping these exactly answers with a bit for each: whether a smaller id has it.
3. Each block marks the covered words and gives the texts that remain.

A window that thousands of documents share is sent once by each block, whatever it holds, and answered by bits.
The number of sketches follows the number of words, so their load does not depend on the size of the input. A message
goes from a block to a group, so blocks and groups grow with the square root of the input once that is large (to some
20 MB of text at 1 TB): a message then holds dozens of windows at any size, and what is sent follows the input.

Ids are integers; a null id comes before all others. Rows that repeat an id count as one document after another, in
order of a hash of their texts. Null and empty texts have no words. Texts shorter than a window stay whole. An empty
table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SKETCHES = 64  # in a group at least, and summed at once
WIDTH = 1 << 16  # counters in a row
LOAD = 8192  # windows for each sketch
MESSAGE = 400  # bytes of text for each pair of block and group at least
LOWEST = -(2**63)
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class Vocabulary(dict):
    """Word to a place in two arrays of 64-bit hashes; starts anew when it has grown large."""

    def __init__(self) -> None:
        super().__init__()
        self.halves: list[int] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self)
        self.halves.append(xxhash.xxh3_128_intdigest(word))
        return at

    def hashes(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        used, back = np.unique(places, return_inverse=True)
        low = np.array([self.halves[k] & (2**64 - 1) for k in used.tolist()], np.uint64)
        high = np.array([self.halves[k] >> 64 for k in used.tolist()], np.uint64)
        return low[back], high[back]


_vocabulary = Vocabulary()


def rolled(h: np.ndarray, window: int, multiplier: int) -> np.ndarray:
    """Polynomial hash of each window, modulo 2^64, by doubling."""
    if len(h) < window:
        return np.zeros(0, np.uint64)
    power = lambda n: np.uint64(pow(multiplier, n, 2**64))
    out, done, part, size = None, 0, h, 1
    left = window
    while left:
        if left & 1:
            if out is None:
                out, done = part, size
            else:  # out's windows stand before part's
                n = len(h) - (done + size) + 1
                out, done = out[:n] * power(size) + part[done : done + n], done + size
        left >>= 1
        if left:
            n = len(h) - 2 * size + 1
            part, size = part[:n] * power(size) + part[size : size + n], 2 * size
    return out


class Block:
    """The windows of a block of documents; the same for each pass, as it depends on ids and texts only."""

    def __init__(self, table: pa.Table, window: int, groups: int, sketches: int) -> None:
        global _vocabulary
        if len(_vocabulary) > 1_000_000:
            _vocabulary = Vocabulary()
        ids = table.column("id").to_pylist()
        texts = table.column("text").cast(pa.binary()).to_pylist()
        ties = table.column("tie").to_pylist()
        rows = sorted(range(len(ids)), key=lambda k: (LOWEST if ids[k] is None else ids[k], ties[k]))
        self.ids = [ids[k] for k in rows]
        #: what documents are ordered by
        self.places = np.array([(LOWEST if ids[k] is None else ids[k], ties[k]) for k in rows], np.int64).reshape(-1, 2)
        self.words = [(texts[k] or b"").split() for k in rows]
        self.lengths = np.array([len(w) for w in self.words], np.int64)
        self.ends = np.cumsum(self.lengths)
        n = int(self.lengths.sum())
        places = np.fromiter((_vocabulary[w] for ws in self.words for w in ws), np.int64, n)
        low, high = _vocabulary.hashes(places)
        doc = np.repeat(np.arange(len(rows)), self.lengths)
        whole = np.nonzero(doc[: max(n - window + 1, 0)] == doc[window - 1 :])[0] if n >= window else np.zeros(0, np.int64)
        self.start, self.doc = whole, doc[whole]
        self.low = rolled(low, window, MULTIPLIERS[0])[whole]
        self.high = rolled(high, window, MULTIPLIERS[1])[whole]
        self.window, self.groups, self.sketches = window, groups, sketches
        #: distinct windows by their low hash, in order, and how often each is here
        self.distinct, self.back, counts = np.unique(self.low, return_inverse=True, return_counts=True)
        self.local = counts > 1
        self.sketch = self.sketch_of(self.distinct)
        self.group = self.sketch // sketches

    def sketch_of(self, low: np.ndarray) -> np.ndarray:
        return (((low >> np.uint64(32)) * np.uint64(self.groups * self.sketches)) >> np.uint64(32)).astype(np.int64)

    def by_group(self, group: np.ndarray):
        """(group, slice) of a sorted array of groups."""
        if len(group):
            cuts = np.nonzero(np.diff(group))[0] + 1
            yield from ((int(group[a]), slice(a, b)) for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(group)], strict=True))

    def candidates(self, answers: pa.Table, column: str) -> np.ndarray:
        """For each distinct window whether it may be repeated."""
        bits = dict(zip(answers.column("part").to_pylist(), answers.column(column).to_pylist(), strict=True))
        out = self.local.copy()
        for g, s in self.by_group(self.group):
            if g in bits:
                out[s] |= np.unpackbits(np.frombuffer(bits[g], np.uint8), count=s.stop - s.start).astype(bool)
        return out

    def exact(self, candidate: np.ndarray):
        """Occurrences (places in start) of candidates, their distinct fingerprints (in order), and which each has."""
        at = np.nonzero(candidate[self.back])[0]
        both = np.empty(len(at), dtype=[("low", "<u8"), ("high", "<u8")])
        both["low"], both["high"] = self.low[at], self.high[at]
        order = np.lexsort((both["high"], both["low"]))
        first = np.ones(len(at), bool)
        ranked = both[order]
        first[1:] = ranked[1:] != ranked[:-1]
        which = np.empty(len(at), np.int64)
        which[order] = np.cumsum(first) - 1
        return at, ranked[first], which


def _pass1(window: int, groups: int, sketches: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        b = Block(table, window, groups, sketches)
        cells = b.distinct.astype(np.uint32)  # the low half: two cells of 16 bits
        parts, counts, sent = [], [], []
        for g, s in b.by_group(b.group):
            parts.append(g)
            counts.append(np.stack(np.unique(b.sketch[s] - g * sketches, return_counts=True), axis=1).astype(np.uint32).tobytes())
            sent.append(cells[s].tobytes())
        n = len(parts)
        return pa.table({"part": pa.array(parts, pa.int64()), "block": pa.array([key[0].as_py()] * n, pa.int64()), "counts": pa.array(counts, pa.binary()), "cells": pa.array(sent, pa.binary())})

    return run


def _merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Sums what the blocks sent into the sketches of one group, some sketches at a time; a bit for each window whose estimate reaches two."""
    runs = [np.frombuffer(x, np.uint32).reshape(-1, 2) for x in table.column("counts").to_pylist()]
    sizes = [int(r[:, 1].sum()) for r in runs]
    sketch = np.concatenate([np.repeat(r[:, 0], r[:, 1]) for r in runs])
    cells = np.concatenate([np.frombuffer(x, np.uint32) for x in table.column("cells").to_pylist()])
    order = np.argsort(sketch, kind="stable")
    estimate = np.ones(len(cells), bool)
    cuts = np.searchsorted(sketch[order], np.arange(0, int(sketch.max(initial=0)) + 1 + SKETCHES, SKETCHES))
    for k, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
        at = order[a:b]
        base = (sketch[at].astype(np.int64) - k * SKETCHES) * WIDTH
        for row in (0, 1):
            place = base + ((cells[at] >> np.uint32(16 * row)) & np.uint32(0xFFFF))
            estimate[at] &= (np.bincount(place, minlength=SKETCHES * WIDTH) >= 2)[place]
    bits = [np.packbits(x).tobytes() for x in np.split(estimate, np.cumsum(sizes)[:-1])]
    return pa.table({"block": table.column("block"), "part": pa.array([key[0].as_py()] * len(bits), pa.int64()), "bits": pa.array(bits, pa.binary())})


def _pass2(window: int, groups: int, sketches: int):
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, answers: pa.Table) -> pa.Table:
        rows: dict[str, list] = {"part": [], "bits": [], "prints": [], "ids": [], "runs": []}
        if docs.num_rows:
            b = Block(docs, window, groups, sketches)
            candidate = b.candidates(answers, "bits")
            at, prints, which = b.exact(candidate)
            first = np.full(len(prints), len(b.ids), np.int64)
            np.minimum.at(first, which, b.doc[at])
            part = b.sketch_of(prints["low"]) // sketches
            asked = {g: s for g, s in b.by_group(b.group) if candidate[s].any()}
            for g, s in b.by_group(part):
                rows["part"].append(g)
                rows["bits"].append(np.packbits(candidate[asked[g]]).tobytes())
                by_doc = np.argsort(first[s], kind="stable")  # ids then repeat in runs
                docs_here, runs = np.unique(first[s], return_counts=True)
                rows["prints"].append(prints[s][by_doc].tobytes())
                rows["ids"].append(b.places[docs_here].tobytes())
                rows["runs"].append(runs.astype(np.uint32).tobytes())
        n = len(rows["part"])
        kinds = {"part": pa.int64()}
        block = (docs if docs.num_rows else answers).column("block")[0].as_py()
        return pa.table({"block": pa.array([block] * n, pa.int64())} | {k: pa.array(v, kinds.get(k, pa.binary())) for k, v in rows.items()})

    return run


def _group(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Groups fingerprints exactly; for each one sent, in order, whether a smaller id has it."""
    prints = [np.frombuffer(x, "<u8").reshape(-1, 2) for x in table.column("prints").to_pylist()]
    ids = [np.repeat(np.frombuffer(i, np.int64).reshape(-1, 2), np.frombuffer(r, np.uint32), axis=0) for i, r in zip(table.column("ids").to_pylist(), table.column("runs").to_pylist(), strict=True)]
    low, high, doc = np.concatenate([p[:, 0] for p in prints]), np.concatenate([p[:, 1] for p in prints]), np.concatenate(ids)
    order = np.lexsort((doc[:, 1], doc[:, 0], high, low))
    lo, hi, d = low[order], high[order], doc[order]
    new = np.ones(len(order), bool)
    new[1:] = (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
    least = d[new][np.cumsum(new) - 1]
    later = np.empty(len(order), bool)
    later[order] = (d != least).any(axis=1)
    cuts = np.cumsum([len(p) for p in prints])[:-1]
    bits = [np.packbits(x).tobytes() for x in np.split(later, cuts)]
    return pa.table({"block": table.column("block"), "part": pa.array([key[0].as_py()] * len(bits), pa.int64()), "bits": table.column("bits"), "later": pa.array(bits, pa.binary())})


def _pass3(window: int, groups: int, sketches: int):
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, answers: pa.Table) -> pa.Table:
        out: dict[str, list] = {"id": [], "n_words": [], "n_removed": [], "kept_text": []}
        if docs.num_rows:
            b = Block(docs, window, groups, sketches)
            at, prints, which = b.exact(b.candidates(answers, "bits"))
            first = np.full(len(prints), len(b.ids), np.int64)
            np.minimum.at(first, which, b.doc[at])
            earliest = np.full(len(prints), len(b.low), np.int64)
            np.minimum.at(earliest, which, at)
            part = b.sketch_of(prints["low"]) // sketches
            bits = dict(zip(answers.column("part").to_pylist(), answers.column("later").to_pylist(), strict=True))
            later = np.zeros(len(prints), bool)
            for g, s in b.by_group(part):
                by_doc = np.argsort(first[s], kind="stable")
                back = np.empty(len(by_doc), np.int64)
                back[by_doc] = np.arange(len(by_doc))
                later[s] = np.unpackbits(np.frombuffer(bits[g], np.uint8), count=len(by_doc)).astype(bool)[back]
            gone = at[later[which] | (at != earliest[which])]
            n = int(b.lengths.sum())
            edge = np.zeros(n + 1, np.int64)
            np.add.at(edge, b.start[gone], 1)
            np.add.at(edge, b.start[gone] + window, -1)
            stays = np.cumsum(edge[:-1]) == 0
            for k, ws in enumerate(b.words):
                mine = stays[b.ends[k] - len(ws) : b.ends[k]]
                left = ws if mine.all() else [w for w, m in zip(ws, mine.tolist(), strict=True) if m]
                out["id"].append(b.ids[k]), out["n_words"].append(len(ws)), out["n_removed"].append(len(ws) - len(left)), out["kept_text"].append(b" ".join(left))
        kinds = {"kept_text": pa.binary()}
        made = {k: pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()}
        return pa.table(made | {"kept_text": made["kept_text"].cast(pa.string())})

    return run


def dealt_sizes(total: int, block_bytes: int) -> tuple[int, int, int]:
    """(blocks, groups, sketches in a group) for so many bytes of text: MESSAGE bytes at least for each pair of block and group."""
    side = math.isqrt(MESSAGE * total)
    sketches = max(SKETCHES, -(-side // (5 * LOAD)))
    return max(1, -(-total // max(block_bytes, side))), max(1, -(-(total // 5) // (sketches * LOAD))), sketches


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, block_bytes: int = 6_000_000) -> DataFrame:
    """(id, n_words, n_removed, kept_text) for each row; kept words are joined by one space."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, groups, sketches = dealt_sizes(total, block_bytes)
    dealt = rows.withColumn("tie", F.xxhash64("text")).withColumn("block", F.pmod(F.xxhash64("id", "tie"), F.lit(blocks)))
    own = dealt.groupBy("block")
    sent = own.applyInArrow(_pass1(window, groups, sketches), "part long, block long, counts binary, cells binary")
    estimated = sent.groupBy("part").applyInArrow(_merge, "block long, part long, bits binary")
    asked = dealt.groupBy("block").cogroup(estimated.groupBy("block")).applyInArrow(
        _pass2(window, groups, sketches), "block long, part long, bits binary, prints binary, ids binary, runs binary"
    )
    told = asked.groupBy("part").applyInArrow(_group, "block long, part long, bits binary, later binary")
    out = dealt.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        _pass3(window, groups, sketches), "id long, n_words long, n_removed long, kept_text string"
    )
    return out.withColumnRenamed("id", id_col)
