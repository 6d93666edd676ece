"""Packing of tokenized documents into sequences of bounded length by bounded-space online best-fit.

`tokenize` cuts documents into pieces; only documents longer than a sequence are cut. `pack` deals pieces, with whatever
columns they carry, into shards of about `shard_tokens` tokens by row number, so that neither repeated rows nor a hot
key makes a shard larger. In a shard pieces arrive one by one, in runs of `run` pieces with the longest of a run first.
Open bins, never more than `open_bins`, are kept by their free space in a bitset: the lowest set bit from a piece's
length upward is the best fit. A piece that fits no open bin opens one, and if all are in use the fullest closes first.
Bins stay open from one run to the next. A shard is one task's work on lengths alone; texts are read once, where they lie.

Null texts count as empty, and an empty text is the end mark alone. Documents with null or repeated ids are packed like
others, each row by itself; equal lengths keep the order of rows. An empty table gives an empty result. Other columns
are carried; one with the name of an added column is replaced by it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linemart.llm.shared import stored

#: Fixed value: how the byte-level tokenizer of this vocabulary splits texts.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A text falls apart for sure before a space that stands alone.
CUT, UNSURE = re.compile(r"(?<=\S)(?= \S)"), re.compile(r" \s|\s ")
#: Characters of a word that is worth keeping, bytes of all words kept by a worker, characters up to which the fast encoder is used.
WORD, KEPT, LONG = 48, 256 << 20, 4096


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit numbers, by a byte-level BPE vocabulary in the tokenizers format.

    Texts are cut where their tokenization falls apart, and the ids of short words are kept. New words go, joined, through
    an encoder of the same vocabulary that is some five times as fast; the tests hold its ids against the tokenizers
    library, which encodes what is long. The strings of special tokens are ordinary text.
    """

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        byte = {c: b for b, c in enumerate(_byte_letters())}
        special = {x["content"] for x in told["added_tokens"]}
        ranks = {bytes(byte[c] for c in token): n for token, n in told["model"]["vocab"].items() if token not in special}
        self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.starts = np.zeros(max(ranks.values()) + 1, bool)
        self.starts[[n for token, n in ranks.items() if token[:1] == b" "]] = True
        self.words: dict[str, bytes] = {}
        self.size = 0

    def _bytes(self, text: str) -> bytes:
        ids = self.fast.encode_ordinary(text) if len(text) <= LONG else self.slow.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _learn(self, words: list[str]) -> None:
        """Ids of these words after a space; none holds one, so each begins at the only token that does."""
        if self.size > KEPT:
            self.words, self.size = {}, 0
        for k in range(0, len(words), 256):
            part = words[k : k + 256]
            ids = np.array(self.fast.encode_ordinary(" " + " ".join(part)), "<u4")
            at = np.append(np.flatnonzero(self.starts[ids]), len(ids)).tolist()
            if len(at) != len(part) + 1:
                raise ValueError("the vocabulary does not keep words apart")
            own = ids.tobytes()
            for word, a, b in zip(part, at[:-1], at[1:], strict=True):
                self.words[word] = own[4 * a : 4 * b]
                self.size += 4 * (b - a) + 120

    def encode(self, texts: list[str]) -> list[bytes]:
        parts: list[list[str] | None] = [None if UNSURE.search(t) else t.split(" ") for t in texts]
        new = {w for p in parts if p for w in p[1:] if w not in self.words and 0 < len(w) <= WORD}
        if new:
            self._learn(sorted(new))
        known, own = self.words, self._bytes
        out = []
        for text, p in zip(texts, parts, strict=True):
            if p is None:
                out.append(b"".join([own(x) for x in CUT.split(text)]))
            else:
                out.append(b"".join([own(p[0]), *[known[w] if w in known else own(" " + w) for w in p[1:]]]) if text else b"")
        return out


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: itself if it can be printed, else the next one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One for each worker and vocabulary: words are kept from task to task."""
    return Encoder(path)


def _pieces(path: str, capacity: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = np.array([end], "<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                row, piece, start, ids = [], [], [], []
                for k, own in enumerate(encoder(path).encode([t or "" for t in part.column("_text").to_pylist()])):
                    own += mark
                    n = len(own) // 4
                    first = (n - 1) % capacity + 1
                    edges = [0, *range(first, n + 1, capacity)]
                    for p, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                        row.append(k), piece.append(p), start.append(a), ids.append(own[4 * a : 4 * b])
                kept = part.drop_columns(["_text"]).take(pa.array(row, pa.int64()))
                added = [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays([*kept.columns, *added], [*kept.schema.names, "piece", "start", "length", "ids"])

    return run


def tokenize(docs: DataFrame, tokenizer_path: str, text_col: str = "text", capacity: int = 2048, end: int = 0) -> DataFrame:
    """A row for each piece of each document: the other columns of docs, piece (from 0), start, length and ids.

    ids is binary, as numpy.frombuffer(ids, "<u4") reads it: the text's ids and the end mark. Documents of more than
    `capacity` ids are cut from the end, so that the first piece alone may be shorter.
    """
    kept = [f for f in docs.schema.fields if f.name not in (text_col, "piece", "start", "length", "ids", "_text")]
    added = [T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType())]
    rows = docs.select(*[F.col(f"`{f.name}`") for f in kept], F.col(text_col).alias("_text"))
    return rows.mapInArrow(_pieces(tokenizer_path, capacity, end), T.StructType([*kept, *added]))


def best_fit(lengths: list[int], capacity: int, open_bins: int, run: int) -> tuple[list[int], list[int], int]:
    """Bin and offset of each piece, in the order of arrival, and the largest number of bins that were open at once."""
    bins, offsets = [0] * len(lengths), [0] * len(lengths)
    by_free: list[list[int]] = [[] for _ in range(capacity)]
    free_set = made = is_open = most = 0
    for base in range(0, len(lengths), run):
        for k in sorted(range(base, min(base + run, len(lengths))), key=lambda k: -lengths[k]):
            n = lengths[k]
            if not 0 < n <= capacity:
                raise ValueError(f"a piece has {n} tokens; 1 to {capacity} can be packed")
            fits = free_set >> n << n
            if fits:
                free = (fits & -fits).bit_length() - 1
                b = by_free[free].pop()
                if not by_free[free]:
                    free_set ^= 1 << free
                is_open -= 1
            else:
                free, b, made = capacity, made, made + 1
            bins[k], offsets[k] = b, capacity - free
            free -= n
            if free:
                if is_open == open_bins:
                    fullest = (free_set & -free_set).bit_length() - 1
                    by_free[fullest].pop()
                    if not by_free[fullest]:
                        free_set ^= 1 << fullest
                    is_open -= 1
                by_free[free].append(b)
                free_set |= 1 << free
                is_open += 1
                most = max(most, is_open)
    return bins, offsets, most


def pack(pieces: DataFrame, capacity: int = 2048, open_bins: int = 2048, run: int = 4096, shard_tokens: int = 1 << 22) -> DataFrame:
    """pieces (with a column length) and their sequence_id and offset; at most `capacity` tokens share a sequence, without gaps."""
    if not 0 < capacity < 1 << 31 or open_bins < 1 or run < 1:
        raise ValueError("capacity, open bins and runs must be positive")
    rows = stored(pieces.drop("sequence_id", "offset"))
    tokens = rows.agg(F.sum("length")).first()[0] or 0
    shards = max(1, -(-tokens // shard_tokens))
    schema = T.StructType([*rows.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def packed(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("_row")  # rows may arrive in any order
        bins, offsets, _ = best_fit(table.column("length").to_pylist(), capacity, open_bins, run)
        ids = pa.array(np.array(bins, np.int64) + (key[0].as_py() << 32))
        return table.drop_columns(["_row", "_shard"]).append_column("sequence_id", ids).append_column("offset", pa.array(offsets, pa.int64()))

    numbered = rows.withColumn("_row", F.monotonically_increasing_id())  # rows of a stored table: a task that runs again numbers them alike
    return numbered.withColumn("_shard", F.pmod(F.xxhash64("_row"), F.lit(shards))).groupBy("_shard").applyInArrow(packed, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, n_pieces) of packed pieces that carry ids: the training sequences themselves, of bounded length."""
    together = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return together.select("sequence_id", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"), F.size("p").cast("long").alias("n_pieces"))
