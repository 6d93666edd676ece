"""SentencePiece encoding and decoding by suffix-array matching.

A batch's distinct stretches of text are put together, its suffix array is built by prefix doubling up to the length
of the longest piece, and each piece is binary-searched for the range of suffixes that start with it. The edges
(start, piece) are sorted by position and relaxed from left to right.

Stretches are cut where no piece can cross: before marks of spaces and around line ends. For a BPE model an edge
relaxes a position if its piece may follow the piece that ended there: merging the two pieces' text alone gives these
two back. Pieces that are all so compatible are the model's own result, and there is only one such way to each
position, so no scores are summed. Characters in no piece become byte pieces. A long stretch, as of a script without
spaces, is indexed and relaxed window by window; what ends in the next window is carried over, so nothing is cut.

Null and empty texts have no ids and decode to an empty text. Rows are independent: repeated rows, ties and extra
columns have no effect, and an empty table gives an empty result. Texts of any length are encoded whole.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
BPE = 2
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
#: Characters of distinct text indexed at once, rows of a batch encoded at once, and stretches remembered by a worker.
INDEXED, ROWS, REMEMBERED = 200_000, 512, 200_000
#: Stretches of more characters are relaxed one by one, in windows of so many positions, and not remembered.
LONG, WINDOW = 500, 50_000


@dataclass(frozen=True)
class Model:
    pieces: list[str]
    scores: list[float]
    types: list[int]
    dummy_prefix: bool
    digest: str = ""


def load_model(path: str) -> Model:
    """The parts of a model file that encoding needs. Normalisation must be the identity."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        whole = f.read()
    proto.ParseFromString(whole)
    spec = proto.normalizer_spec
    if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
        raise ValueError("only models without text normalisation are supported")
    if proto.trainer_spec.model_type != BPE:
        raise ValueError("only BPE models are supported")
    return Model([p.piece for p in proto.pieces], [p.score for p in proto.pieces], [p.type for p in proto.pieces], spec.add_dummy_prefix, hashlib.sha256(whole).hexdigest())


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes in order of their first `depth` characters."""
    n = len(codes)
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64) + 1
    k = 1
    while k < depth:
        after = np.zeros(n, np.int64)
        after[: n - k] = rank[k:] if k < n else 0
        rank = np.unique(rank * (n + 2) + after, return_inverse=True)[1].astype(np.int64) + 1
        k *= 2
    return np.argsort(rank, kind="stable")


class Encoder:
    """A model with what a worker remembers of the stretches that it has seen."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.own = [k for k, t in enumerate(model.types) if t in (NORMAL, USER) and model.pieces[k]]
        self.id_of = {model.pieces[k]: k for k in self.own}
        self.width = max(map(len, self.id_of), default=1) + 1
        self.sorted = np.array(sorted(self.id_of), dtype=f"U{self.width}")
        self.names = self.sorted.tolist()
        self.ends = np.array([p + "\U0010ffff" for p in self.sorted], dtype=f"U{self.width}")
        self.ids = np.array([self.id_of[p] for p in self.sorted.tolist()], np.int64)
        self.sizes = np.array([len(p) for p in self.sorted.tolist()], np.int64)
        self.byte = {bytes([int(p[3:5], 16)]): k for k, (p, t) in enumerate(zip(model.pieces, model.types, strict=True)) if t == BYTE}
        self.unknown = next((k for k, t in enumerate(model.types) if t == UNKNOWN), 0)
        self.cut = self.cutter()
        self.bytes_of = self.decoder()
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.fits: dict[int, bool] = {}

    def cutter(self) -> re.Pattern:
        """Stretches that no piece crosses: they end before marks of spaces, around line ends (in no piece), and between
        a word of Latin letters and a sign that in no piece stands beside one."""
        if any(MARK in p[1:] and set(p) != {MARK} or "\n" in p for p in self.id_of):
            return re.compile(".+", re.S)
        letter = "A-Za-z\u00c0-\u024f"
        beside = {c for p in self.id_of for a, b in zip(p, p[1:], strict=False) for c, d in ((a, b), (b, a)) if re.match(f"[{letter}]", d)}
        signs = "".join(re.escape(c) for c in ",.;:!?|#$%*&" if c not in beside) or "\n"
        word, run = rf"{MARK}*[{letter}]+(?=[{signs}{MARK}\n]|\Z)", rf"{MARK}*[{signs}]+(?=[{MARK}\n{letter}]|\Z)"
        return re.compile(rf"{word}|{run}|\n+|{MARK}*[^{MARK}\n]+|{MARK}+")

    def merged(self, text: str) -> list[str]:
        """BPE: adjacent parts whose text is a piece merge, the best score first, the leftmost of equal ones."""
        parts = list(text)
        score, ids = self.model.scores, self.id_of
        while len(parts) > 1:
            best = None
            for k in range(len(parts) - 1):
                t = ids.get(parts[k] + parts[k + 1])
                if t is not None and (best is None or score[t] > best[0]):
                    best = (score[t], k)
            if best is None:
                break
            k = best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def may_follow(self, pair: int, wide: int) -> bool:
        """Whether merging the text of both pieces gives these back; the first is -1 at the start of a stretch."""
        ok = self.fits.get(pair)
        if ok is None:
            x, y = self.name(pair // wide - 1), self.name(pair % wide)
            ok = self.fits[pair] = self.merged(x + y) == ([x, y] if x else [y])
        return ok

    def edges(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(starts, places in self.sorted) of every occurrence of every piece, by start, then length."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        order = suffix_array(codes, self.width)
        padded = np.concatenate([codes, np.zeros(self.width, np.uint32)])
        suffix = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, self.width)[order]).view(f"U{self.width}").ravel()
        low, high = np.searchsorted(suffix, self.sorted), np.searchsorted(suffix, self.ends)
        count = high - low
        which = np.repeat(np.arange(len(count)), count)
        first = np.repeat(low - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
        start = order[first + np.arange(len(which))]
        by = np.lexsort((self.sizes[which], start))
        return start[by], which[by]

    def learn(self, stretches: list[str]) -> None:
        """Encodes distinct stretches, put together with a character between that is in no piece."""
        if len(self.fits) > 4 * REMEMBERED:
            self.fits.clear()
        k = 0
        while k < len(stretches):
            took, size = [], 0
            while k < len(stretches) and (not took or size < INDEXED):
                took.append(stretches[k])
                size += len(stretches[k]) + 1
                k += 1
            self.known.update(zip(took, self.relaxed(took), strict=True))

    def relaxed(self, took: list[str]) -> list[bytes]:
        """Edges of all stretches at once, relaxed position by position; last holds the piece that ends at a place."""
        text = "\0".join(took) + "\0"
        start, piece = self.edges(text)
        size = self.sizes[piece]
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.array([len(s) for s in took], np.int64)
        base = np.cumsum(lengths + 1) - lengths - 1
        alone = np.ones(len(codes), bool)  # characters that are no piece stand for themselves
        alone[start[size == 1]] = False
        alone[base + lengths] = False
        lone = np.nonzero(alone)[0]
        count = len(self.sorted)
        start, piece, size = np.concatenate([start, lone]), np.concatenate([piece, count + codes[lone].astype(np.int64)]), np.concatenate([size, np.ones(len(lone), np.int64)])
        level = start - base[np.searchsorted(base, start, side="right") - 1]
        order = np.argsort(level, kind="stable")
        cuts = np.searchsorted(level[order], np.arange(lengths.max() + 1))
        last = np.full(len(codes) + 1, -2, np.int64)
        last[base] = -1
        wide = count + 0x110000
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            e = order[a:b]
            before = last[start[e]]
            e, before = e[before > -2], before[before > -2]
            pairs, which = np.unique((before + 1) * wide + piece[e], return_inverse=True)
            ok = np.array([self.may_follow(x, wide) for x in pairs.tolist()], bool)[which]
            last[start[e][ok] + size[e][ok]] = piece[e][ok]
        # back from the ends
        at, own, steps = base + lengths, np.arange(len(took)), []
        while len(own):
            p = last[at]
            steps.append((own, p))
            at = at - np.where(p < count, self.sizes[np.minimum(p, count - 1)], 1)
            more = at > base[own]
            own, at = own[more], at[more]
        owner, found = np.concatenate([o for o, _ in steps]), np.concatenate([p for _, p in steps])
        by = np.lexsort((-np.repeat(np.arange(len(steps)), [len(o) for o, _ in steps]), owner))
        owner, found = owner[by], found[by]
        odd = set(owner[found >= count].tolist())
        ids = self.ids[np.minimum(found, count - 1)].astype("<i4").tobytes()
        ends = np.searchsorted(owner, np.arange(len(took) + 1)).tolist()
        return [
            ids[4 * a : 4 * b] if k not in odd else np.array([t for x in found[a:b].tolist() for t in self.ids_of(x)], "<i4").tobytes()
            for k, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True))
        ]

    def relaxed_long(self, text: str) -> bytes:
        """One long stretch, position by position from window to window."""
        count, wide, n = len(self.sorted), len(self.sorted) + 0x110000, len(text)
        last = array("i", [-2]) * (n + 1)  # the piece that ends at each place
        last[0] = -1
        fits, sizes = self.fits, self.sizes.tolist()
        for base in range(0, n, WINDOW):
            starts, pieces = self.edges(text[base : base + WINDOW + self.width])
            inside = int(np.searchsorted(starts, min(WINDOW, n - base)))
            alone = np.ones(min(WINDOW, n - base), bool)
            starts, pieces = starts[:inside], pieces[:inside]
            alone[starts[self.sizes[pieces] == 1]] = False
            lone = np.nonzero(alone)[0]
            codes = np.array([count + ord(text[base + k]) for k in lone.tolist()], np.int64)
            by = np.argsort(np.concatenate([starts, lone]), kind="stable")
            for s, p in zip((np.concatenate([starts, lone])[by] + base).tolist(), np.concatenate([pieces, codes])[by].tolist(), strict=True):
                before = last[s]
                if before == -2:
                    continue
                pair = (before + 1) * wide + p
                ok = fits.get(pair)
                if ok is None:
                    ok = self.may_follow(pair, wide)
                if ok:
                    last[s + (sizes[p] if p < count else 1)] = p
            if len(fits) > 4 * REMEMBERED:
                fits.clear()
        out, at = [], n
        while at:
            p = last[at]
            out.append(p)
            at -= sizes[p] if p < count else 1
        ids = self.ids.tolist()
        return np.array([t for p in reversed(out) for t in ([ids[p]] if p < count else self.ids_of(p))], "<i4").tobytes()

    def name(self, piece: int) -> str:
        return "" if piece < 0 else self.names[piece] if piece < len(self.names) else chr(piece - len(self.names))

    def ids_of(self, piece: int) -> list[int]:
        if piece < len(self.names):
            return [self.id_of[self.names[piece]]]
        return [self.byte[bytes([x])] for x in self.name(piece).encode("utf-8", "surrogatepass")] if self.byte else [self.unknown]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian 32-bit integers."""
        cut = [self.cut.findall((MARK if self.model.dummy_prefix else "") + t.replace(" ", MARK)) if t else [] for t in texts]
        if len(self.known) > REMEMBERED:  # what is still used moves over from the generation before
            self.known, self.before = {}, self.known
        new = set().union(*cut).difference(self.known)
        long = {x for x in new if len(x) > LONG}
        old = new.intersection(self.before)
        self.known.update((x, self.before[x]) for x in old)
        self.learn(sorted(new - old - long))
        get = self.known.__getitem__
        if not long:
            return [b"".join(map(get, x)) for x in cut]
        once = {x: self.relaxed_long(x) for x in long}
        return [b"".join(once[p] if p in once else get(p) for p in x) for x in cut]

    def decode(self, ids: list[int]) -> str:
        """The text of ids without the space that encoding put before it; bytes that are no UTF-8 become U+FFFD."""
        text = b"".join(map(self.bytes_of.__getitem__, ids))
        return (text[1:] if self.model.dummy_prefix and text.startswith(b" ") else text).decode("utf-8", "replace")

    def decoder(self) -> list[bytes]:
        """The bytes that each id stands for."""
        kinds = {BYTE: lambda p: bytes([int(p[3:5], 16)]), CONTROL: lambda p: b"", UNKNOWN: lambda p: " ⁇ ".encode()}
        return [kinds.get(t, lambda p: p.replace(MARK, " ").encode())(p) for p, t in zip(self.model.pieces, self.model.types, strict=True)]


_encoders: dict[str, Encoder] = {}


def _encoder(shared) -> Encoder:
    """One encoder for each worker and model."""
    key = shared.value.digest
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(shared.value)
    return _encoders[key]


def encode(docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str | None = None) -> DataFrame:
    """docs with `ids_col`, an array of piece ids, and if asked for with the text that they decode to.

    The model (a vocabulary, bounded by its file) is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load_model(model_path))
    base = docs.drop(ids_col, *([decoded_col] if decoded_col else []))
    k = base.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(shared)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                made = enc.encode([t or "" for t in b.column(k).to_pylist()])
                ends = np.cumsum([0, *(len(x) // 4 for x in made)])
                values = np.frombuffer(b"".join(made), "<i4")
                cols = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))]
                if decoded_col:
                    cols.append(pa.array([enc.decode(np.frombuffer(x, "<i4").tolist()) for x in made], pa.string()))
                yield pa.RecordBatch.from_arrays([*b.columns, *cols], names=[*b.schema.names, ids_col, *([decoded_col] if decoded_col else [])])

    schema = base.withColumn(ids_col, F.array().cast("array<int>"))
    return base.mapInArrow(run, (schema.withColumn(decoded_col, F.lit("").cast("string")) if decoded_col else schema).schema)


def decode(rows: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """rows with `text_col`, the text that the ids stand for."""
    shared = rows.sparkSession.sparkContext.broadcast(load_model(model_path))
    base = rows.drop(text_col)
    k = base.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(shared)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                texts = pa.array([enc.decode(x or []) for x in b.column(k).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*b.columns, texts], names=[*b.schema.names, text_col])

    return base.mapInArrow(run, base.withColumn(text_col, F.lit("").cast("string")).schema)
