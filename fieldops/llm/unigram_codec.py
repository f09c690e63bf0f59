"""SentencePiece unigram encoding and decoding (operator 4).

The pieces of a public model file are put into a double-array trie over UTF-8
bytes.  A text gets the model's white-space marker (U+2581 for each space, and
one in front if the model says so) and is split where a marker follows another
character: as no piece holds a marker after another character (checked when the
model is loaded), the best path of a text is that of its units put together.
The units of a batch that a worker doesn't remember are walked through the trie
all at once, and the Viterbi pass goes over all of them by byte offset.
Characters without a piece fall back to byte pieces.

The public model is a merge model, whose scores are negated ranks; ``zipf``
turns them into log scores of a Zipf law, -log(rank + 1).  A unigram model's own
log scores are used as they are.  Of equally good paths the one with the longer
last piece wins, as in the library.

Cases: null and empty texts have no ids; texts of white space only, unknown
characters and very long units are encoded like any other; decoding gives back
every text but for U+2581 in it, which reads as a space; ids out of range,
control ids and null lists decode to nothing; repeated rows each get a row; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldops.llm.common import documents, row_slices

MARK = "▁"
UNIT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
LINE_UNIT = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")  # where no piece holds a line feed either
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6  # fixed values: kinds of pieces in a model file
UNKNOWN_PENALTY = 10.0  # fixed value: how far an unknown character lies below the lowest score
KEEP_UNITS = 600_000  # units a Python worker remembers (a cache)


def _fields(raw: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a protocol buffer message."""
    def varint(i: int) -> tuple[int, int]:
        n = shift = 0
        while True:
            b = raw[i]
            n, shift, i = n | (b & 127) << shift, shift + 7, i + 1
            if b < 128:
                return n, i
    i = 0
    while i < len(raw):
        key, i = varint(i)
        kind = key & 7
        if kind == 0:
            value, i = varint(i)
        elif kind == 2:
            n, i = varint(i)
            value, i = raw[i:i + n], i + n
        else:
            n = 4 if kind == 5 else 8
            value, i = struct.unpack("<f" if kind == 5 else "<d", raw[i:i + n])[0], i + n
        yield key >> 3, value


@dataclass
class Model:
    pieces: list[bytes]
    scores: np.ndarray
    kinds: list[int]
    prefix: bool
    base: np.ndarray
    check: np.ndarray
    value: np.ndarray
    longest: int
    unknown: float
    splits: bool


def load_model(path: str, zipf: bool | None = None) -> Model:
    """Read a model file; ``zipf`` defaults to whether it is a merge model."""
    pieces, scores, kinds, prefix, merges = [], [], [], True, False
    with open(path, "rb") as f:
        for number, value in _fields(f.read()):
            if number == 1:
                p = dict(_fields(value))
                pieces.append(p.get(1, b""))
                scores.append(p.get(2, 0.0))
                kinds.append(p.get(3, NORMAL))
            elif number == 2:
                merges = dict(_fields(value)).get(3, 1) == 2
            elif number == 3:
                prefix = bool(dict(_fields(value)).get(3, 1))
    if merges if zipf is None else zipf:
        scores = [-math.log1p(max(0.0, -s)) for s in scores]
    return build_model(pieces, np.array(scores, dtype=np.float32).astype(np.float64), kinds, prefix)


def build_model(pieces: list[bytes], scores: np.ndarray, kinds: list[int], prefix: bool = True) -> Model:
    keyed = sorted((p, i) for i, p in enumerate(pieces) if kinds[i] in (NORMAL, USER) and p)
    base, check, value = double_array(keyed)
    splits = not any(MARK in p.decode("utf-8", "replace").lstrip(MARK) for p, _ in keyed)
    low = min((float(scores[i]) for p, i in keyed if kinds[i] == NORMAL), default=0.0)
    return Model(pieces, scores, kinds, prefix, base, check, value, max((len(p) for p, _ in keyed), default=1), low - UNKNOWN_PENALTY, splits)


def double_array(keyed: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base, check, value of a trie over sorted (key, id): from state s the byte
    c leads to t = base[s] + c + 1 if check[t] = s; value[t] is an id or -1."""
    size = 1 << 12
    base, check, value = [0] * size, [-1] * size, [-1] * size
    check[0] = 0
    free = 1
    todo = [(0, 0, len(keyed), 0)]
    while todo:
        state, lo, hi, depth = todo.pop()
        if lo < hi and len(keyed[lo][0]) == depth:
            value[state] = keyed[lo][1]
            while lo < hi and len(keyed[lo][0]) == depth:
                lo += 1
        kids, i = [], lo
        while i < hi:
            c, j = keyed[i][0][depth], i
            while j < hi and keyed[j][0][depth] == c:
                j += 1
            kids.append((c, i, j))
            i = j
        if not kids:
            continue
        while check[free] != -1:
            free += 1
            if free + 600 > len(check):
                base += [0] * len(base)
                check += [-1] * len(check)
                value += [-1] * len(value)
        first, at = kids[0][0] + 1, max(free, kids[0][0] + 1)
        tries = 0
        while True:
            if at + 600 > len(check):
                base += [0] * len(base)
                check += [-1] * len(check)
                value += [-1] * len(value)
            b = at - first
            if check[at] == -1 and all(check[b + c + 1] == -1 for c, _, _ in kids):
                break
            at += 1
            tries += 1
        if tries > 200 and len(kids) > 1:
            free += 1  # crowded: let the front move on
        base[state] = b
        for c, _, _ in kids:
            check[b + c + 1] = state
        todo += [(b + c + 1, i, j, depth + 1) for c, i, j in reversed(kids)]
    n = max(i for i, c in enumerate(check) if c != -1) + 300
    pad = lambda a, x: np.array((a + [x] * n)[:n], dtype=np.int64)
    return pad(base, 0), pad(check, -1), pad(value, -1)


class Codec:
    def __init__(self, model: Model):
        self.m = model
        self.known: dict[str, bytes] = {}
        self.unit = UNIT if any(b"\n" in p for p, k in zip(model.pieces, model.kinds, strict=True) if k in (NORMAL, USER)) else LINE_UNIT
        self.byte_ids = {p: i for i, p in enumerate(model.pieces) if model.kinds[i] == BYTE}
        self.fallback = [self.byte_ids.get(b"<0x%02X>" % b) for b in range(256)]
        self.unknown_id = next((i for i, k in enumerate(model.kinds) if k == UNKNOWN), 0)
        self.plain = [bytes([int(p[3:5], 16)]) if k == BYTE else p if k in (NORMAL, USER) else b"" for p, k in zip(model.pieces, model.kinds, strict=True)]

    def paths(self, units: list[str]) -> list[bytes]:
        """Ids (little-endian 32-bit) of the best path of each unit."""
        m = self.m
        raw = [u.encode("utf-8", "surrogatepass") for u in units]
        sizes = np.array([len(r) for r in raw], dtype=np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]  # a separator after each unit
        text = np.frombuffer(b"\0".join(raw) + bytes(m.longest + 8), dtype=np.uint8).astype(np.int64)
        inside = np.ones(int(sizes.sum()) + len(raw), dtype=bool)
        inside[starts + sizes] = False
        lead = np.flatnonzero(inside & ((text[:len(inside)] & 0xC0) != 0x80))
        within = np.repeat(starts, sizes + 1)
        upto = np.repeat(starts + sizes, sizes + 1)
        width = np.diff(np.append(lead, len(inside)))
        width = np.minimum(width, upto[lead] - lead)  # bytes of the character
        begin, end, piece = [], [], []
        single = np.zeros(len(lead), dtype=bool)
        who, state, depth = np.arange(len(lead)), np.zeros(len(lead), dtype=np.int64), 0
        while len(who):
            pos = lead[who] + depth
            ok = pos < upto[lead[who]]
            who, state, pos = who[ok], state[ok], pos[ok]
            to = m.base[state] + text[pos] + 1
            ok = (to < len(m.check)) & (m.check[np.minimum(to, len(m.check) - 1)] == state)
            who, state, pos = who[ok], to[ok], pos[ok]
            depth += 1
            full = m.value[state] >= 0
            w = who[full]
            begin.append(lead[w])
            end.append(pos[full] + 1)
            piece.append(m.value[state[full]])
            single[w[width[w] == depth]] = True
        lone = np.flatnonzero(~single)
        begin = np.concatenate([*begin, lead[lone]])
        end = np.concatenate([*end, lead[lone] + width[lone]])
        piece = np.concatenate([*piece, np.full(len(lone), -1, dtype=np.int64)])
        score = np.where(piece >= 0, m.scores[piece], m.unknown)
        offset = begin - within[begin] if len(begin) else begin
        order = np.argsort(offset, kind="stable")
        begin, end, piece, score, offset = begin[order], end[order], piece[order], score[order], offset[order]
        best = np.full(len(text), -np.inf)
        best[starts] = 0.0
        back = np.full(len(text), -1, dtype=np.int64)
        edges = np.flatnonzero(np.diff(np.concatenate([[-1], offset, [-2]])))
        for a, b in zip(edges[:-1], edges[1:], strict=True):  # one offset: all ends differ
            e = end[a:b]
            got = best[begin[a:b]] + score[a:b]
            win = got > best[e]
            best[e[win]] = got[win]
            back[e[win]] = np.arange(a, b)[win]
        # Follow all units back at once; a step is one piece further from the end.
        unit, at = np.arange(len(raw)), starts + sizes
        unit, at = unit[sizes > 0], at[sizes > 0]
        units_, pieces_ = [], []
        strange: dict[int, None] = {}
        while len(unit):
            e = back[at]
            p = piece[e]
            if (p < 0).any():
                strange |= dict.fromkeys(unit[p < 0].tolist())
            units_.append(unit)
            pieces_.append(p)
            at = begin[e]
            go = at > starts[unit]
            unit, at = unit[go], at[go]
        if not units_:
            return [b""] * len(raw)
        whose, what = np.concatenate(units_[::-1]), np.concatenate(pieces_[::-1])
        order = np.argsort(whose, kind="stable")
        bounds = (4 * np.searchsorted(whose[order], np.arange(len(raw) + 1))).tolist()
        ids = what[order].astype("<u4").tobytes()
        out = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        for i in strange:  # units with characters that no piece covers
            at, path, r, start = int(starts[i] + sizes[i]), [], raw[i], int(starts[i])
            while at > start:
                e = back[at]
                lo = int(begin[e])
                if piece[e] >= 0:
                    path.append(int(piece[e]))
                else:
                    path += [self.unknown_id if self.fallback[c] is None else self.fallback[c] for c in reversed(r[lo - start:at - start])]
                at = lo
            out[i] = np.array(path[::-1], dtype="<u4").tobytes()
        return out

    def marked(self, text: str) -> str:
        return (MARK if self.m.prefix else "") + text.replace(" ", MARK)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        split = [(self.unit.findall(self.marked(t)) if self.m.splits else [self.marked(t)]) if t else [] for t in texts]
        known = self.known
        if len(known) > KEEP_UNITS:
            known.clear()
        fresh = list({u for units in split for u in units if u not in known})
        fresh.sort(key=len)
        i = 0
        while i < len(fresh):  # some hundred thousand characters at a time
            j, total = i, 0
            while j < len(fresh) and (j == i or total + len(fresh[j]) < 300_000):
                total += len(fresh[j])
                j += 1
            known.update(zip(fresh[i:j], self.paths(fresh[i:j]), strict=True))
            i = j
        return [b"".join(map(known.__getitem__, units)) for units in split]

    def decode(self, ids: list[int] | np.ndarray | None) -> str:
        if ids is None:
            return ""
        plain = self.plain
        text = b"".join([plain[i] for i in ids if 0 <= i < len(plain)]).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if self.m.prefix and text.startswith(" ") else text


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def _encoding(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model)
        for whole in batches:
            for rb in row_slices(whole, "text", 4 << 20):
                ids = codec.encode(rb.column(1).to_pylist())
                lists = [np.frombuffer(x, dtype="<u4").astype(np.int32) for x in ids]
                yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(lists, pa.list_(pa.int32()))], names=["doc_id", "ids"])
    return run


def _decoding(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model)
        for rb in batches:
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.array([codec.decode(x) for x in rb.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])
    return run


def encode(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids) of every row."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(_encoding(model), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: Model) -> DataFrame:
    """(doc_id, text) of every row of (doc_id, ids)."""
    return encoded.select("doc_id", "ids").mapInArrow(_decoding(model), "doc_id long, text string")


def _reporting(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model)
        is_byte = np.array([k == BYTE for k in model.kinds])
        for whole in batches:
            for rb in row_slices(whole, "text", 4 << 20):
                texts = rb.column(1).to_pylist()
                rows = []
                for t, raw in zip(texts, codec.encode(texts), strict=True):
                    ids = np.frombuffer(raw, dtype="<u4")
                    rows.append((len(ids), int(is_byte[ids].sum()), zlib.crc32(raw), round(float(model.scores[ids].sum()), 6),
                                 codec.decode(ids.tolist()) == (t or "").replace(MARK, " ")))
                cols = list(zip(*rows, strict=True)) or [[]] * 5
                types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([rb.column(0), *[pa.array(list(c), t) for c, t in zip(cols, types, strict=True)]],
                                                 names=["doc_id", "n_tokens", "n_bytes", "ids_crc32", "log_score", "round_trip"])
    return run


def op4_unigram_codec(spark, sf_dir: str) -> DataFrame:
    """Per document: number of ids and of byte pieces among them, CRC-32 of the
    ids (little-endian 32-bit), the sum of their scores, and whether decoding
    them gives the text back."""
    model = load_model(default_model())
    return documents(spark, sf_dir).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _reporting(model), "doc_id long, n_tokens long, n_bytes long, ids_crc32 long, log_score double, round_trip boolean")
