"""Mixture-controlled packing (operator 10).

Documents are tokenised once and staged with their ids.  They are dealt by hash
into packing groups of about ``GROUP_BYTES`` of text, so a group's ids fit one
task whatever the corpus.  Inside a group every source has a queue; each window
of ``WINDOW_SEQUENCES`` sequences is filled by deficit round-robin: every queue
gets its target share of the window's tokens as credit, spends it in whole
tokens, and what it could not spend or had to spend too much stays as its
deficit for the next window.  A group starts with the deficits that all groups
before it leave (target share of their tokens, less the source's own tokens
there), which a distributed prefix sum over (source, group) totals gives.

Target shares are the corpus' own token shares unless ``weights`` says
otherwise; as every token is packed, a source whose queue runs dry hands its
share to the others.  Only a group's last sequence may be part-filled.

Cases: a null or empty text is the end id alone; a null source is a source of
its own; repeated rows are packed each; an empty table gives no piece; very
long documents are cut over as many sequences as they need; extra columns are
ignored.
"""

from __future__ import annotations

import base64
import math
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldops.llm.common import documents, row_slices, staged

SEQUENCE = 2048
WINDOW_SEQUENCES = 1
GROUP_BYTES = 4 << 20
BLOCK = 1024  # groups summed together in the prefix sum
END_ID = 1
#: Every white space character, for RE2.
_W = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: A space between two characters that are not white space always begins a token, and so does a
#: line feed there, which is one by itself; so other texts than these (and empty ones) split there.
MIXED_SPACE = rf"[{_W}][{_W}]|[\t\x0b-\r\x1c-\x1f\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]|\A[{_W}]|[{_W}]\z|\A\z"


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder:
    """Byte-level BPE ids of texts as little-endian unsigned 16-bit bytes (the
    vocabulary has under 65,536 ids).  The rank file is the same vocabulary as
    byte_bpe_50k.json, and a test holds the ids against that file's.  The string of
    an added token is ordinary text, as the tokenizer's own note prescribes."""

    def __init__(self, path: str | None = None):
        import public_tokenizers
        import tiktoken
        with open(path or default_vocabulary(), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes = np.zeros(max(ranks.values()) + 1, np.int64)  # of each id
        for token, n in ranks.items():
            self.bytes[n] = len(token)

    def plain(self, text: str) -> np.ndarray:
        return self.bpe.encode_to_numpy(text, disallowed_special=()).astype("<u2")

    def __call__(self, text: str) -> bytes:
        return self.texts(pa.array([text or ""], pa.string()), 0)[1][:-1].tobytes()

    def _spaced(self, texts: pa.StringArray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Token counts and ids of texts that MIXED_SPACE doesn't match.  With a
        line feed before each text, the units (a word and the space or line feed before it)
        lie one behind the other in the column's bytes, an Arrow array without a copy.  Its
        different units are encoded in one call, in which the ids' bytes show where each
        unit ends, and every unit takes its ids from there.  The line feeds before texts
        become the end ids of the texts before them."""
        whole = pa.compute.binary_join_element_wise(pa.scalar(""), texts, "\n")
        ends = np.frombuffer(whole.buffers()[1], np.int32)[whole.offset:whole.offset + len(whole) + 1]
        data = np.frombuffer(whole.buffers()[2], np.uint8)[:ends[-1]]
        parts = np.flatnonzero((data[ends[0]:] == 0x20) | (data[ends[0]:] == 0x0A)) + ends[0]
        cuts = np.append(parts, ends[-1]).astype(np.int32)
        units = pa.StringArray.from_buffers(len(parts), pa.py_buffer(cuts), pa.py_buffer(data)).dictionary_encode()
        stops = np.frombuffer(units.dictionary.buffers()[1], np.int32)[:len(units.dictionary) + 1]
        flat = self.plain(units.dictionary.buffers()[2].to_pybytes()[:stops[-1]].decode())
        begins = np.searchsorted(np.cumsum(self.bytes[flat]), stops[:-1], side="right")
        sizes = np.diff(np.append(begins, len(flat)))
        codes = units.indices.to_numpy()
        n = sizes[codes]
        upto = np.cumsum(n)
        ids = flat[np.repeat(begins[codes] - (upto - n), n) + np.arange(upto[-1])]
        before = np.append(0, upto)[np.searchsorted(cuts, ends)]
        ids[before[1:-1]] = end
        return np.diff(before), np.append(ids[1:], ids.dtype.type(end))

    def texts(self, texts: pa.StringArray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Token counts and ids, one text behind the other, each with the id ``end`` after it."""
        mixed = pa.compute.match_substring_regex(texts, MIXED_SPACE).to_numpy(zero_copy_only=False)
        counts, ids = np.empty(0, np.int64), np.empty(0, "<u2")
        if not mixed.all():
            counts, ids = self._spaced(texts.filter(pa.array(~mixed)), end)
        if mixed.any():
            places, begins = np.cumsum(~mixed) - ~mixed, np.append(0, np.cumsum(counts))
            pieces = [np.append(self.plain(texts[i].as_py()), np.array(end, "<u2")) if m else ids[begins[j]:begins[j + 1]]
                      for i, (m, j) in enumerate(zip(mixed.tolist(), places.tolist(), strict=True))]
            counts, ids = np.array(list(map(len, pieces)), np.int64), np.concatenate(pieces)
        return counts, ids


def _tokenise(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(path)
        for whole in batches:
            for rb in row_slices(whole, "text"):
                counts, ids = encode.texts(pa.compute.fill_null(rb.column(3), ""), END_ID)
                places = np.concatenate([[0], np.cumsum(2 * counts)]).astype(np.int32)
                held = pa.BinaryArray.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(places), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([rb.column(0), rb.column(1), rb.column(2), pa.array(counts), held], names=["doc_id", "source", "grp", "n", "ids"])
    return run


def tokenised(docs: DataFrame, n_groups: int, vocabulary: str | None = None, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, grp, n, ids): ids of a document with the end id."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"),
        F.pmod(F.xxhash64(F.col(id_col), F.col(text)), F.lit(n_groups)).alias("grp"), F.col(text).alias("text"),
    ).mapInArrow(_tokenise(vocabulary), "doc_id long, source string, grp long, n long, ids binary")


def carried(tokens: DataFrame, weights: Mapping[str, float] | None = None) -> DataFrame:
    """(grp, source, share, carry): a source's target share, and the deficit in
    tokens that the groups before leave to it.  The prefix sums go over blocks
    of groups first, so that none of them orders all groups in one task."""
    totals = tokens.groupBy("grp", "source").agg(F.sum("n").alias("n")).withColumn("blk", F.floor(F.col("grp") / BLOCK))

    def before(t: DataFrame, keys: list[str], out: str) -> DataFrame:
        """Tokens of lower groups, per keys."""
        inner = Window.partitionBy(*keys, "blk").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
        blocks = t.groupBy(*keys, "blk").agg(F.sum("n").alias("bn")).withColumn(
            "earlier", F.coalesce(F.sum("bn").over(Window.partitionBy(*(keys or [F.lit(0)])).orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        x, y = t.withColumn(out, F.coalesce(F.sum("n").over(inner), F.lit(0))).alias("x"), blocks.alias("y")
        on = F.col("x.blk") == F.col("y.blk")
        for k in keys:
            on = on & F.col(f"x.{k}").eqNullSafe(F.col(f"y.{k}"))
        return x.join(y, on).select("x.*", "y.earlier").withColumn(out, F.col(out) + F.col("earlier")).drop("earlier")

    own = before(totals, ["source"], "own").alias("o")
    every = before(totals.groupBy("grp", "blk").agg(F.sum("n").alias("n")), [], "every").alias("e")
    shares = totals.groupBy("source").agg(F.sum("n").cast("double").alias("w"))
    if weights is not None:
        given = F.create_map(*[F.lit(x) for k, v in weights.items() for x in (k, float(v))])
        shares = shares.withColumn("w", F.coalesce(given[F.col("source")], F.lit(0.0)))
    whole = shares.agg(F.greatest(F.sum("w"), F.lit(1e-300)).alias("whole"))
    shares = shares.join(F.broadcast(whole)).select("source", (F.col("w") / F.col("whole")).alias("share")).alias("s")
    return (own.join(every, F.col("o.grp") == F.col("e.grp")).join(shares, F.col("o.source").eqNullSafe(F.col("s.source")))
            .select("o.grp", "o.source", "s.share", (F.col("s.share") * F.col("e.every") - F.col("o.own")).alias("carry")))


def take_turns(lengths: list[int], shares: list[float], carry: list[float], window: int) -> Iterator[list[tuple[int, int]]]:
    """Per window, (queue, tokens) in serving order.  Every window but the last
    is full; a queue is within a token of its credit unless it or others run dry."""
    left = list(lengths)
    deficit = list(carry)
    live = [q for q in range(len(left)) if left[q]]
    turn = 0
    while live:
        room = min(window, sum(left[q] for q in live))
        weight = sum(shares[q] for q in live)
        for q in live:
            deficit[q] += room * (shares[q] / weight if weight > 0 else 1 / len(live))
        order = live[turn % len(live):] + live[:turn % len(live)]
        turn += 1
        taken = dict.fromkeys(order, 0)
        for q in order:
            n = min(room, left[q], max(0, math.floor(deficit[q])))
            taken[q] += n
            room -= n
        for q in sorted(order, key=lambda q: taken[q] - deficit[q]):  # what is left goes to the largest deficits
            if not room:
                break
            n = min(room, left[q] - taken[q], max(1, math.ceil(deficit[q] - taken[q])))
            taken[q] += n
            room -= n
        for q in sorted(order, key=lambda q: taken[q] - deficit[q]):
            n = min(room, left[q] - taken[q])
            taken[q] += n
            room -= n
        for q in order:
            deficit[q] -= taken[q]
            left[q] -= taken[q]
        yield [(q, taken[q]) for q in order if taken[q]]
        live = [q for q in live if left[q]]


PIECES = "doc_id long, source string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _pack_group(sequence: int, window: int):
    def run(key: tuple, docs: pa.Table, carry: pa.Table) -> pa.Table:
        grp = key[0].as_py()
        shares = {s: (x, c) for s, x, c in zip(*(carry.column(i).to_pylist() for i in ("source", "share", "carry")), strict=True)}
        ids, names = docs.column("doc_id").to_pylist(), docs.column("source").to_pylist()
        raw = docs.column("ids").to_pylist()
        order = sorted(range(len(ids)), key=lambda i: ((ids[i] is None, ids[i] or 0), zlib.crc32(raw[i])))
        queues: dict[str | None, list[int]] = {}
        for i in order:
            queues.setdefault(names[i], []).append(i)
        keys = sorted(queues, key=lambda s: (s is None, s or ""))
        lengths = [sum(len(raw[i]) // 2 for i in queues[s]) for s in keys]
        at = [[0, 0] for _ in keys]  # document in the queue, token in the document
        out: list[tuple] = []
        place = 0
        held, wide = None, b""
        for turn in take_turns(lengths, [shares[s][0] for s in keys], [shares[s][1] for s in keys], window):
            for q, n in turn:
                while n:
                    i = queues[keys[q]][at[q][0]]
                    size, start = len(raw[i]) // 2, at[q][1]
                    step = min(n, size - start, sequence - place % sequence)
                    if held != i:
                        held, wide = i, memoryview(np.frombuffer(raw[i], dtype="<u2").astype("<u4").tobytes())
                    out.append((ids[i], names[i], start, step, zlib.crc32(wide[4 * start:4 * (start + step)]), size, (grp << 24) + place // sequence, place % sequence))
                    place, n = place + step, n - step
                    at[q] = [at[q][0] + 1, 0] if start + step == size else [at[q][0], start + step]
        kinds = [pa.int64(), pa.string()] + [pa.int64()] * 6
        return pa.table([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)],
                        names=[x.split()[0] for x in PIECES.split(", ")])
    return run


def pack(docs: DataFrame, weights: Mapping[str, float] | None = None, vocabulary: str | None = None, sequence: int = SEQUENCE,
         group_bytes: int = GROUP_BYTES, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per piece (see ``PIECES``).  A sequence id is the group's number
    times 2^24 plus the sequence's number there."""
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    groups = max(1, math.ceil(size / group_bytes))
    tokens = staged(tokenised(docs, groups, vocabulary, id_col, text, source), "packing-ids")
    carry = staged(carried(tokens.select("grp", "source", "n"), weights), "packing-carry")
    return tokens.groupBy("grp").cogroup(carry.groupBy("grp")).applyInArrow(_pack_group(sequence, sequence * WINDOW_SEQUENCES), PIECES)


def op10_mixture_packing(spark, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))


