"""Removal of repeated passages with run-length Burrows-Wheeler indexes.

A byte goes when it lies in a string of ``LENGTH`` bytes that also starts earlier in the
corpus (smaller doc_id, or the same document and an earlier start).  Steps:

1. every window of LENGTH bytes is named by its anchor, the K-byte string in it of least
   hash; strings that are very frequent in the corpus (a Misra-Gries summary over all
   documents) come last in that order, so common lines do not become anchors.  Consecutive
   windows with one anchor form a segment (on average K + 77 bytes).  Equal windows have equal
   anchors, so only segments with equal anchors can hold repeats;
2. anchors met once are dropped.  Equal segments collapse into their first occurrence (first
   within a task, so hot passages are small before the shuffle), the others are repeats as
   a whole;
3. the distinct segments of an anchor that has several are brought together, and those that
   agree with no other one next to the anchor are left out.  Many anchors at a time, their
   segments are concatenated in corpus order and indexed: suffix order,
   Burrows-Wheeler transform, its runs, and text positions sampled at the run ends.  Only runs and
   samples are kept; the segments are then streamed backwards through the index, all
   at once, which gives for every position its row and with it its matching statistic, cut at
   LENGTH: rows whose neighbours agree on LENGTH bytes form a long match, and all of its positions
   but the earliest are repeats;
4. an anchor with more than ``HOT`` distinct segments is not put in one task: its windows are
   compared by two 64-bit hashes through a grouping that combines before the shuffle;
5. the spans of a document are joined with its text, merged and cut out.

Defined results: a null or empty text has no bytes and no spans; a row without doc_id is
returned with nothing removed and removes nothing; rows that repeat a doc_id with the same
text are one document and get the same result (with different texts, spans of either are cut out
of both); other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import BASES, PIECE_BYTES, groups_of, keyed_texts, mix, pieces, range_hashes, read_table
from tessera.operators.sizing import materialise
from tessera.session import ship_package

LENGTH, K = 100, 24
#: K-byte strings that come last in the order: at most so many.
FREQUENT = 50_000
#: Only strings whose hash is in the lowest part of the range are counted: nearly every
#: window has several of them, so the others are hardly ever anchors.
LOW = np.uint64(1 << 60)
#: Distinct segments of an anchor that one index holds; bytes of an index.
HOT, INDEX_BYTES = 4096, 1 << 19
#: Segments among which a task looks for equal ones before the shuffle.
CHUNK_SEGMENTS = 400_000
#: Bits of a segment's size and of its anchor's offset.
BITS = 10
_POS = np.uint64((1 << 20) - 1)


def slices(texts: list[bytes], length: int):
    """Batches of (text, offset, bytes) of about PIECE_BYTES; longer texts are cut into slices
    that overlap by length - 1 bytes, so each window lies in exactly one slice."""
    batch, size = [], 0
    for i, t in enumerate(texts):
        for at in range(0, max(len(t) - length + 1, 0), PIECE_BYTES):
            part = t[at:at + PIECE_BYTES + length - 1]
            batch.append((i, at, part))
            size += len(part)
            if size >= PIECE_BYTES:
                yield batch
                batch, size = [], 0
    if batch:
        yield batch


def _strings(batch, k):
    """(bytes, start of each slice, hash of the K-byte string at each position)."""
    buf = np.frombuffer(b"".join(p for _, _, p in batch), dtype=np.uint8)
    begin = np.zeros(len(batch) + 1, dtype=np.int64)
    np.cumsum([len(p) for _, _, p in batch], out=begin[1:])
    at = np.arange(max(len(buf) - k + 1, 0))
    return buf, begin, range_hashes(buf, at, at + k)


def segments(texts: list[bytes], frequent: np.ndarray, length: int = LENGTH, k: int = K):
    """(anchor hash, segment hash, text, start, bytes, anchor's offset in it) of all segments."""
    out = [[] for _ in range(6)]
    w = length - k + 1
    for batch in slices(texts, length):
        buf, begin, h = _strings(batch, k)
        rank = h >> np.uint64(1)
        low = np.flatnonzero(h < LOW)
        rank[low[np.isin(h[low], frequent)]] |= np.uint64(1 << 63)
        m = (rank & ~_POS) | (np.arange(len(h), dtype=np.uint64) & _POS)
        span = 1
        while 2 * span <= w:
            m = np.minimum(m[:-span], m[span:])
            span *= 2
        if span < w:
            m = np.minimum(m[:len(m) - (w - span)], m[w - span:])
        start = np.arange(len(m))
        anchor = start + ((m.astype(np.int64) - start) & int(_POS))
        n = np.diff(begin)
        piece = np.repeat(np.arange(len(batch)), n)[:len(m)]
        whole = start + length <= begin[1:][piece]
        first = whole.copy()
        first[1:] &= (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1])
        last = whole.copy()
        last[:-1] &= first[1:] | ~whole[1:]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + length
        who = piece[s]
        out[0].append(h[anchor[s]])
        out[1].append(range_hashes(buf, s, e, BASES[1]))
        out[2].append(np.array([b[0] for b in batch])[who])
        out[3].append(s - begin[who] + np.array([b[1] for b in batch])[who])
        out[4].append(e - s)
        out[5].append(anchor[s] - s)
    return [np.concatenate(o) if o else np.zeros(0, np.int64) for o in out]


def frequent_strings(texts: DataFrame, k: int = K, length: int = LENGTH, limit: int = FREQUENT) -> np.ndarray:
    """Hashes of very frequent K-byte strings of the whole corpus (at most ``limit``)."""
    ship_package(texts.sparkSession)

    def merge(parts):
        keys, inv = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        counts = np.bincount(inv, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)
        if len(keys) > limit:                        # Misra-Gries: all counters go down together
            cut = np.partition(counts, len(counts) - limit - 1)[len(counts) - limit - 1]
            keys, counts = keys[counts > cut], counts[counts > cut] - cut
        return keys, counts

    def run(batches):
        have, waiting, size = (np.zeros(0, np.uint64), np.zeros(0, np.int64)), [], 0

        def fold():
            keys, counts = np.unique(np.concatenate(waiting), return_counts=True)
            return merge([have, (keys[counts > 2], counts[counts > 2])])

        for _, part in pieces(batches):
            for batch in slices(part, length):
                h = _strings(batch, k)[2]
                waiting.append(h[h < LOW])
                size += len(waiting[-1])
                if size > 40 * limit:
                    have, waiting, size = fold(), [], 0
        if waiting:
            have = fold()
        yield pa.RecordBatch.from_arrays([pa.array(have[0].view(np.int64)), pa.array(have[1])], names=["g", "n"])

    top = (texts.mapInArrow(run, "g long, n long").groupBy("g").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "g").limit(limit).collect())
    return np.array([r[0] for r in top], dtype=np.int64).view(np.uint64)


# ---------------------------------------------------------------- the index

class RunIndex:
    """Run-length Burrows-Wheeler index of the concatenation of ``parts``, each ended by a
    terminator of its own (smaller than any byte, in the order of the parts)."""

    def __init__(self, parts: list[bytes], length: int):
        self.sizes = np.array([len(p) for p in parts], dtype=np.int64)
        self.ends = np.cumsum(self.sizes + 1) - 1                   # positions of the terminators
        text = np.frombuffer(b"\0".join(parts) + b"\0", dtype=np.uint8).astype(np.int64) + 1
        text[self.ends] = 0
        n = len(text)
        owner = np.repeat(np.arange(len(parts)), self.sizes + 1)
        left = self.ends[owner] - np.arange(n)                      # bytes before the terminator
        rank, depth = self._start(text, owner, left), 6
        agree = None
        while depth < length:
            if 2 * depth >= length and agree is None:
                agree = (rank, depth)
            rank = self._double(rank, depth)
            depth *= 2
        r, d = agree if agree else (rank, depth)
        while rank.max() < n - 1:
            rank = self._double(rank, depth)
            depth *= 2
        suffixes = np.empty(n, dtype=np.int64)
        suffixes[rank] = np.arange(n)
        # rows that agree with the row before on ``length`` bytes (terminators differ)
        shift = length - d
        deep = np.concatenate([r[shift:], np.full(shift, -1)]) if shift > 0 else r
        a, b = suffixes[:-1], suffixes[1:]
        self.match = np.zeros(n, dtype=np.int64)
        alike = (r[a] == r[b]) & (deep[a] == deep[b]) & (left[a] >= length) & (left[b] >= length)
        self.match[1:] = np.cumsum(~alike)                          # number of the long match of a row
        # the transform and its runs
        before = text[suffixes - 1]
        starts = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]]))
        symbol = before[starts]
        width = np.diff(np.append(starts, n))
        order = np.argsort(symbol, kind="stable")
        target = np.empty(len(starts), dtype=np.int64)
        target[order] = np.cumsum(width[order]) - width[order]
        self.starts, self.target = starts, target
        self.sampled = starts + width - 1                           # run ends
        self.sample = suffixes[self.sampled]

    @staticmethod
    def _start(text, owner, left):
        """Ranks by the first six bytes; what runs into a terminator is told apart by it."""
        n = len(text)
        key = np.zeros(n, dtype=np.int64)
        for j in range(6):
            c = np.zeros(n, dtype=np.int64)
            c[:n - j] = text[j:]
            key = key * 257 + np.where(left >= j, c, 0)
        if owner[-1] + 2 < (1 << 63) // 257 ** 6:
            return RunIndex._dense(key * (owner[-1] + 2) + np.where(left < 6, owner + 1, 0))
        return RunIndex._dense(RunIndex._dense(key) * (owner[-1] + 2) + np.where(left < 6, owner + 1, 0))

    @staticmethod
    def _dense(key):
        """Dense ranks of the keys."""
        order = np.argsort(key)
        new = np.ones(len(key), dtype=np.int64)
        new[1:] = key[order[1:]] != key[order[:-1]]
        out = np.empty(len(key), dtype=np.int64)
        out[order] = np.cumsum(new) - 1
        return out

    @staticmethod
    def _double(rank, depth):
        n = len(rank)
        second = np.zeros(n, dtype=np.int64)
        if depth < n:
            second[:n - depth] = rank[depth:]
        return RunIndex._dense(rank * (n + 1) + second)

    def step(self, row: np.ndarray) -> np.ndarray:
        """Rows of the positions one to the left."""
        run = np.searchsorted(self.starts, row, side="right") - 1
        return self.target[run] + row - self.starts[run]

    def stream(self) -> np.ndarray:
        """Row of every position, found by walking all parts backwards through the runs."""
        rows = np.empty(int(self.ends[-1]) + 1, dtype=np.int64)
        row, end, left = np.arange(len(self.ends)), self.ends.copy(), self.sizes.copy()
        rows[end] = row                                             # terminators have the first rows
        while len(row):
            on = left > 0
            row, end, left = self.step(row[on]), end[on] - 1, left[on] - 1
            rows[end] = row
        if not np.array_equal(rows[self.sample], self.sampled):
            raise AssertionError("the walk through the index missed a sampled run end")
        return rows

    def repeats(self) -> np.ndarray:
        """Positions whose next ``length`` bytes also start earlier in the text."""
        rows = self.stream()
        match = self.match[rows]
        earliest = np.full(int(self.match[-1]) + 1, len(rows), dtype=np.int64)
        np.minimum.at(earliest, match, np.arange(len(rows)))
        return np.flatnonzero(earliest[match] < np.arange(len(rows)))


def repeated_spans(rows: list[tuple[int, int, bytes]], length: int) -> list[tuple[int, int, int]]:
    """(doc_id, start, end) of what repeats an earlier window among (doc_id, start, bytes)
    rows, which are in corpus order."""
    index = RunIndex([r[2] for r in rows], length)
    at = index.repeats()
    if not len(at):
        return []
    first = np.append(0, index.ends[:-1] + 1)
    part = np.searchsorted(index.ends, at)
    cut = np.ones(len(at), dtype=bool)
    cut[1:] = (at[1:] != at[:-1] + 1) | (part[1:] != part[:-1])
    lo = np.flatnonzero(cut)
    hi = np.append(lo[1:], len(at)) - 1
    return [(rows[p][0], rows[p][1] + int(s - first[p]), rows[p][1] + int(e - first[p]) + length)
            for p, s, e in zip(part[lo].tolist(), at[lo].tolist(), at[hi].tolist(), strict=True)]


def paired(rows: set[tuple[int, int, bytes, int]], length: int, k: int) -> list[tuple[int, int, bytes]]:
    """(doc_id, start, bytes) of the distinct segments of an anchor that may share a window with
    another one: a window holds the anchor and at least half of its other bytes on one side,
    so two segments that share one agree on that many bytes left or right of the anchor."""
    half = -(-(length - k) // 2)
    sides = [(p[off - half:off] if off >= half else None, p[off + k:off + k + half] if len(p) >= off + k + half else None)
             for _, _, p, off in rows]
    left, right = Counter(s[0] for s in sides), Counter(s[1] for s in sides)
    return [(doc, start, p) for (doc, start, p, _), (a, b) in zip(rows, sides, strict=True)
            if (a is not None and left[a] > 1) or (b is not None and right[b] > 1)]


# ---------------------------------------------------------------- Spark

def cut_segments(texts: DataFrame, frequent, length: int, k: int) -> DataFrame:
    """(h, g, doc_id, at): the segments of all texts.

    ``at`` holds start, offset of the anchor and bytes in one number (a segment is shorter than
    2 * length, which BITS bits hold).  Equal
    segments within one chunk of a task keep their first occurrence only; the others are repeats
    for sure and pass with a negative ``at`` under a key of their own, so a passage copied a
    million times sends one row per chunk to its anchor."""

    def run(batches):
        waiting, size = [], 0

        def flush():
            h, g, doc, at = (np.concatenate([w[j] for w in waiting]) for j in range(4))
            order = np.argsort(h)
            twin = h[order][1:] == h[order][:-1]
            tied = np.append(twin, False) | np.append(False, twin)
            alone, tied = order[~tied], order[tied]
            tied = tied[np.lexsort((at[tied], doc[tied], g[tied], h[tied]))]
            h, g, doc, at = (np.concatenate([x[tied], x[alone]]) for x in (h, g, doc, at))
            once = np.ones(len(h), dtype=bool)               # a repeated row is the same document
            once[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1]) | (doc[1:] != doc[:-1]) | (at[1:] != at[:-1])
            h, g, doc, at = h[once], g[once], doc[once], at[once]
            again = np.zeros(len(h), dtype=bool)
            again[1:] = (h[1:] == h[:-1]) & (g[1:] == g[:-1])
            h[again] = mix(doc[again].view(np.uint64) + at[again].view(np.uint64))
            g[again] = 0
            at[again] *= -1
            for lo in range(0, len(h), 1 << 16):
                part = slice(lo, lo + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(h[part].view(np.int64)), pa.array(g[part].view(np.int64)),
                                                  pa.array(doc[part]), pa.array(at[part])], names=["h", "g", "doc_id", "at"])

        for ids, part in pieces(batches):
            h, g, text, start, n, off = segments(part, frequent.value, length, k)
            if len(h):
                waiting.append((h, g, np.array(ids, dtype=np.int64)[text], (start.astype(np.int64) << 2 * BITS) | (off << BITS) | n))
                size += len(h)
            if size > CHUNK_SEGMENTS:
                yield from flush()
                waiting, size = [], 0
        if waiting:
            yield from flush()

    return texts.mapInArrow(run, "h long, g long, doc_id long, at long")


def sort_out(cut: DataFrame) -> DataFrame:
    """(h, doc_id, at): a null h marks a whole segment that repeats an earlier one; the others
    are the first occurrences of the distinct segments of anchors that have several.  Anchors met
    once are gone.  The sorted rows are streamed; a task remembers two rows."""

    def run(batches):
        last, open_row = None, None             # the last row; the first occurrence not decided yet
        for b in batches:
            h, g, doc, at = (b.column(j).to_numpy() for j in range(4))
            whole = at < 0
            marks = [(doc[whole], -at[whole])]
            h, g, doc, at = h[~whole], g[~whole], doc[~whole], at[~whole]
            if len(h):
                same = np.append(last is not None and last[:2] == (h[0], g[0]), (h[1:] == h[:-1]) & (g[1:] == g[:-1]))
                here = np.append(last is not None and last[2:] == (doc[0], at[0]), (doc[1:] == doc[:-1]) & (at[1:] == at[:-1]))
                last = (h[-1], g[-1], doc[-1], at[-1])
                marks.append((doc[same & ~here], at[same & ~here]))
                h, doc, at = h[~same], doc[~same], at[~same]
                if open_row is not None:
                    h, doc, at = (np.append(x, y) for x, y in zip(open_row[:3], (h, doc, at), strict=True))
                    known = open_row[3]
                else:
                    known = False
                if len(h):
                    twin = h[1:] == h[:-1]
                    several = np.append(twin, False) | np.append(known, twin)
                    open_row = (h[-1:], doc[-1:], at[-1:], bool(several[-1]))
                    yield _found(h[:-1][several[:-1]], doc[:-1][several[:-1]], at[:-1][several[:-1]])
            doc, at = (np.concatenate([m[j] for m in marks]) for j in range(2))
            yield _found(None, doc, at)
        if open_row is not None and open_row[3]:
            yield _found(*open_row[:3])

    return (cut.repartition("h").sortWithinPartitions("h", "g", "doc_id", "at")
            .mapInArrow(run, "h long, doc_id long, at long"))


def _found(h, doc, at) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.nulls(len(doc), pa.int64()) if h is None else pa.array(h), pa.array(doc), pa.array(at)],
                                      names=["h", "doc_id", "at"])


def marks(texts: DataFrame, length: int = LENGTH, k: int = K, hot: int = HOT) -> DataFrame:
    """(doc_id, start, stop): byte ranges to remove; they may overlap."""
    spark = texts.sparkSession
    frequent = spark.sparkContext.broadcast(frequent_strings(texts, k, length))    # at most FREQUENT numbers
    found = materialise(sort_out(cut_segments(texts, frequent, length, k)), "segments", measure=False).df
    start, stop = F.shiftright("at", 2 * BITS), F.shiftright("at", 2 * BITS) + F.col("at").bitwiseAND((1 << BITS) - 1)
    whole = found.where(F.col("h").isNull()).select("doc_id", start.alias("start"), stop.alias("stop"))
    firsts = found.where(F.col("h").isNotNull())
    kinds = firsts.groupBy("h").agg(F.count(F.lit(1)).alias("kinds"))
    wanted = (firsts.join(kinds, "h").select("doc_id", F.struct("h", "at", "kinds").alias("w"))
              .groupBy("doc_id").agg(F.collect_list("w").alias("wanted")))

    def fetch(batches):
        for b in batches:
            out = {"h": [], "doc_id": [], "start": [], "off": [], "part": [], "kinds": []}
            low = (1 << BITS) - 1
            for r in b.to_pylist():
                data = r["text"].encode("utf-8", "surrogatepass")
                for w in r["wanted"]:
                    s, off, n = w["at"] >> 2 * BITS, (w["at"] >> BITS) & low, w["at"] & low
                    part = data[s:s + n]
                    if len(part) == n:
                        for name, v in (("h", w["h"]), ("doc_id", r["doc_id"]), ("start", s), ("off", off), ("part", part), ("kinds", w["kinds"])):
                            out[name].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
                [("h", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("off", pa.int32()), ("part", pa.binary()),
                 ("kinds", pa.int64())]))

    parts = texts.join(wanted, "doc_id").mapInArrow(
        fetch, "h long, doc_id long, start long, off int, part binary, kinds long")
    any_hot = not kinds.where(F.col("kinds") > hot).isEmpty()
    if any_hot:                                     # then the bytes are read twice
        parts = materialise(parts, "segment-bytes", measure=False).df

    def index(batches):
        waiting, size = [], 0

        def solve():
            found = repeated_spans(sorted(waiting), length)
            return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in range(3)],
                                              names=["doc_id", "start", "stop"])

        for t in groups_of(batches, ["h"]):
            own = paired(set(zip(*[t.column(c).to_pylist() for c in ("doc_id", "start", "part", "off")], strict=True)), length, k)
            if waiting and size + sum(len(r[2]) for r in own) > INDEX_BYTES:
                yield solve()
                waiting, size = [], 0
            waiting += own
            size += sum(len(r[2]) for r in own)
        if waiting:
            yield solve()

    span = "doc_id long, start long, stop long"
    by_index = (parts.where(F.col("kinds") <= hot).select("h", "doc_id", "start", "off", "part")
                .repartition("h").sortWithinPartitions("h").mapInArrow(index, span))

    if not any_hot:
        return whole.unionByName(by_index)

    def windows(batches):
        for b in batches:
            data = b.column("part").to_pylist()
            if not data:
                continue
            buf = np.frombuffer(b"".join(data), dtype=np.uint8)
            size = np.array([len(p) for p in data])
            count = size - length + 1
            part = np.repeat(np.arange(len(data)), count)
            inside = np.arange(len(part)) - np.repeat(np.cumsum(count) - count, count)
            at = (np.cumsum(size) - size)[part] + inside
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(range_hashes(buf, at, at + length, base).view(np.int64)) for base in BASES),
                 pa.array(b.column("doc_id").to_numpy()[part]), pa.array(b.column("start").to_numpy()[part] + inside)],
                names=["x", "y", "doc_id", "start"])

    single = parts.where(F.col("kinds") > hot).mapInArrow(windows, "x long, y long, doc_id long, start long")
    lead = (single.groupBy("x", "y").agg(F.min(F.struct("doc_id", "start")).alias("first"), F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1).drop("n"))
    by_window = (single.join(lead, ["x", "y"]).where(F.struct("doc_id", "start") != F.col("first"))
                 .select("doc_id", "start", (F.col("start") + length).alias("stop")))
    return whole.unionByName(by_index).unionByName(by_window)


def remove_repeats(docs: DataFrame, length: int = LENGTH, with_bytes: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and kept (the remaining bytes; null
    unless ``with_bytes``)."""
    texts = keyed_texts(docs)
    known = texts.where(F.col("doc_id").isNotNull())
    spans = marks(known, length).groupBy("doc_id").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    none = F.lit(None).cast("array<struct<start:bigint,stop:bigint>>")
    joined = known.join(spans, "doc_id", "left").unionByName(
        texts.where(F.col("doc_id").isNull()).withColumn("spans", none))
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                        ("kept_sha256", pa.string()), ("kept", pa.binary())])

    def run(batches):
        for b in batches:
            cols = {f.name: [] for f in schema}
            for r in b.to_pylist():
                data = r["text"].encode("utf-8", "surrogatepass")
                keep, at, runs, gone = [], 0, 0, 0
                end = -1
                for s, e in sorted((x["start"], min(x["stop"], len(data))) for x in r["spans"] or []):
                    if e <= s:
                        continue
                    if s > end:
                        runs += 1
                        keep.append(data[at:s])
                        gone += e - s
                        end = at = e
                    elif e > end:
                        gone += e - end
                        end = at = e
                keep.append(data[at:])
                kept = b"".join(keep)
                for name, v in (("doc_id", r["doc_id"]), ("n_bytes", len(data)), ("n_removed", gone), ("n_spans", runs),
                                ("kept_sha256", hashlib.sha256(kept).hexdigest()), ("kept", kept if with_bytes else None)):
                    cols[name].append(v)
            yield pa.RecordBatch.from_pydict(cols, schema=schema)

    return joined.select("doc_id", "text", "spans").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def repeats_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents"), with_bytes=False).drop("kept")
