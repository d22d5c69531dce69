"""Benchmark decontamination by spaced-seed hashing.

Words (runs of letters, digits and non-ASCII bytes, lower-cased in any script) of the benchmark items are
hashed under a few fixed masks; a mask looks at some word positions of its span and ignores
the others, so a substituted word at an ignored position leaves the hash as it was.  The
hashes of all positions of every training text are joined with those of the items.  A hit
fixes how text and item are aligned; along this diagonal the best-scoring run of words
(match +1, substitution -2) is verified word by word, and the text is contaminated by the
item when the run holds at least ``MIN_MATCH`` equal words (or ``MIN_SHARE`` of a
shorter item) and at least ``MIN_IDENTITY`` of the words in it are equal.

The benchmark is the stated query set: it is split by hash into blocks of about
``BLOCK_BYTES`` of text, each block is broadcast once and joined with all texts in one
narrow pass, without any shuffle of the texts.

Items shorter than the masks are hashed whole: those of 1 to 6 words as they stand (only a verbatim
occurrence counts), those of 7 to 9 words also with each single word left out.

Hits are taken in slices of at most ``HITS`` from the end of the texts on, and the runs of a slice are
verified ``CELLS`` words at a time, so memory does not depend on how often a word is repeated.  Where a
text holds an item whole, what lies before that place is not verified again.

Defined results: null or empty texts and items match nothing; very long texts are searched whole; of runs
that tie the last one in the text is reported; repeated items are each reported; repeated rows are each
reported; empty tables give an empty result, and an empty benchmark drops nothing; other columns are
kept by the stage and not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from tessera.llm.common import WORDLIKE, keyed_texts, mix, pieces, read_table, text_map, words_of
from tessera.operators.sizing import materialise
from tessera.session import ship_package

#: The masks (1: the word counts, 0: it is ignored).
MASKS = ("1111111", "1110110101", "11001010111", "1101100111")
MIN_MATCH, MIN_SHARE, MIN_IDENTITY = 13, 0.8, 0.75
#: Items of fewer words match verbatim only; below the second number each word may be left out.
SHORTEST, SHORT = 7, 10
#: Hits held at once, and words compared at once.
HITS, CELLS = 1 << 19, 1 << 20
#: Text of the benchmark that one block holds, in bytes (about 7 times that in memory).
BLOCK_BYTES = 8 << 20
_TABLE_BITS = 20


def seeds(h: np.ndarray, end: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of a mask over word hashes; ``end`` is the first word behind the
    text of each word."""
    at = np.flatnonzero(np.arange(len(h)) + len(mask) <= end)
    acc = np.full(len(at), int(mask, 2), dtype=np.uint64)      # each mask has hashes of its own
    for j, on in enumerate(mask):
        if on == "1":
            acc = acc * np.uint64(0x9E3779B97F4A7C15) + h[at + j]
    return at, mix(acc)


def whole_masks(words: int) -> list[str]:
    """Masks that span a whole item of so few words."""
    full = "1" * words
    return [full] if words < SHORTEST else [full[:j] + "0" + full[j + 1:] for j in range(words)]


class Index:
    """Seeds of one block of items, sorted by hash."""

    def __init__(self, items: list[tuple[int, bytes]]):
        _, _, _, self.h, first = words_of([t for _, t in items], WORDLIKE)
        self.ids = [i for i, _ in items]
        self.first = first
        length = np.diff(first)
        item = np.repeat(np.arange(len(items)), length)
        found = [(m, *seeds(self.h, first[1:][item], m)) for m in MASKS]
        for n in range(1, SHORT):
            if (length == n).any():
                own = length[item] == n
                for m in whole_masks(n):
                    at, key = seeds(self.h, np.where(own, first[1:][item], 0), m)
                    found.append((m, at, key))
        self.masks = [m for m, at, _ in found if len(at)]
        pos, key = (np.concatenate([f[k] for f in found]) for k in (1, 2))
        order = np.lexsort((pos, key))
        key, self.pos = key[order], pos[order]
        self.item = item[self.pos]
        self.key, self.start = np.unique(key, return_index=True)
        self.start = np.append(self.start, len(pos))
        # positions that do not follow one of the same hash in their item
        follows = np.zeros(len(pos), dtype=bool)
        follows[1:] = (key[1:] == key[:-1]) & (self.pos[1:] == self.pos[:-1] + 1) & (self.item[1:] == self.item[:-1])
        self.head = np.flatnonzero(~follows)
        self.head_start = np.searchsorted(self.head, self.start)
        self.table = np.zeros(1 << _TABLE_BITS, dtype=bool)
        self.table[(self.key >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)] = True

    def matches(self, texts: list[bytes]) -> list[tuple[int, int, int, int, int]]:
        """(text, item, equal words, words of the run, first word of the run): the best
        verified run of each text and item that meet."""
        if not len(self.key):
            return []
        _, _, _, h, first = words_of(texts, WORDLIKE)
        text = np.repeat(np.arange(len(texts)), np.diff(first))
        best: dict[tuple[int, int], tuple] = {}
        found = []
        for m in self.masks:
            at, key = seeds(h, first[1:][text], m)
            # the second of two equal hashes in a row meets only the first ones of the item: the
            # other pairs lie on the diagonals of the hash before
            again = np.zeros(len(at), dtype=bool)
            again[1:] = (key[1:] == key[:-1]) & (at[1:] == at[:-1] + 1) & (text[at[1:]] == text[at[:-1]])
            on = self.table[(key >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)]
            at, key, again = at[on], key[on], again[on]
            i = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            on = self.key[i] == key
            found.append((at[on], i[on], again[on]))
        at, i, again = (np.concatenate([f[k] for f in found]) for k in range(3))
        order = np.argsort(-at, kind="stable")          # from the end on
        at, i, again = at[order], i[order], again[order]
        lo, hi = (np.where(again, self.head_start[i + e], self.start[i + e]) for e in (0, 1))
        total = np.concatenate([[0], np.cumsum(hi - lo)])
        for s in range(0, int(total[-1]), HITS):
            hit = np.arange(s, min(s + HITS, int(total[-1])))
            k = np.searchsorted(total, hit, side="right") - 1
            src = lo[k] + hit - total[k]
            few = again[k]
            src[few] = self.head[src[few]]
            self._verify(h, text, first, at[k], src, best)
        return [(t, item, eq, n, at - int(first[t])) for (t, item), (eq, n, at) in sorted(best.items())]

    def _verify(self, h, text, first, at, src, best) -> None:
        """Keep the best run of each text and item on the diagonals of some hits."""
        item = self.item[src]
        begin = at - (self.pos[src] - self.first[item])
        # (item, text, last diagonal first) as one number
        reach, count = len(h) + len(self.h), len(first)
        code = np.unique((item * count + text[at]) * (2 * reach) + reach - begin)
        code, back = np.divmod(code, 2 * reach)
        of, t = np.divmod(code, count)
        diagonals = np.stack([t, reach - back], axis=1)
        cuts = np.flatnonzero(np.diff(of)) + 1
        for one, rows in zip(of[np.concatenate([[0], cuts])].tolist(), np.split(diagonals, cuts), strict=True):
            a, b = int(self.first[one]), int(self.first[one + 1])
            step = max(1, CELLS // (b - a))
            for s in range(0, len(rows), step):
                part = rows[s:s + step]
                whole = {x: best[x, one][2] for x in np.unique(part[:, 0]).tolist() if best.get((x, one), (0,))[0] == b - a}
                for x, place in whole.items():       # nothing before a whole occurrence is better
                    part = part[(part[:, 0] != x) | (part[:, 1] > place)]
                if len(part):
                    self._runs(h, first, one, a, b, part, best)

    def _runs(self, h, first, item, a, b, part, best) -> None:
        """Best run of each diagonal on which the item's first word lies at ``part``'s second column."""
        t, begin = part[:, 0], part[:, 1]
        at = begin[:, None] + np.arange(b - a)
        inside = (at >= first[t][:, None]) & (at < first[t + 1][:, None])
        equal = inside & (h[np.clip(at, 0, len(h) - 1)] == self.h[None, a:b])
        step = np.where(inside, np.where(equal, 1, -2), 0)
        total = np.concatenate([np.zeros((len(part), 1), np.int64), np.cumsum(step, axis=1)], axis=1)
        stop = (total - np.minimum.accumulate(total, axis=1)).argmax(axis=1)
        # the run starts at the first lowest point before its end
        low = np.where(np.arange(b - a + 1)[None, :] <= stop[:, None], total, np.iinfo(np.int64).max).argmin(axis=1)
        low = np.maximum(low, np.maximum(0, first[t] - begin))
        sums = np.concatenate([np.zeros((len(part), 1), np.int64), np.cumsum(equal, axis=1)], axis=1)
        row = np.arange(len(part))
        same, n = sums[row, stop] - sums[row, low], stop - low
        least = min(MIN_MATCH, int(np.ceil(MIN_SHARE * (b - a)))) if b - a >= SHORTEST else b - a
        ok = np.flatnonzero((n > 0) & (same >= least) & (same >= MIN_IDENTITY * n))
        ok = ok[np.lexsort((begin[ok] + low[ok], n[ok], same[ok], t[ok]))]
        for r in ok[np.append(np.diff(t[ok]) != 0, True)[:len(ok)]].tolist():      # the best of each text
            run = (int(same[r]), int(n[r]), int(begin[r] + low[r]))
            if run > best.get((int(t[r]), item), (0,)):
                best[int(t[r]), item] = run


def blocks(items: DataFrame) -> list[DataFrame]:
    """The benchmark in hash blocks of about BLOCK_BYTES."""
    kept = items.select(F.col("item_id").cast("long").alias("item_id"), F.lower(F.col("text").cast("string")).alias("text")) \
        .where(F.col("text").isNotNull())
    size = kept.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-int(size) // BLOCK_BYTES))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return [kept.where(part == k) for k in range(n)]


def _index(spark: SparkSession, block: DataFrame):
    rows = block.orderBy("item_id", "text").collect()
    ship_package(spark)
    return spark.sparkContext.broadcast(Index([(r[0], r[1].encode("utf-8", "surrogatepass")) for r in rows]))


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, equal_words, run_words, first_word: one row for every pair of a
    document and an item that it holds."""
    spark = docs.sparkSession
    texts = keyed_texts(docs).withColumn("text", F.lower("text"))
    parts = []
    todo = blocks(items)
    for block in todo:
        index = _index(spark, block)

        def run(ids, texts, index=index):
            ix = index.value
            rows = ix.matches(texts)
            return {"doc_id": [ids[r[0]] for r in rows], "item_id": [ix.ids[r[1]] for r in rows],
                    "equal_words": [r[2] for r in rows], "run_words": [r[3] for r in rows],
                    "first_word": [r[4] for r in rows]}

        found = text_map(texts, run, "doc_id long, item_id long, equal_words long, run_words long, first_word long")
        if len(todo) > 1:                  # one block in memory at a time
            found = materialise(found, "contaminated", measure=False).df
            index.unpersist()
        parts.append(found)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def decontaminate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def _clean(index):
    """Column function: whether a text holds no item of the block."""

    @arrow_udf(T.BooleanType())
    def clean(text: pa.Array) -> pa.Array:
        out = []
        for _, texts in pieces([pa.RecordBatch.from_arrays([pa.nulls(len(text)), text], names=["i", "t"])]):
            hit = {r[0] for r in index.value.matches(texts)}
            out += [i not in hit for i in range(len(texts))]
        return pa.array(out, pa.bool_())

    return clean


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark item go; no text is shuffled."""
    todo = blocks(items)
    for block in todo:
        index = _index(docs.sparkSession, block)
        docs = docs.where(_clean(index)(F.lower(F.coalesce(F.col("text").cast("string"), F.lit("")))))
        if len(todo) > 1:                  # one block in memory at a time
            docs = materialise(docs, "decontaminated", measure=False).df
            index.unpersist()
    return docs
