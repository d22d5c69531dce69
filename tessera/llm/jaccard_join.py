"""N-gram Jaccard self-join: a size-aware heavy-light join on word shingles.

A document's set holds the hashes of its distinct ``GRAM``-word shingles.  Two sets link
when 100 * intersection >= ``PERCENT`` * union.  Steps:

1. equal sets collapse into one class, whose smallest doc_id stands for it;
2. every set is put in one global order (shingles met most often last, the rest by hash).
   A set of n shingles that links with any other shares at least ceil(t n) shingles with it,
   so two linking sets share k shingles among their first n - ceil(t n) + k;
3. small sets (light) enumerate the K-element subsets (K = 2) of those first shingles and
   meet on equal subsets; large sets (heavy) scan the inverted lists of single shingles.
   The boundary between them is the size with the least estimated cost, worked out from the
   histogram of set sizes; sets just below it post to the lists too, so that pairs across
   the boundary meet there;
4. all sets of a list (or of a subset) form a group named by its smallest doc_id.  A group is
   cut into blocks of about ``BLOCK`` documents and every pair of blocks is a task.  A first
   task compares sizes and counts of shingles in ``CELLS`` hash cells, which bound the overlap
   from above, and splits the group into the parts that may still hold links;
5. only the documents of these parts send their texts, and in a task for every pair of blocks
   (here of about ``BLOCK_SHINGLES`` shingles at most) of a part the overlaps are counted exactly;
   a task turns its texts into sets a piece at a time, and documents already known to be connected
   are not compared again.  The task returns a spanning forest of the links it found;
6. connected components over the forests name the groups of linked documents.

No list is ever cut short, and equal texts never multiply into pairs.

Defined results: a null or empty text or one without words has an empty set, links with
nothing and is its own component; fewer words than GRAM make one shingle of all of them; a
null doc_id is returned with a null component and links with nothing; rows that repeat a
doc_id are each returned and share its component; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import NOT_SPACE, connected_components, groups_of, keyed_texts, lists, mix, pieces, text_map, words_of
from tessera.operators.sizing import materialise

GRAM, PERCENT = 4, 85
#: Subset size of the light join.
K = 2
#: Documents of a group that meet in one task (two blocks of them).
BLOCK = 512
#: Shingles of a block where they are counted exactly: long documents meet in smaller blocks,
#: so that a task's memory does not follow their lengths.
BLOCK_SHINGLES = 400_000
#: Hash cells of the overlap bound; a count that means "this many or more".
CELLS, FULL_CELL = 256, 65535
#: Measured bytes up to which the tasks of the candidate documents are broadcast to the texts;
#: beyond, both sides are shuffled by doc_id.
BROADCAST_BYTES = 32 << 20
#: The frequent shingles put last in the order: at most so many, one in FREQUENT of all
#: shingle occurrences or more, counted over all documents (a Misra-Gries summary).
FREQUENT = 50_000


def shingle_sets(texts: list[bytes], gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, concatenated, and n + 1 offsets."""
    _, _, _, h, first = words_of(texts, NOT_SPACE)
    n = np.diff(first)
    count = np.where(n >= gram, n - gram + 1, (n > 0).astype(np.int64))
    text = np.repeat(np.arange(len(n)), count)
    at = np.repeat(first[:-1] - (np.cumsum(count) - count), count) + np.arange(count.sum())
    acc = np.zeros(len(at), dtype=np.uint64)
    padded = np.concatenate([h, np.zeros(gram, dtype=np.uint64)])
    short = n[text] < gram
    for j in range(gram):
        inside = ~short | (j < n[text])
        acc = acc * np.uint64(0x9E3779B97F4A7C15) + np.where(inside, padded[at + j], np.uint64(j + 1))
    acc = mix(acc + short.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.lexsort((acc, text))
    acc, text = acc[order], text[order]
    new = np.ones(len(acc), dtype=bool)
    new[1:] = (acc[1:] != acc[:-1]) | (text[1:] != text[:-1])
    acc, text = acc[new], text[new]
    offsets = np.zeros(len(n) + 1, dtype=np.int64)
    np.cumsum(np.bincount(text, minlength=len(n)), out=offsets[1:])
    return acc, offsets


def frequent_shingles(docs: DataFrame, gram: int, limit: int = FREQUENT) -> np.ndarray:
    """Shingles with more than one in ``limit`` of all occurrences, and perhaps some rarer
    ones; at most ``limit``, whatever the size of the corpus (Misra-Gries counters, kept
    per partition and merged).  They only set the order, so the result is exact either way."""
    from tessera.session import ship_package
    ship_package(docs.sparkSession)

    def trim(keys, counts):
        if len(keys) <= limit:
            return keys, counts
        cut = np.partition(counts, len(counts) - limit - 1)[len(counts) - limit - 1]
        left = counts > cut
        return keys[left], counts[left] - cut

    def merge(parts):
        keys, inv = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return trim(keys, np.bincount(inv, weights=np.concatenate([p[1] for p in parts])).astype(np.int64))

    def run(batches):
        have, waiting, size = (np.zeros(0, np.uint64), np.zeros(0, np.int64)), [], 0

        def fold():
            keys = np.concatenate(waiting)
            waiting.clear()
            keys.sort()                   # in place: np.unique would hold several copies
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])
            counts = np.diff(np.append(first, len(keys)))
            some = counts > 1             # among so many texts a frequent shingle repeats
            return merge([have, (keys[first[some]], counts[some])])

        for _, texts in pieces(batches):
            waiting.append(shingle_sets(texts, gram)[0])
            size += len(waiting[-1])
            if size > 40 * limit:
                have, size = fold(), 0
        if waiting:
            have = fold()
        yield pa.RecordBatch.from_arrays([pa.array(have[0].view(np.int64)), pa.array(have[1])], names=["g", "n"])

    top = (docs.mapInArrow(run, "g long, n long").groupBy("g").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "g").limit(limit).collect())
    return np.sort(np.array([r[0] for r in top], dtype=np.int64).view(np.uint64))


def needed(n, percent: int = PERCENT):
    """Smallest overlap with which a set of n links with any other."""
    return -(-n * percent // 100)


def summaries(docs: DataFrame, frequent: np.ndarray, gram: int, percent: int) -> DataFrame:
    """doc_id, n, sig (128 bits of the set) and the first shingles in the global order."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)        # at most FREQUENT numbers

    def run(ids, texts):
        v, off = shingle_sets(texts, gram)
        late = np.isin(v, shared.value) if len(shared.value) else np.zeros(len(v), bool)
        text = np.repeat(np.arange(len(texts)), np.diff(off))
        cell = (v >> np.uint64(8)).astype(np.int64) % CELLS
        counts = np.bincount(text * CELLS + cell, minlength=len(texts) * CELLS).reshape(-1, CELLS)
        counts = np.minimum(counts, FULL_CELL).astype(np.uint16)
        sigs, head, ends = [], [], [0]
        for i in range(len(texts)):
            own = v[off[i]:off[i + 1]]
            n = len(own)
            sigs.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if n else None)
            if n:
                own = own[np.argsort(late[off[i]:off[i + 1]], kind="stable")][:min(n, n - needed(n, percent) + K)]
                head.append(own)
            ends.append(ends[-1] + (len(own) if n else 0))
        values = np.concatenate(head) if head else np.zeros(0, np.uint64)
        return {"doc_id": ids, "n": np.diff(off), "sig": sigs,
                "cells": [c.tobytes() for c in counts],
                "head": lists(values.view(np.int64), np.array(ends), pa.int64())}

    return text_map(docs, run, "doc_id long, n long, sig binary, cells binary, head array<long>")


def boundary(sizes: list[tuple[int, int]], percent: int = PERCENT) -> int:
    """Size from which sets are heavy, by least cost; ``sizes`` holds (n, sets of that size).

    A light set costs one key for each K-subset of its head; a heavy set costs its postings,
    and each posting again for the lists it scans (taken as twice); sets of
    [t x, x) cost both."""
    best, where = None, 1
    ns = np.array([n for n, _ in sizes], dtype=np.int64)
    cs = np.array([c for _, c in sizes], dtype=np.float64)
    head = ns - needed(ns, percent) + K
    subsets, posts = cs * head * (head - 1) / 2, cs * 2 * (head - K + 1)
    for x in [2, *sorted({int(n) + 1 for n in ns if n >= 2})]:
        cost = subsets[(ns < x) & (ns >= 2)].sum() + posts[ns >= x * percent / 100].sum()
        if best is None or cost < best:
            best, where = cost, x
    return where


def candidate_groups(reps: DataFrame, x: int, percent: int) -> DataFrame:
    """(leader, doc_id): documents that share a subset or a list, under its smallest doc_id."""
    cut = F.col("n") - F.ceil(F.col("n") * percent / 100).cast("int") + 1
    single = F.transform(F.slice("head", 1, cut.cast("int")), lambda g: g)
    heavy = reps.where(F.col("n") * 100 >= x * percent).select("doc_id", F.explode(single).alias("key"))
    light = (reps.where((F.col("n") < x) & (F.col("n") >= 2))
             .select("doc_id", "head", F.posexplode("head").alias("i", "g"))
             .select("doc_id", "g", F.explode(F.expr("slice(head, i + 2, greatest(size(head) - i - 1, 0))")).alias("g2"))
             .select("doc_id", F.xxhash64("g", "g2").alias("key")))
    posts = heavy.unionByName(light)
    lead = (posts.groupBy("key").agg(F.min("doc_id").alias("leader"), F.max("doc_id").alias("last"))
            .where(F.col("leader") < F.col("last")).drop("last"))
    return posts.join(lead, "key").select("leader", "doc_id").distinct()


def forest(ids: np.ndarray, values: np.ndarray, offsets: np.ndarray, percent: int,
           left: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Spanning forest of the links among documents (``left`` marks one side when only pairs
    across two blocks are due).  The overlap of one document with all others is counted at
    once from their inverted lists; a document is counted only while some other document
    that it may link with is in another component."""
    n = len(ids)
    size = np.diff(offsets)
    order = np.argsort(values, kind="stable")
    new = np.ones(len(order), dtype=bool)
    new[1:] = values[order[1:]] != values[order[:-1]]
    start = np.append(np.flatnonzero(new), len(order))
    inv = np.empty(len(order), dtype=np.int32)          # a block has far fewer than 2**31 shingles
    inv[order] = np.cumsum(new, dtype=np.int32) - 1
    post = np.repeat(np.arange(n, dtype=np.int32), size)[order]
    del order, new
    root = np.arange(n)
    links = []
    todo = np.argsort(-size, kind="stable")
    counted = np.zeros(n, dtype=bool)
    while True:
        # a document of the largest component needs no count of its own: whatever it may link
        # with outside is counted from the other end
        names, members = np.unique(root, return_counts=True)
        main = names[np.argmax(members)] if n else -1
        rest = todo[~counted[todo] & (root[todo] != main)] if counted.any() else todo[:1]
        if not len(rest):
            return links
        i = rest[0]
        counted[i] = True
        own = inv[offsets[i]:offsets[i + 1]]
        lo, count = start[own], start[own + 1] - start[own]
        at = np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(count.sum())
        both = np.bincount(post[at], minlength=n)
        ok = both * (100 + percent) >= percent * (size + size[i])
        if left is not None:
            ok &= left != left[i]
        ok[i] = False
        for r in np.unique(root[ok]):
            if r != root[i]:
                j = np.flatnonzero(ok & (root == r))[0]
                links.append((int(ids[i]), int(ids[j])))
                root[root == r] = root[i]


TASK = ["leader", "i", "j"]


def block_tasks(groups: DataFrame, shingles: int | None = None) -> DataFrame:
    """(leader, i, j, block, doc_id): every document of a group in a task for each pair of its
    block with a block of the group.  With ``shingles`` a block holds about so many at most, by
    the sizes ``n`` of the documents."""
    members = F.count(F.lit(1))
    many = members / F.lit(BLOCK)
    if shingles:
        many = F.greatest(many, F.least(members, F.sum("n") / F.lit(shingles)))
    sized = groups.groupBy("leader").agg(F.ceil(many).cast("int").alias("blocks"))
    spot = (groups.join(sized, "leader")
            .withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")))
    return (spot.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("leader", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "doc_id"))


def across(table: pa.Table) -> np.ndarray | None:
    """The block of each row when only pairs across two blocks are due."""
    return None if table.column("i")[0] == table.column("j")[0] else table.column("block").to_numpy()


def narrowed(groups: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """(leader, doc_id, n): the groups split into parts that may hold links, by an upper bound of the
    overlaps; a part is named by its smallest doc_id, n is the size of the set."""
    rows = (block_tasks(groups).join(reps.select("doc_id", "n", "cells"), "doc_id")
            .repartition(*TASK).sortWithinPartitions(*TASK, "n"))

    def run(batches):
        for t in groups_of(batches, TASK):
            if t.num_rows < 2:
                continue
            ids, n = t.column("doc_id").to_numpy(), t.column("n").to_numpy()
            cells = np.frombuffer(b"".join(t.column("cells").to_pylist()), dtype=np.uint16).reshape(len(ids), CELLS)
            full = (cells == FULL_CELL).any(axis=1)            # counts not known: no bound
            block = across(t)
            root = np.arange(len(ids))
            for a in range(len(ids) - 1):
                end = np.searchsorted(n, n[a] * 100 // percent, side="right")
                may = np.arange(a + 1, end)
                if block is not None:
                    may = may[block[may] != block[a]]
                both = np.minimum(cells[may], cells[a]).sum(axis=1, dtype=np.int64)
                may = may[(both * (100 + percent) >= percent * (n[may] + n[a])) | full[may] | full[a]]
                for r in np.unique(root[may]):
                    if r != root[a]:
                        root[root == r] = root[a]
            part, size = np.unique(root, return_counts=True)
            lead = np.array([ids[root == r].min() for r in part[size > 1]], dtype=np.int64)
            for r, name in zip(part[size > 1], lead, strict=True):
                own = root == r
                yield pa.RecordBatch.from_arrays([pa.array(np.full(own.sum(), name)), pa.array(ids[own]), pa.array(n[own])],
                                                 names=["leader", "doc_id", "n"])

    return rows.mapInArrow(run, "leader long, doc_id long, n long").groupBy("leader", "doc_id").agg(F.max("n").alias("n"))


def task_sets(batches, gram: int):
    """Of each task of sorted batches: the doc_ids, sorted shingles and offsets, and the block of
    each document when only pairs across two blocks are due.  Texts become sets a piece at a
    time, so that a task holds its sets and one batch of texts."""
    key, rows, sets = None, [], []

    def joined():
        ids, block = (np.concatenate(x) for x in zip(*rows, strict=True))
        values, sizes = (np.concatenate(x) for x in zip(*sets, strict=True))
        return ids, values, np.append(0, np.cumsum(sizes)), None if key[1] == key[2] else block

    for b in batches:
        if not b.num_rows:
            continue
        task = np.stack([b.column(k).to_numpy() for k in TASK])
        cut = [0, *(np.flatnonzero((task[:, 1:] != task[:, :-1]).any(axis=0)) + 1).tolist(), b.num_rows]
        for s, e in zip(cut, cut[1:], strict=False):
            name = tuple(task[:, s].tolist())
            if rows and name != key:
                yield joined()
                rows, sets = [], []
            key, part = name, b.slice(s, e - s)
            rows.append(tuple(np.array(part.column(k)) for k in ("doc_id", "block")))
            for _, texts in pieces([part.select(["doc_id", "text"])]):
                values, offsets = shingle_sets(texts, gram)
                sets.append((values, np.diff(offsets)))
    if rows:
        yield joined()


def verified_links(groups: DataFrame, docs: DataFrame, gram: int, percent: int) -> DataFrame:
    """(a, b): enough links between the documents of each group to connect what is linked."""
    wanted = (block_tasks(groups, BLOCK_SHINGLES).groupBy("doc_id")
              .agg(F.collect_list(F.struct("leader", "i", "j", "block")).alias("tasks")))
    tasks = materialise(wanted, "jaccard-tasks")
    side = F.broadcast(tasks.df) if tasks.bytes() <= BROADCAST_BYTES else tasks.df
    sent = (docs.join(side, "doc_id").select("doc_id", "text", F.explode("tasks").alias("t"))
            .select("t.*", "doc_id", "text").repartition(*TASK).sortWithinPartitions(*TASK, "doc_id"))

    def run(batches):
        for ids, values, offsets, block in task_sets(batches, gram):
            links = forest(ids, values, offsets, percent, block)
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return sent.mapInArrow(run, "a long, b long")


def jaccard_components(docs: DataFrame, gram: int = GRAM, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    texts = keyed_texts(docs)
    frequent = frequent_shingles(texts, gram)
    table = materialise(summaries(texts, frequent, gram, percent), "shingle-heads", measure=False).df
    classes = (table.where(F.col("doc_id").isNotNull() & F.col("sig").isNotNull())
               .groupBy("sig").agg(F.min("doc_id").alias("rep")))
    reps = (table.where(F.col("n") > 0).join(classes, "sig").where(F.col("doc_id") == F.col("rep"))
            .dropDuplicates(["doc_id", "sig"]).select("doc_id", "n", "cells", "head"))
    sizes = [(int(r[0]), int(r[1])) for r in
             table.where(F.col("n") > 0).groupBy("n").count().orderBy("n").collect()]
    x = boundary(sizes, percent)
    groups = materialise(candidate_groups(reps, x, percent), "jaccard-groups", measure=False).df
    groups = materialise(narrowed(groups, reps, percent), "jaccard-parts", measure=False).df
    edges = verified_links(groups, texts, gram, percent)
    labels = connected_components(edges, "jaccard")
    named = (table.join(classes, "sig", "left")
             .join(labels.select(F.col("node").alias("rep"), "component"), "rep", "left"))
    return named.select("doc_id", F.col("n").alias("n_shingles"),
                        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id")).alias("component_id"))


def jaccard_query(docs: DataFrame) -> DataFrame:
    return jaccard_components(docs)


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """Pipeline stage (five words, similarity 0.8): of every group of linked rows one stays, the
    one with the smallest doc_id.  Rows are told apart by doc_id and text, so two texts under one doc_id
    are judged each by itself, and of rows equal in both one stays.  Rows without doc_id and texts without
    words stay; an empty table stays empty; all columns are kept, whatever their names."""
    row = F.when(F.col("doc_id").isNotNull(), F.xxhash64(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit(""))))
    named = docs.select(row.alias("__row"), F.col("doc_id").cast("long").alias("__id"), F.col("text"))
    found = materialise(jaccard_components(named.select(F.col("__row").alias("doc_id"), "text"), gram=5, percent=80), "near-rows", measure=False).df
    linked = (found.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
              .select(F.col("doc_id").alias("__row"), F.col("component_id").alias("__group")))
    times = linked.groupBy("__row").agg(F.first("__group").alias("__group"), F.count(F.lit(1)).alias("__n"))
    ids = named.where(F.col("__row").isNotNull()).select("__row", "__id").distinct()
    # only rows that are not alone take part: a group of several, or one row several times
    size = times.groupBy("__group").agg(F.sum("__n").alias("__m"))
    several = materialise(times.join(size.where(F.col("__m") > 1).select("__group"), "__group").join(ids, "__row"), "near-several", measure=False).df
    stays = several.groupBy("__group").agg(F.min(F.struct("__id", "__row")).alias("s")).select(F.col("s.__row").alias("__row"))
    gone = materialise(several.join(stays, "__row", "left_anti").select(F.col("__row").alias("__gone")).distinct(), "near-gone")
    again = materialise(several.join(stays, "__row").where(F.col("__n") > 1).select(F.col("__row").alias("__again")).distinct(), "near-again")
    own = [F.col(f"`{c}`") for c in docs.columns]
    # both are broadcast below the measured limit only
    kept = docs.withColumn("__row", row).join(gone.for_join(), F.col("__row") == F.col("__gone"), "left_anti")
    if not again.rows:
        return kept.select(*own)
    once = kept.join(again.for_join(), F.col("__row") == F.col("__again"), "left_semi").dropDuplicates(["__row"])
    return (kept.join(again.for_join(), F.col("__row") == F.col("__again"), "left_anti").select(*own)
            .unionByName(once.select(*own)))
