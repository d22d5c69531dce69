"""Toxicity scores: a bidirectional gated recurrent network with attention pooling.

A text is cut into words (runs of letters, digits and non-ASCII bytes, A-Z lower-cased)
and into windows of ``WINDOW`` words that start every ``STRIDE`` words, so that all words
lie in overlapping windows.  A step of the network sees two inputs: the embedding of the
word (hashed) and the mean embedding of its character n-grams (hashed prefixes, suffixes
and inner n-grams).  A GRU runs over the window in each direction, softmax attention pools
its states, and a logistic output scores the window.  The text's score is a calibrated
function of its best windows; every window of every text is scored.

Training is plain numpy on a bounded sample of labelled rows (``TRAIN_DOCS`` of each class,
texts up to ``TRAIN_CHARS``): a toxic text does not say which window is toxic, so training
alternates between picking the windows that look most toxic in each toxic text and
fitting the network to them (multiple-instance learning).  Word and n-gram embeddings
start with their smoothed log-odds in one coordinate.

Defined results: a null or empty text, or one without words, is scored like a single empty
window; without labelled rows of both classes the score is the share of label 1 (0 if
there are no labels); repeated rows get equal scores; other columns are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from tessera.llm.common import PIECE_BYTES, WORDLIKE, keyed_texts, mix, pieces, range_hashes, read_table, sampled, words_of
from tessera.session import ship_package

WINDOW, STRIDE = 16, 8
WORD_BUCKETS, GRAM_BUCKETS = 1 << 15, 1 << 15
DIM, HIDDEN = 6, 6
#: Bounds of the training sample: rows of each class, characters of a text.
TRAIN_DOCS, TRAIN_CHARS = 4000, 12_000
THRESHOLD = 0.3
#: Byte lengths of the hashed character n-grams: prefixes, suffixes, inner.
PREFIXES, SUFFIXES, INNER = (4, 6, 8), (4,), (5,)


def unique_words(buf, s, e, h):
    """Distinct words of a piece: (first position of each, index of each word)."""
    _, first, inverse = np.unique(h, return_index=True, return_inverse=True)
    return s[first], e[first], h[first], inverse


def gram_ids(buf, s, e):
    """(word index, n-gram bucket) pairs of the character n-grams of the words."""
    n = e - s
    who, lo, hi, kind = [], [], [], []
    for tag, lengths in ((1, PREFIXES), (2, SUFFIXES)):
        for k in lengths:
            i = np.flatnonzero(n >= 2)
            m = np.minimum(n[i], k)
            who.append(i)
            lo.append(s[i] if tag == 1 else e[i] - m)
            hi.append(s[i] + m if tag == 1 else e[i])
            kind.append(np.full(len(i), 100 * tag + k, dtype=np.uint64))
    for k in INNER:
        count = np.maximum(n - k + 1, 0)
        i = np.repeat(np.arange(len(s)), count)
        at = np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
        who.append(i)
        lo.append(s[i] + at)
        hi.append(s[i] + at + k)
        kind.append(np.full(len(i), k, dtype=np.uint64))
    who, lo, hi, kind = map(np.concatenate, (who, lo, hi, kind))
    g = mix(range_hashes(buf, lo, hi) + kind * np.uint64(0x9E3779B97F4A7C15))
    return who.astype(np.int32), (g % np.uint64(GRAM_BUCKETS)).astype(np.int32)


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All overlapping windows of the texts whose words start at first[i]: (word index of
    each step, -1 behind the end; text of each window; windows before each text)."""
    n = np.diff(first)
    per = np.maximum(1, -(-np.maximum(n - WINDOW, 0) // STRIDE) + 1)
    text = np.repeat(np.arange(len(n)), per)
    before = np.zeros(len(n) + 1, dtype=np.int64)
    np.cumsum(per, out=before[1:])
    start = ((np.arange(len(text)) - before[text]) * STRIDE).astype(np.int32)
    step = start[:, None] + np.arange(WINDOW, dtype=np.int32)
    inside = step < n[text][:, None]
    step += first[text][:, None].astype(np.int32)
    step[~inside] = -1
    return step, text, before


def sigmoid(x):
    return 0.5 * (np.tanh(0.5 * x) + 1)


@dataclass
class Net:
    """Parameters; p holds the dense ones, words and grams the embeddings."""

    p: dict
    words: np.ndarray
    grams: np.ndarray
    calibration: tuple = (1.0, 0.0, 0.0)
    constant: float | None = None

    @staticmethod
    def fresh(rng) -> Net:
        p = {}
        for d in "fb":
            p[f"W{d}"] = rng.normal(0, 0.5 / np.sqrt(2 * DIM), (2 * DIM, 3 * HIDDEN))
            p[f"U{d}"] = rng.normal(0, 0.5 / np.sqrt(HIDDEN), (HIDDEN, 3 * HIDDEN))
            p[f"c{d}"] = np.zeros(3 * HIDDEN)
        p["a"] = rng.normal(0, 0.1, 2 * HIDDEN)
        p["o"] = rng.normal(0, 0.3, 2 * HIDDEN)
        p["o0"] = np.zeros(1)
        f = {k: v.astype(np.float32) for k, v in p.items()}
        return Net(f, rng.normal(0, 0.05, (WORD_BUCKETS + 1, DIM)).astype(np.float32),
                   rng.normal(0, 0.05, (GRAM_BUCKETS, DIM)).astype(np.float32))

    def inputs(self, wid, who, gid, n):
        """Input vectors of n distinct words (row n: the empty step)."""
        x = np.zeros((n + 1, 2 * DIM), dtype=np.float32)
        x[:n, :DIM] = self.words[wid]
        x[n, :DIM] = self.words[WORD_BUCKETS]
        if len(who):
            count = np.bincount(who, minlength=n).astype(np.float32)
            for j in range(DIM):
                x[:n, DIM + j] = np.bincount(who, weights=self.grams[gid, j], minlength=n)
            x[:n, DIM:] /= np.maximum(count, 1)[:, None]
        return x

    def forward(self, x, idx, keep=False):
        """Logits of windows; idx holds rows of x for each step."""
        n, h = len(idx), HIDDEN
        out = np.empty((WINDOW, n, 2 * h), dtype=np.float32)
        memo = {}
        for d, order in (("f", range(WINDOW)), ("b", range(WINDOW - 1, -1, -1))):
            proj = x @ self.p[f"W{d}"] + self.p[f"c{d}"]
            u = self.p[f"U{d}"]
            s = np.zeros((n, h), dtype=np.float32)
            for t in order:
                g = proj[idx[:, t]]
                zr = sigmoid(g[:, :2 * h] + s @ u[:, :2 * h])
                z, r = zr[:, :h], zr[:, h:]
                rs = r * s
                c = np.tanh(g[:, 2 * h:] + rs @ u[:, 2 * h:])
                new = s + z * (c - s)
                if keep:
                    memo[d, t] = (s, z, r, rs, c)
                s = new
                out[t, :, (0 if d == "f" else h):(h if d == "f" else 2 * h)] = s
        score = out @ self.p["a"]
        score -= score.max(axis=0)
        att = np.exp(score)
        att /= att.sum(axis=0)
        pooled = np.einsum("tn,tnk->nk", att, out)
        logit = pooled @ self.p["o"] + self.p["o0"]
        return (logit, out, att, pooled, memo) if keep else logit

    def gradients(self, x, idx, y, weight):
        """Gradients of the weighted logistic loss, by hand."""
        h = HIDDEN
        logit, out, att, pooled, memo = self.forward(x, idx, keep=True)
        dl = ((sigmoid(logit) - y) * weight / len(y)).astype(np.float32)
        g = {"o": pooled.T @ dl, "o0": dl.sum(keepdims=True)}
        dp = dl[:, None] * self.p["o"]
        dout = att[:, :, None] * dp[None]
        da = np.einsum("tnk,nk->tn", out, dp)
        ds = att * (da - (att * da).sum(axis=0))
        g["a"] = np.einsum("tn,tnk->k", ds, out)
        dout += ds[:, :, None] * self.p["a"]
        dx = np.zeros_like(x)
        for d, order in (("f", range(WINDOW - 1, -1, -1)), ("b", range(WINDOW))):
            u, w = self.p[f"U{d}"], self.p[f"W{d}"]
            gu, gproj = np.zeros_like(u), np.zeros((len(x), 3 * h), dtype=np.float32)
            carry = np.zeros((len(idx), h), dtype=np.float32)
            cols = slice(0, h) if d == "f" else slice(h, 2 * h)
            for t in order:
                s, z, r, rs, c = memo[d, t]
                dn = carry + dout[t][:, cols]
                dz, dc = dn * (c - s) * z * (1 - z), dn * z * (1 - c * c)
                drs = dc @ u[:, 2 * h:].T
                dr = drs * s * r * (1 - r)
                pre = np.concatenate([dz, dr, dc], axis=1)
                carry = dn * (1 - z) + drs * r + dz @ u[:, :h].T + dr @ u[:, h:2 * h].T
                gu[:, :h] += s.T @ dz
                gu[:, h:2 * h] += s.T @ dr
                gu[:, 2 * h:] += rs.T @ dc
                np.add.at(gproj, idx[:, t], pre)
            g[f"U{d}"], g[f"W{d}"], g[f"c{d}"] = gu, x.T @ gproj, gproj.sum(axis=0)
            dx += gproj @ w.T
        return g, dx


def _parts(texts: Iterable[bytes]):
    """Texts in lists of about PIECE_BYTES."""
    part, size = [], 0
    for t in texts:
        if part and size + len(t) > PIECE_BYTES:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


class Encoded:
    """Texts as distinct words, their n-grams and windows.  The texts are read once, a part at
    a time, and not held."""

    def __init__(self, texts: Iterable[bytes]):
        hashes, words, grams, first, known = [], [], [], [np.zeros(1, np.int64)], 0
        seen = np.zeros(0, np.uint64)
        for part in _parts(texts):
            buf, s, e, h, own = words_of(part, WORDLIKE)
            us, ue, uh, word = unique_words(buf, s, e, h)
            new = np.flatnonzero(~np.isin(uh, seen))           # one set of n-grams for each distinct word
            who, gid = gram_ids(buf, us[new], ue[new])
            words.append((word + known).astype(np.int32))
            grams.append(((new[who] + known).astype(np.int32), gid))
            hashes.append(uh)
            seen = np.concatenate([seen, uh[new]])
            first.append(own[1:] + first[-1][-1])
            known += len(uh)
        uh, number = np.unique(np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), return_inverse=True)
        number = number.astype(np.int32)
        self.wid = (uh % np.uint64(WORD_BUCKETS)).astype(np.int64)
        self.word = np.concatenate([number[w] for w in words]) if words else np.zeros(0, np.int32)
        self.who = np.concatenate([number[g[0]] for g in grams]) if grams else np.zeros(0, np.int32)
        self.gid = np.concatenate([g[1] for g in grams]) if grams else np.zeros(0, np.int32)
        self.first = np.concatenate(first)
        self.idx, self.before = windows(self.first)[::2]
        for lo in range(0, len(self.idx), 4096):               # word positions become words, in place
            step = self.idx[lo:lo + 4096]
            empty = step < 0
            if len(self.word):
                step[:] = self.word[np.maximum(step, 0)]
            step[empty] = len(uh)

    def logits(self, net: Net, block: int = 4096) -> np.ndarray:
        x = net.inputs(self.wid, self.who, self.gid, len(self.wid))
        out = [net.forward(x, self.idx[i:i + block]) for i in range(0, len(self.idx), block)]
        return np.concatenate(out) if out else np.zeros(0, np.float32)


def best_windows(logit: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Highest and mean-of-the-sigmoid window of each text."""
    top = np.maximum.reduceat(logit, before[:-1])
    count = np.diff(before)
    second = np.add.reduceat(sigmoid(logit), before[:-1]) / count
    return np.stack([top, second], axis=1)


def train(rows: Iterable[tuple[int, bytes]], totals: dict[int, int] | None = None, seed: int = 7, rounds: int = 3,
          epochs: int = 3, batch: int = 256, rate: float = 0.01) -> Net:
    """Fit the network to (label, text) rows; see the module text.  ``totals`` holds how many
    rows each label has in all, so that the scores are calibrated to the true shares."""
    rng = np.random.default_rng(seed)
    net = Net.fresh(rng)
    label: list[int] = []
    enc = Encoded(t for k, t in rows if not label.append(k))
    y, n = np.array(label), len(label)
    if n == 0 or y.min() == y.max():
        net.constant = float(y.mean()) if n else 0.0
        return net
    odds_w, odds_g = _class_odds(enc, y)
    net.words[:WORD_BUCKETS, 0] = odds_w
    net.grams[:, 0] = odds_g * 2
    x = net.inputs(enc.wid, enc.who, enc.gid, len(enc.wid))
    odds = x[:, 0] + x[:, DIM]
    guess = np.concatenate([odds[enc.idx[i:i + 4096]].max(axis=1) for i in range(0, len(enc.idx), 4096)])
    state: dict = {}
    for _ in range(rounds):
        pos, neg = [], []
        for i in range(n):
            lo, hi = enc.before[i], enc.before[i + 1]
            k = np.argsort(-guess[lo:hi], kind="stable")
            if y[i]:
                pos.extend(lo + k[:max(1, min(3, (hi - lo) // 4))])
            else:
                neg.extend(lo + k[:3])
                neg.append(lo + int(rng.integers(hi - lo)))
        pick = np.concatenate([pos, neg]).astype(np.int64)
        goal = np.concatenate([np.ones(len(pos)), np.zeros(len(neg))]).astype(np.float32)
        weight = np.where(goal > 0, 0.5 * len(goal) / max(len(pos), 1), 0.5 * len(goal) / max(len(neg), 1)).astype(np.float32)
        for _ in range(epochs):
            shuffled = rng.permutation(len(pick))
            for lo in range(0, len(pick), batch):
                b = shuffled[lo:lo + batch]
                _step(net, enc, pick[b], goal[b], weight[b], rate, state)
        guess = enc.logits(net)
    feats = best_windows(guess, enc.before)
    share = np.array([(totals or {}).get(k, (y == k).sum()) / max((y == k).sum(), 1) for k in (0, 1)])
    net.calibration = _logistic(feats, y, share[y] / share[y].mean())
    return net


def _class_odds(enc: Encoded, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of the word and the n-gram buckets over texts, 200 texts at a time."""
    order = np.argsort(enc.who, kind="stable")
    gid, start = enc.gid[order], np.searchsorted(enc.who[order], np.arange(len(enc.wid) + 1))
    del order
    size = np.diff(start)
    word, gram = np.zeros((2, WORD_BUCKETS)), np.zeros((2, GRAM_BUCKETS))  # texts of each label that hold one
    for lo in range(0, len(y), 200):
        first = enc.first[lo:lo + 201]
        text_of = np.repeat(np.arange(lo, lo + len(first) - 1), np.diff(first))
        t, u = np.divmod(np.unique(text_of * (len(enc.wid) + 1) + enc.word[first[0]:first[-1]]), len(enc.wid) + 1)
        count = size[u]
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(start[:-1][u], count)
        tg = np.unique(np.repeat(t, count) * GRAM_BUCKETS + gid[at])
        for k in (0, 1):
            word[k] += np.bincount(enc.wid[u[y[t] == k]], minlength=WORD_BUCKETS)
            gram[k] += np.bincount(tg[y[tg // GRAM_BUCKETS] == k] % GRAM_BUCKETS, minlength=GRAM_BUCKETS)
    return _log_odds(word[1], word[0], y), _log_odds(gram[1], gram[0], y)


def _log_odds(a, b, y):
    """Smoothed log-odds of buckets met in a texts of label 1 and b of label 0 (0 if never met)."""
    odds = np.log((a + 0.5) / (y.sum() + 1)) - np.log((b + 0.5) / ((1 - y).sum() + 1))
    return np.where(a + b > 0, odds, 0.0)


def _step(net, enc, win, goal, weight, rate, state):
    """One Adam step on a batch of windows (embeddings: only the rows it touches)."""
    used, idx = np.unique(enc.idx[win], return_inverse=True)
    idx = idx.reshape(len(win), WINDOW)
    real = used[used < len(enc.wid)]
    place = np.full(len(enc.wid) + 1, -1)
    place[real] = np.arange(len(real))
    on = place[enc.who] >= 0
    who, gid = place[enc.who[on]], enc.gid[on]
    x = net.inputs(enc.wid[real], who, gid, len(real))
    if len(used) > len(real):
        idx = np.where(idx == len(real), len(real), idx)
    g, dx = net.gradients(x, idx, goal, weight)
    for k, v in g.items():
        _adam(net.p[k], v, rate, state, k, slice(None))
    rows, inv = np.unique(np.append(enc.wid[real], WORD_BUCKETS), return_inverse=True)
    gw = np.zeros((len(rows), DIM), dtype=np.float32)
    np.add.at(gw, inv, dx[:, :DIM])
    _adam(net.words, gw, rate, state, "words", rows)
    if len(who):
        count = np.bincount(who, minlength=len(real))
        rows, inv = np.unique(gid, return_inverse=True)
        per = dx[who, DIM:] / np.maximum(count, 1)[who][:, None]
        gg = np.stack([np.bincount(inv, weights=per[:, j], minlength=len(rows)) for j in range(DIM)], axis=1)
        _adam(net.grams, gg.astype(np.float32), rate, state, "grams", rows)


def _adam(param, grad, rate, state, key, rows):
    m, v, n = state.setdefault(key, [np.zeros_like(param), np.zeros_like(param), 0])
    state[key][2] = n = n + 1
    m[rows] = 0.9 * m[rows] + 0.1 * grad
    v[rows] = 0.99 * v[rows] + 0.01 * grad * grad
    param[rows] -= (rate * (m[rows] / (1 - 0.9 ** n)) / (np.sqrt(v[rows] / (1 - 0.99 ** n)) + 1e-6)).astype(param.dtype)


def _logistic(feats, y, weight, steps: int = 400):
    """Newton-fitted weighted logistic calibration (two inputs and a constant)."""
    a = np.column_stack([feats, np.ones(len(feats))]).astype(np.float64)
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = sigmoid(a @ w)
        grad = a.T @ (weight * (p - y)) + 0.1 * w
        hess = (a * (weight * p * (1 - p))[:, None]).T @ a + 0.1 * np.eye(len(w))
        move = np.linalg.solve(hess, grad)
        w -= move
        if np.abs(move).max() < 1e-8:
            break
    return tuple(map(float, w))


def score_texts(net: Net, texts: list[bytes]) -> np.ndarray:
    if net.constant is not None:
        return np.full(len(texts), net.constant)
    enc = Encoded(texts)
    f = best_windows(enc.logits(net), enc.before).astype(np.float64)
    a, b, c = net.calibration
    return sigmoid(a * f[:, 0] + b * f[:, 1] + c)


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, keep, seed: int = 7) -> Net:
    """Train in one task on the bounded sample; only the parameters reach the driver."""
    ship_package(spark)
    rows, totals = sampled(spark, docs, labels, "toxic", keep, TRAIN_DOCS, TRAIN_CHARS)

    def run(batches):
        own = ((y, t) for b in batches for ys, ts in pieces([b]) for y, t in zip(ys, ts, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(own, totals, seed))], pa.binary())], names=["net"])

    found = rows.mapInArrow(run, "net binary").first()     # none without partitions
    return pickle.loads(bytes(found[0])) if found else train([], totals, seed)


def scorer(spark: SparkSession, net: Net):
    """Column function text -> score, for use next to any other columns."""
    ship_package(spark)
    shared = spark.sparkContext.broadcast(net)            # a fixed number of parameters

    @arrow_udf(T.DoubleType())
    def toxicity(text: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([pa.nulls(len(text)), text.fill_null("")], names=["i", "t"])
        parts = [score_texts(shared.value, t) for _, t in pieces([batch])]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return toxicity


def train_rows(doc_id: Column) -> Column:
    """The rows whose labels may be learnt."""
    return F.crc32(doc_id.cast("string")) % 4 != 2


def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    net = fit(spark, docs, read_table(spark, sf_dir, "labels"), train_rows)
    score = scorer(spark, net)
    return (keyed_texts(docs).select("doc_id", score("text").alias("score"))
            .select("doc_id", F.coalesce(~train_rows(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents scored at or above the threshold go."""
    net = fit(spark, docs, read_table(spark, sf_dir, "labels"), train_rows)
    score = scorer(spark, net)
    return docs.where(score(F.coalesce(F.col("text").cast("string"), F.lit(""))) < THRESHOLD)
