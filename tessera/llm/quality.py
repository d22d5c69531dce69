"""Quality classifier by positive-unlabelled learning.

A text becomes a few dozen numbers (shares of byte classes, words, repeats, lines).  A
one-layer network with tanh units is trained with the non-negative unbiased risk

    prior * R_pos(+1)  +  max(0, R_unlabelled(-1) - prior * R_pos(-1))

(logistic loss) on trusted positives (label 1) and unlabelled documents.  The class prior is
estimated from the same two samples: a first network tells positives from unlabelled texts,
and the prior is the least ratio of the shares of unlabelled and positive texts above a
threshold of its score, with a margin for the sampling error.  The network's output is then
calibrated to label shares on labelled rows of the training folds.

Samples are bounded: ``POSITIVES`` and ``UNLABELLED`` rows for training, ``CALIBRATION``
labelled rows; the features are computed by Spark from the whole texts and only they reach
the driver.  Every document is scored in one narrow pass.

Defined results: a null or empty text has all-zero shares and is scored like any other;
without positive or unlabelled rows the score is the share of label 1 among labelled rows
(0.5 without labels); repeated rows get equal scores; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import NOT_SPACE, flatten, keyed_texts, range_hashes, read_table, text_map, word_ranges

POSITIVES, UNLABELLED, CALIBRATION = 8000, 8000, 8000
THRESHOLD = 0.3
HIDDEN = 16

# Fixed byte classes: 0 other control, 1 space, 2 line feed, 3 digit, 4 upper, 5 lower, 6 non-ASCII,
# 7 full stop, 8 comma and the like, 9 exclamation, 10 bar, 11 symbols, 12 brackets and quotes, 13 dash and slash.
_CLASS = np.zeros(256, dtype=np.int64)
for _k, _chars in ((1, b" \t"), (2, b"\n\r"), (3, b"0123456789"), (7, b"."), (8, b",;:?"), (9, b"!"), (10, b"|"),
                   (11, b"#$%&*+<=>@\\^_`~"), (12, b"\"'()[]{}"), (13, b"-/")):
    _CLASS[list(_chars)] = _k
_CLASS[65:91], _CLASS[97:123], _CLASS[128:] = 4, 5, 6
CLASSES = 14


def _per(index: np.ndarray, n: int, weights=None) -> np.ndarray:
    return np.bincount(index, weights=weights, minlength=n).astype(np.float64)


def _distinct(text: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes in each text."""
    order = np.lexsort((h, text))
    t, h = text[order], h[order]
    new = np.ones(len(t), dtype=bool)
    new[1:] = (t[1:] != t[:-1]) | (h[1:] != h[:-1])
    return _per(t[new], n)


def features(texts: list[bytes]) -> np.ndarray:
    """One row of features for each text."""
    n = len(texts)
    buf, offsets = flatten(texts)
    lens = np.diff(offsets) - 1
    of = np.repeat(np.arange(n), lens + 1)
    share = np.bincount(of * CLASSES + _CLASS[buf], minlength=n * CLASSES).reshape(n, CLASSES).astype(np.float64)
    share[:, 2] -= 1                                   # the separator of the piece
    size = np.maximum(lens, 1)[:, None]
    share /= size
    s, e = word_ranges(buf, NOT_SPACE)
    text, h, length = of[s], range_hashes(buf, s, e), (e - s).astype(np.float64)
    words = np.maximum(_per(text, n), 1)
    mean = _per(text, n, length) / words
    spread = np.sqrt(np.maximum(_per(text, n, length ** 2) / words - mean ** 2, 0))
    again = np.zeros(len(h))
    again[1:] = (h[1:] == h[:-1]) & (text[1:] == text[:-1])
    first, last = _CLASS[buf[s]], _CLASS[buf[np.maximum(e - 1, 0)]]
    upper = (first == 4) & (_CLASS[buf[np.minimum(s + 1, len(buf) - 1)]] == 4)
    ls, le = word_ranges(buf, np.arange(256) != 10)
    lt, lh = of[ls], range_hashes(buf, ls, le)
    lines = np.maximum(_per(lt, n), 1)
    pair = h[:-1] * np.uint64(31) + h[1:] if len(h) > 1 else np.zeros(0, np.uint64)
    inside = text[1:] == text[:-1] if len(h) > 1 else np.zeros(0, bool)
    pairs = np.maximum(_per(text[1:][inside], n), 1) if len(h) > 1 else np.ones(n)
    cols = [np.log1p(lens), np.log1p(words), mean, spread, _distinct(text, h, n) / words, _per(text, n, again) / words,
            _per(text[upper], n) / words, _per(text[(last >= 9) & (last <= 11)], n) / words,
            _per(text[e - s == 1], n) / words, _per(text[length > 20], n) / words,
            np.log1p(lines), _distinct(lt, lh, n) / lines,
            (_distinct(text[1:][inside], pair[inside], n) if len(h) > 1 else np.zeros(n)) / pairs]
    return np.column_stack([*[np.sqrt(share[:, k]) for k in range(CLASSES)], *cols])


N_FEATURES = CLASSES + 13


@dataclass
class Scorer:
    mean: np.ndarray
    scale: np.ndarray
    net: list
    calibration: tuple = (1.0, 0.0)
    prior: float = 0.5
    constant: float | None = None

    def logit(self, x: np.ndarray) -> np.ndarray:
        return _forward(self.net, (x - self.mean) / self.scale)[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        a, b = self.calibration
        return _sigmoid(a * self.logit(x) + b)


def _sigmoid(v):
    return 0.5 * (np.tanh(0.5 * v) + 1)


def _forward(net, x):
    w, b, v, c = net
    h = np.tanh(x @ w + b)
    return h @ v + c[0], h


def _fit(pos, unl, prior, seed, epochs=60, batch=512, rate=0.005, decay=1e-4):
    """Adam on the non-negative risk; ``prior`` None trains plain positive against unlabelled."""
    rng = np.random.default_rng(seed)
    d = pos.shape[1]
    net = [rng.normal(0, 1 / np.sqrt(d), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.3, HIDDEN), np.zeros(1)]
    m, s, n = [np.zeros_like(p) for p in net], [np.zeros_like(p) for p in net], 0
    steps = max(1, max(len(pos), len(unl)) // batch)
    for _ in range(epochs):
        ip, iu = rng.permutation(len(pos)), rng.permutation(len(unl))
        for k in range(steps):
            p = pos[ip[np.arange(k * batch, (k + 1) * batch) % len(pos)]]
            u = unl[iu[np.arange(k * batch, (k + 1) * batch) % len(unl)]]
            (fp, hp), (fu, hu) = _forward(net, p), _forward(net, u)
            up, un = -_sigmoid(-fp), _sigmoid(fu)          # slopes of the losses for +1 and for -1
            if prior is None:
                gp, gu = up / len(p), un / len(u)
            else:
                negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
                if negative >= 0:
                    gp, gu = prior * (up - _sigmoid(fp)) / len(p), un / len(u)
                else:                                   # undo the part of the risk that went below zero
                    gp, gu = prior * _sigmoid(fp) / len(p), -un / len(u)
            grads = [decay * net[0], 0, decay * net[2], 0]
            for x, h, g in ((p, hp, gp), (u, hu, gu)):
                back = (g[:, None] * net[2]) * (1 - h * h)
                for i, q in enumerate((x.T @ back, back.sum(0), h.T @ g, np.array([g.sum()]))):
                    grads[i] = grads[i] + q
            n += 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                s[i] = 0.999 * s[i] + 0.001 * g * g
                net[i] = net[i] - rate * (m[i] / (1 - 0.9 ** n)) / (np.sqrt(s[i] / (1 - 0.999 ** n)) + 1e-8)
    return net


def estimate_prior(pos: np.ndarray, unl: np.ndarray) -> float:
    """Largest share of positives that the unlabelled scores allow: the least ratio of tail
    shares, with one standard error on both."""
    cuts = np.quantile(pos, np.linspace(0.0, 0.9, 91))
    p = np.array([(pos >= c).mean() for c in cuts])
    u = np.array([(unl >= c).mean() for c in cuts])
    u = u + np.sqrt(u * (1 - u) / len(unl))
    p = p - np.sqrt(p * (1 - p) / len(pos))
    return float(np.clip((u[p > 0.05] / p[p > 0.05]).min(), 0.02, 0.98))


def train(pos: np.ndarray, unl: np.ndarray, labelled: np.ndarray, y: np.ndarray, seed: int = 11) -> Scorer:
    """Fit on feature rows: trusted positives, unlabelled, and labelled rows for calibration."""
    if not len(pos) or not len(unl):
        zero = np.zeros(N_FEATURES)
        return Scorer(zero, zero + 1, [], constant=float(y.mean()) if len(y) else 0.5)
    both = np.concatenate([pos, unl])
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-6
    p, u = (pos - mean) / scale, (unl - mean) / scale
    half = len(p) // 2, len(u) // 2
    first = _fit(p[:half[0] or 1], u[:half[1] or 1], None, seed, epochs=20)
    prior = estimate_prior(_forward(first, p[half[0]:])[0], _forward(first, u[half[1]:])[0])
    out = Scorer(mean, scale, _fit(p, u, prior, seed + 1), prior=prior)
    if len(y) and 0 < y.mean() < 1:
        f = out.logit(labelled)
        a = np.column_stack([f, np.ones(len(f))])
        w = np.array([1.0, 0.0])
        for _ in range(100):
            q = _sigmoid(a @ w)
            move = np.linalg.solve((a * (q * (1 - q))[:, None]).T @ a + 0.1 * np.eye(2), a.T @ (q - y) + 0.1 * w)
            w = w - np.clip(move, -2, 2)
            if np.abs(move).max() < 1e-9:
                break
        if w[0] > 0:
            out.calibration = (float(w[0]), float(w[1]))
    return out


def feature_rows(docs: DataFrame) -> DataFrame:
    return text_map(docs, lambda ids, texts: {"doc_id": ids, "x": features(texts).tolist()},
                    "doc_id long, x array<double>")


def train_rows(doc_id: Column) -> Column:
    """The rows whose labels may be learnt."""
    return F.crc32(doc_id.cast("string")) % 5 != 0


def fit(docs: DataFrame, labels: DataFrame, keep=train_rows, seed: int = 11) -> Scorer:
    """Draw the bounded samples (rows of smallest hash), take their features, train."""
    lab = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
           .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1)).where(keep(F.col("doc_id")))
           .groupBy("doc_id").agg(F.max("y").alias("y")))
    draw = lambda salt: F.xxhash64(F.col("doc_id"), F.lit(salt))
    texts = keyed_texts(docs)
    parts = [lab.where(F.col("y") == 1).orderBy(draw("pos"), "doc_id").limit(POSITIVES)
             .select("doc_id", F.lit("p").alias("part"), "y"),
             lab.orderBy(draw("cal"), "doc_id").limit(CALIBRATION).select("doc_id", F.lit("c").alias("part"), "y"),
             texts.where(F.col("doc_id").isNotNull()).join(lab, "doc_id", "left_anti").select("doc_id")
             .orderBy(draw("unl"), "doc_id").limit(UNLABELLED)
             .select("doc_id", F.lit("u").alias("part"), F.lit(None).cast("int").alias("y"))]
    chosen = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("doc_id").agg(
        F.collect_set("part").alias("parts"), F.max("y").alias("y"))
    few = texts.join(F.broadcast(chosen), "doc_id")        # at most the three sample sizes of rows
    got = feature_rows(few.select("doc_id", "text")).join(F.broadcast(chosen), "doc_id").orderBy("doc_id").collect()
    take = lambda part: np.array([r["x"] for r in got if part in r["parts"]], dtype=float).reshape(-1, N_FEATURES)
    y = np.array([r["y"] for r in got if "c" in r["parts"]], dtype=float)
    return train(take("p"), take("u"), take("c"), y, seed)


def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = spark.sparkContext.broadcast(fit(docs, read_table(spark, sf_dir, "labels")))

    def run(ids, texts):
        return {"doc_id": ids, "score": model.value.score(features(texts))}

    return (text_map(keyed_texts(docs), run, "doc_id long, score double")
            .select("doc_id", F.coalesce(~train_rows(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))
