"""Personal data by weak supervision.

Every text is searched once for candidates: the four base kinds (email, ip, card, phone) and
looser kinds that may or may not be personal data (addresses written with "at", local
phone numbers, social security numbers, long digit runs, names).  Labelers vote on each
candidate: yes, no or nothing.

* regex: the strict form of the kind; * checksum: Luhn digits and number ranges;
* gazetteer: first names, titles, common top-level domains, card prefixes, private networks;
* cue: words nearby that announce personal data; * anti: words nearby that announce order
  numbers, versions and the like; * variety: all-equal or counting digits speak against.

The votes are pooled into counts of vote patterns, counted by Spark over all candidates of
all documents (there are at most KINDS * 3^labelers * lengths patterns).  Expectation
maximisation on these counts estimates how reliable each labeler is for each class
(abstaining included) and the share of personal data of each kind; a logistic span
classifier is then fitted to the posteriors, on kind, votes and length.  Base spans always
stay; other candidates stay when the classifier gives ``KEEP`` or more and no base span
overlaps them.

Candidates are written once to the shared folder (they hold no text); texts are read once
and never shuffled.

Defined results: a null text is empty; an empty text has no spans (``base_sha256`` is the
hash of the empty string); repeated rows each give a row; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import keyed_texts, text_map
from tessera.operators.sizing import materialise

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "mail_at", "local_phone", "ssn", "number", "name")
LABELERS = ("regex", "checksum", "gazetteer", "cue", "anti", "variety")
KEEP = 0.5
LENGTHS = 4
#: Code points on either side of a candidate in which cue words are looked for.
NEAR = 40

# Fixed patterns.  Runs are possessive or bounded, so a search takes linear time.
LOCAL_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
AT = re.compile(r"[\[({]\x20?(?:at|AT)\x20?[\])}]")
AT_DOMAIN = re.compile(r"\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:\.|[\[({]\x20?(?:dot|DOT)\x20?[\])}])\x20?[A-Za-z0-9-]{2,63}){1,4}")
LOCAL_PHONE = re.compile(r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
NAME = re.compile(r"\b(Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Monsieur|Madame|Sr|Sra|Don)\.?\x20([A-Z][\w'-]{1,30}(?:\x20[A-Z][\w'-]{1,30})?)")

# Fixed word lists of the gazetteer and context labelers.
DOMAINS = {"com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu", "it", "nl", "ch", "at"}
FIRST_NAMES = {"james", "john", "robert", "michael", "william", "david", "mary", "linda", "anna", "maria", "peter", "paul",
               "hans", "jean", "pierre", "marie", "carlos", "jose", "juan", "luis", "laura", "sarah", "emma", "thomas"}
CUES = {"email", "mail", "contact", "phone", "tel", "telephone", "call", "mobile", "fax", "address", "card", "visa",
        "mastercard", "ssn", "social", "security", "ip", "host", "name", "telefon", "anruf", "correo", "telefono",
        "courriel", "carte", "karte"}
ANTI = {"order", "invoice", "version", "isbn", "issn", "sku", "serial", "build", "release", "ticket", "ref", "part",
        "model", "doi", "page", "id", "rfc", "chapter", "section"}
_WORD = re.compile(r"[^\W\d_]{2,20}")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local@domain: from each @ to the left as far as local-part
    characters reach, not into the match before."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        m = DOMAIN.match(text, at + 1)
        start = done + len(text[done:at].rstrip(LOCAL_CHARS)) if m else at
        done = max(done, at + 1)
        if start < at:
            out.append((start, m.end()))
            done = m.end()
        at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[tuple[int, int, str]]:
    out = [(s, e, "email") for s, e in emails(text)]
    out += [(m.start(), m.end(), "ip") for m in IP.finditer(text)
            if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m.group().split("."))]
    for m in CARD.finditer(text):
        if 12 <= m.end() - m.start() <= 38:
            digits = re.sub(r"[^0-9]", "", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), "card"))
    if "+" in text:
        out += [(m.start(), m.end(), "phone") for m in PHONE.finditer(text)
                if 9 <= sum(c in "0123456789" for c in m.group()) <= 15]
    return out


def loose_spans(text: str) -> list[tuple[int, int, str]]:
    """Candidates of the other kinds."""
    out = []
    for m in AT.finditer(text):
        head = text[max(0, m.start() - 65):m.start()].rstrip(" ")
        start = len(head.rstrip(LOCAL_CHARS))
        dom = AT_DOMAIN.match(text, m.end())
        if dom and start < len(head):
            out.append((max(0, m.start() - 65) + start, dom.end(), "mail_at"))
    out += [(m.start(), m.end(), "local_phone") for m in LOCAL_PHONE.finditer(text)]
    out += [(m.start(), m.end(), "ssn") for m in SSN.finditer(text)]
    out += [(m.start(), m.end(), "number") for m in re.finditer(r"(?<![0-9.])[0-9]{9,19}(?![0-9.])", text)]
    out += [(m.start(2), m.end(2), "name") for m in NAME.finditer(text)]
    return out


def votes(text: str, start: int, end: int, kind: str) -> tuple[int, ...]:
    """One vote of each labeler: 1 yes, -1 no, 0 nothing."""
    value = text[start:end]
    digits = "".join(c for c in value if c in "0123456789")
    around = {w.lower() for w in _WORD.findall(text[max(0, start - NEAR):start] + " " + text[end:end + NEAR])}
    regex = 1 if kind in BASE or kind in ("ssn", "local_phone") else 0
    checksum = 0
    if kind in ("card", "number"):
        checksum = 1 if 12 <= len(digits) <= 19 and luhn(digits) else -1
    elif kind == "ssn":
        checksum = -1 if digits[:3] in ("000", "666") or digits[0] == "9" or digits[3:5] == "00" or digits[5:] == "0000" else 1
    elif kind in ("phone", "local_phone"):
        checksum = 1 if 10 <= len(digits) <= 13 else 0
    gazetteer = 0
    if kind in ("email", "mail_at"):
        gazetteer = 1 if re.split(r"[^a-z]+", value.lower().rstrip("])} "))[-1] in DOMAINS else -1
    elif kind == "ip":
        gazetteer = -1 if re.match(r"0\.|127\.|255\.", value) else 1
    elif kind in ("card", "number"):
        gazetteer = 1 if digits[:1] in ("3", "4", "5", "6") else -1
    elif kind == "name":
        gazetteer = 1 if any(w.lower() in FIRST_NAMES for w in value.split()) else 0
    steps = {(ord(b) - ord(a)) % 10 for a, b in zip(digits, digits[1:], strict=False)}
    variety = (-1 if len(digits) > 3 and len(steps) == 1 else 1 if len(set(digits)) >= 4 else 0) if digits else 0
    return regex, checksum, gazetteer, 1 if around & CUES else 0, -1 if around & ANTI else 0, variety


def pattern(kind: str, vote: tuple[int, ...], length: int) -> int:
    """Kind, votes and length class as one number below patterns()."""
    code = KINDS.index(kind)
    for v in vote:
        code = code * 3 + v + 1
    return code * LENGTHS + (length > 8) + (length > 14) + (length > 24)


def patterns() -> int:
    return len(KINDS) * 3 ** len(LABELERS) * LENGTHS


def unpack(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(kind, votes, length class) of pattern numbers."""
    length, rest = codes % LENGTHS, codes // LENGTHS
    vote = np.zeros((len(codes), len(LABELERS)), dtype=np.int64)
    for j in range(len(LABELERS) - 1, -1, -1):
        vote[:, j], rest = rest % 3 - 1, rest // 3
    return rest, vote, length


def reliabilities(codes: np.ndarray, count: np.ndarray, rounds: int = 200):
    """Expectation maximisation over vote patterns: (posterior of each pattern, chance of each
    vote given the class, share of each kind).  Starts from the majority of the votes."""
    kind, vote, _ = unpack(codes)
    post = np.clip(0.5 + 0.15 * vote.sum(axis=1), 0.05, 0.95)
    for _ in range(rounds):
        weight = np.stack([count * (1 - post), count * post])
        table = np.ones((2, len(LABELERS), 3))
        for j in range(len(LABELERS)):
            for c in range(2):
                table[c, j] += np.bincount(vote[:, j] + 1, weights=weight[c], minlength=3)
        # a yes counts for the class at least as much as against it, so the classes keep their meaning
        table /= table.sum(axis=2, keepdims=True)
        share = (np.bincount(kind, weights=weight[1], minlength=len(KINDS)) + 1) / \
                (np.bincount(kind, weights=count, minlength=len(KINDS)) + 2)
        logit = np.log(share[kind]) - np.log(1 - share[kind])
        for j in range(len(LABELERS)):
            ratio = np.log(table[1, j]) - np.log(table[0, j])
            ratio[2], ratio[0] = max(ratio[2], 0), min(ratio[0], 0)
            logit = logit + ratio[vote[:, j] + 1]
        new = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        if np.abs(new - post).max() < 1e-6:
            break
        post = new
    return post, table, share


def classifier(codes: np.ndarray, count: np.ndarray, post: np.ndarray) -> np.ndarray:
    """Logistic span classifier fitted to the posteriors: probability of every pattern."""

    def design(c):
        kind, vote, length = unpack(c)
        return np.column_stack([np.eye(len(KINDS))[kind], vote == 1, vote == -1, np.eye(LENGTHS)[length]]).astype(float)

    w = np.zeros(design(codes[:1]).shape[1] if len(codes) else 1)
    every = np.arange(patterns())
    if not len(codes):
        return np.zeros(len(every))
    x, n = design(codes), count / count.sum() * max(1.0, min(count.sum(), 1e4))
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        move = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(w)),
                               x.T @ (n * (p - post)) + 0.05 * w)
        w -= np.clip(move, -3, 3)
        if np.abs(move).max() < 1e-8:
            break
    return 1 / (1 + np.exp(-design(every) @ w))


def joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def ordered(spans):
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, base spans and loose candidates with their patterns, one row per document."""

    def run(ids, texts):
        base, base_codes, loose, codes = [], [], [], []
        for t in texts:
            text = t.decode("utf-8", "surrogatepass")
            own = ordered(base_spans(text))
            code = lambda s: pattern(s[2], votes(text, *s), s[1] - s[0])  # noqa: B023, E731
            covers, more, at, i = sorted((s, e) for s, e, _ in own), [], 0, 0
            for s in ordered(set(loose_spans(text))):
                while i < len(covers) and covers[i][0] < s[1]:
                    at, i = max(at, covers[i][1]), i + 1
                if at <= s[0]:
                    more.append(s)
            base.append(joined(own))
            base_codes.append([code(s) for s in own])
            loose.append([f"{k}:{s}:{e}" for s, e, k in more])
            codes.append([code(s) for s in more])
        return {"doc_id": ids, "base": base, "base_codes": base_codes, "loose": loose, "codes": codes}

    return text_map(docs, run, "doc_id long, base string, base_codes array<int>, loose array<string>, codes array<int>")


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, n_<kind>, base_sha256, spans of every document."""
    spark = docs.sparkSession
    found = materialise(candidates(keyed_texts(docs)), "pii-candidates", measure=False).df
    rows = (found.select(F.explode(F.concat("base_codes", "codes")).alias("code")).groupBy("code").count()
            .orderBy("code").collect())                   # at most patterns() rows
    codes, count = np.array([r[0] for r in rows], dtype=np.int64), np.array([r[1] for r in rows], dtype=float)
    post, _, _ = reliabilities(codes, count) if len(codes) else (np.zeros(0), None, None)
    good = spark.sparkContext.broadcast(classifier(codes, count, post) >= KEEP)
    arrow = [pa.field("doc_id", pa.int64()), *[pa.field(f"n_{k}", pa.int64()) for k in KINDS],
             pa.field("base_sha256", pa.string()), pa.field("spans", pa.string())]

    def run(batches):
        for b in batches:
            cols = {f.name: [] for f in arrow}
            for r in b.to_pylist():
                spans = [(int(s), int(e), k) for k, s, e in (x.split(":") for x in r["base"].split(",") if x)]
                extra = [x for x, c in zip(r["loose"], r["codes"], strict=True) if good.value[c]]
                spans += [(int(s), int(e), k) for k, s, e in (x.split(":") for x in extra)]
                cols["doc_id"].append(r["doc_id"])
                for k in KINDS:
                    cols[f"n_{k}"].append(sum(s[2] == k for s in spans))
                cols["base_sha256"].append(hashlib.sha256(r["base"].encode()).hexdigest())
                cols["spans"].append(joined(ordered(spans)))
            yield pa.RecordBatch.from_pydict(cols, schema=pa.schema(arrow))

    ddl = ", ".join(["doc_id long", *[f"n_{k} long" for k in KINDS], "base_sha256 string", "spans string"])
    return found.mapInArrow(run, ddl)
