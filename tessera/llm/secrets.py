"""Secret scans: pattern matches plus assignment-aware lexing.

Three base patterns give spans of their own.  Beside them, texts are read as source or
configuration code: every ``name = value``, ``name: value``, ``"name": value`` or
``name := value`` becomes a pair of a name and an expression, which is a list of literals
and names joined by ``+`` or ``.``.  Each assignment is a node of a graph whose edges
lead to the literals of its expression and to the latest assignments of the names in it, so
constants are propagated through any chain (``a = "..."``, ``password = a``).  A literal is
scored by the most sensitive name that it reaches, times how much it looks like a
secret; a score of ``MIN_SCORE`` or more adds a span of kind ``literal``, unless a base
span covers it.

Spans are code points, end exclusive, of the whole match (base) or of the literal without
its quotes.  All scans take time in proportion to the text.

Defined results: a null text is empty; an empty text has no spans (``base_sha256`` is
the hash of the empty string); very long texts are scanned whole, in time proportional to their
length; spans that tie in their start come in the order of the kinds; repeated rows each give a
row; an empty table gives an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from tessera.llm.common import keyed_texts, pieces, text_map
from tessera.session import ship_package

KINDS = ("assign", "access", "hex", "literal")
MIN_SCORE = 0.5

# Fixed patterns of the base kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST = {"assign": 8, "access": 16, "hex": 32}

# Fixed word lists: parts of a name that tell a secret, with their weight, and parts that
# tell that the value only describes or points to one.
SENSITIVE = {"password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "secrets": 1.0,
             "token": 0.9, "credential": 1.0, "credentials": 1.0, "apikey": 1.0, "accesskey": 1.0, "privatekey": 1.0,
             "secretkey": 1.0, "authtoken": 1.0, "signature": 0.6, "auth": 0.6, "bearer": 0.9, "salt": 0.6}
KEY_OWNERS = {"api", "access", "private", "secret", "encryption", "signing", "master", "auth", "account", "client"}
HARMLESS = {"count", "counts", "length", "len", "max", "min", "num", "size", "limit", "name", "names", "id", "type", "file",
            "path", "url", "uri", "field", "hint", "label", "policy", "public", "format", "regex", "prompt", "ttl",
            "expiry", "expires", "hash", "index", "column"}
PLACEHOLDER = re.compile(r"^(?:x+|\*+|\.+|-+|changeme|change_me|example|sample|dummy|test|none|null|nil|true|false|"
                         r"undefined|your.*|<.*>|\$\{.*\}|\{\{.*\}\}|%.*%|\$\w+)$", re.IGNORECASE)

_SIGN = re.compile(r"[:=]")
_NAME_BEFORE = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_.-")
_VALUE = re.compile(r"""(?P<q>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`)|(?P<w>[^\s"'`,;(){}\[\]<>|+]+)""")
_NESTED = re.compile(r"[A-Za-z_][A-Za-z0-9_.-]*[:=]+[^:=]")
_JOIN = re.compile(r"[ \t]*(?:\+|\.(?=[ \t]*[\"'`]))[ \t]*")
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(?:\.[A-Za-z_][A-Za-z0-9_]*)*\Z", re.ASCII)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return out


def name_score(name: str) -> float:
    """How surely a value of this name is a secret, from the parts of the name."""
    parts = [p.lower() for p in _PART.findall(name)]
    score = max((SENSITIVE.get(p, 0.0) for p in parts), default=0.0)
    for a, b in zip(parts, parts[1:], strict=False):
        score = max(score, SENSITIVE.get(a + b, 0.0), 0.9 if b in ("key", "keys") and a in KEY_OWNERS else 0.0)
    return score * (0.3 if parts and parts[-1] in HARMLESS else 1.0)


def literal_score(value: str) -> float:
    """How much a literal looks like a secret: long enough, varied, no placeholder, no prose."""
    n = len(value)
    if n < 6 or PLACEHOLDER.match(value):
        return 0.0
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    score = min(1.0, 0.35 + entropy / 5) * (1.0 if n >= 8 else 0.7)
    return score * 0.4 ** value.count(" ")


def assignments(text: str) -> list[tuple[str, list[tuple[str, int, int, bool]]]]:
    """(name, operands) in order; an operand is (text, start, end, quoted)."""
    out = []
    done = 0
    for m in _SIGN.finditer(text):
        at = m.start()
        if at < done:
            continue
        stop, i = at, at - 1
        if text[at] == "=" and i >= 0 and text[i] in ":!<>=+":
            if text[i] != ":" and text[i] != "+":
                continue
            i -= 1
        while i >= 0 and text[i] in " \t":
            i -= 1
        if i >= 0 and text[i] in "\"'`]":
            i -= 1
            if i >= 0 and text[i] in "\"'`":
                i -= 1
        stop = i + 1
        while i >= done and text[i] in _NAME_BEFORE:
            i -= 1
        name = text[i + 1:stop].strip(".-")
        if not name or name[0].isdigit():
            continue
        p = at + 1
        while p < len(text) and text[p] in "=:>":
            p += 1
        if text.startswith("//", p):                  # an address, not an assignment
            continue
        operands = []
        while True:
            while p < len(text) and text[p] in " \t":
                p += 1
            v = _VALUE.match(text, p)
            if not v or operands and v.group("w") and _NESTED.match(v.group("w")):
                break                                 # what follows is an assignment of its own
            if v.group("q"):
                operands.append((v.group("q")[1:-1], v.start() + 1, v.end() - 1, True))
            else:
                operands.append((v.group("w"), v.start(), v.end(), False))
            p = v.end()
            more = _JOIN.match(text, p)
            if not more:
                break
            p = more.end()
        if operands:
            out.append((name, operands))
            done = operands[-1][2]                    # no part of an expression is read twice
    return out


def literal_spans(text: str) -> list[tuple[int, int, str]]:
    """Literals that reach a sensitive name."""
    pairs = assignments(text)
    if not pairs:
        return []
    latest: dict[str, int] = {}
    into: list[list[int]] = []              # assignments whose values flow into each one
    own: list[list[tuple[str, int, int]]] = []
    for k, (name, operands) in enumerate(pairs):
        flows, literals = [], []
        for value, start, end, quoted in operands:
            if not quoted and value in latest:
                flows.append(latest[value])
            elif quoted or not _IDENTIFIER.match(value) or any(c.isdigit() for c in value):
                literals.append((value, start, end))
        into.append(flows)
        own.append(literals)
        latest[name] = k
    worth = [name_score(name) for name, _ in pairs]
    for k in range(len(pairs) - 1, -1, -1):  # values flow from earlier assignments only
        for j in into[k]:
            worth[j] = max(worth[j], worth[k])
    return [(start, end, "literal") for k, literals in enumerate(own) if worth[k] > 0
            for value, start, end in literals if worth[k] * literal_score(value) >= MIN_SCORE]


def scan(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(base spans, all spans), each by start and then kind as listed."""
    rank = {k: i for i, k in enumerate(KINDS)}
    order = lambda s: (s[0], rank[s[2]], s[1])
    base = sorted(base_spans(text), key=order)
    extra = []
    if "=" in text or ":" in text:
        covers = sorted((s, e) for s, e, _ in base)
        furthest, i = 0, 0
        for s, e, k in sorted(set(literal_spans(text))):
            while i < len(covers) and covers[i][0] <= s:
                furthest = max(furthest, covers[i][1])
                i += 1
            if e > furthest:
                extra.append((s, e, k))
    return base, sorted(base + extra, key=order)


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_literal, base_sha256, spans of every document."""

    def run(ids, texts):
        out = {c: [] for c in ("n_assign", "n_access", "n_hex", "n_literal", "base_sha256", "spans")}
        for t in texts:
            base, spans = scan(t.decode("utf-8", "surrogatepass"))
            kinds = Counter(k for _, _, k in spans)
            for k in KINDS:
                out[f"n_{k}"].append(kinds[k])
            out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
            out["spans"].append(joined(spans))
        return {"doc_id": ids, **out}

    return text_map(keyed_texts(docs), run, "doc_id long, n_assign long, n_access long, n_hex long, n_literal long, "
                                            "base_sha256 string, spans string")


def redact(text: str) -> str:
    """The text with every span replaced by ``[secret]`` (overlapping spans by one)."""
    out, at = [], 0
    spans = sorted((s, e) for s, e, _ in scan(text)[1])
    i = 0
    while i < len(spans):
        s, e = spans[i]
        while i < len(spans) and spans[i][0] < e:
            e = max(e, spans[i][1])
            i += 1
        out += [text[at:s], "[secret]"]
        at = e
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame) -> DataFrame:
    """Pipeline stage: secrets are cut out of the texts and n_chars follows; no row goes.
    A null text stays null."""
    ship_package(docs.sparkSession)

    @arrow_udf(T.StringType())
    def cleaned(text: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([pa.nulls(len(text)), text], names=["i", "t"])
        parts = [pa.array([None if t is None else redact(t.decode()) for t in texts], pa.string()) for _, texts in pieces([batch])]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    out = docs.withColumn("text", cleaned(F.col("text").cast("string")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                             .otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out
