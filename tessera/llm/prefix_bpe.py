"""Byte-level BPE by prefix dynamic programming.

Byte pair merging has one result for each byte string, and that result holds for its prefixes:
if t1 ... tk encode a string, t1 ... tj encode their own bytes, and any two neighbours encode
theirs.  So each prefix of a piece has a *unique valid last token*: the token ``t`` ending there
for which the prefix before it ends in a token ``s`` such that merging the bytes of ``s`` and ``t``
gives back exactly (s, t).  ``PrefixTokens`` stores this token for every prefix:

* encoding walks the bytes once; the tokens that end at a byte come from an Aho-Corasick
  automaton over the vocabulary, pairs are judged once and remembered, and the tokens are read
  off backwards;
* appending bytes only adds entries, nothing is encoded again;
* an edit recomputes from its first byte until as many entries in a row as the longest token has
  bytes agree with the old ones behind the edit; from there the old entries hold.

``TextEncoder`` does the same for a whole text: it cuts the text with the splitting pattern,
encodes each match by itself (a match that is a token is that token), and cuts and encodes
again only near the end (append) or near an edit.

``encode_documents`` runs it over a table: one narrow Arrow pass, the vocabulary read once from
its file (a parameter) and broadcast, whose size the file bounds.  Matches repeat, so each task
remembers the ids of at most ``REMEMBERED`` short ones; longer ones are encoded as they come.

Defined results: a null text is empty (no tokens); a very long text is cut and encoded match by
match, ``AT_ONCE`` at a time; repeated rows and rows without doc_id keep a row each, in any order
the same ids; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from tessera.llm.common import keyed_texts, read_table, text_map

#: Matches that a task remembers, the longest remembered one, and matches of a long text held at once.
REMEMBERED, SHORT, AT_ONCE = 1 << 18, 64, 1 << 16


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """Token bytes -> rank of a file of base64 tokens and ranks, read by Spark."""
    rows = spark.read.text(path if "://" in path else f"file://{path}").collect()
    pairs = (r[0].split() for r in rows if r[0].strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


class Vocabulary:
    """The ranks, the automaton over their bytes, and the pairs judged so far."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = {r: t for t, r in ranks.items()}
        self.longest, self.above = max(map(len, ranks)), max(self.bytes) + 1
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.sizes = {r: len(t) for t, r in ranks.items()}
        self.pairs: dict[int, bool] = {}

    def merged(self, data: bytes) -> list[int]:
        """Tokens of a few bytes by merging the lowest-ranked neighbours, leftmost first."""
        rank, none = self.ranks.get, self.above
        parts = [data[i:i + 1] for i in range(len(data))]
        pairs = [rank(data[i:i + 2], none) for i in range(len(data) - 1)]
        while pairs and (low := min(pairs)) < none:
            at = pairs.index(low)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = rank(parts[at - 1] + parts[at], none)
            if at < len(pairs):
                pairs[at] = rank(parts[at] + parts[at + 1], none)
        return [self.ranks[p] for p in parts]

    def valid(self, before: int, token: int) -> bool:
        """Whether ``token`` may follow ``before`` (-1: the start); remembered in ``pairs``."""
        first, second = self.bytes.get(before, b""), self.bytes[token]
        if len(self.pairs) >= 4 * REMEMBERED:
            self.pairs.clear()
        # neighbours that are a token together are merged
        ok = first + second not in self.ranks if first else True
        ok = ok and self.merged(first + second) == ([before, token] if first else [token])
        self.pairs[before << 32 | token] = ok
        return ok


class PrefixTokens:
    """The unique valid last token of every prefix of a byte string."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary = vocabulary
        self.data = b""
        self.last: list[int] = []
        self.append(data)

    def _extend(self, stop_when=None) -> None:
        """Fill ``last`` up to the end of ``data``, or until ``stop_when(length)``."""
        v, last = self.vocabulary, self.last
        pairs, sizes = v.pairs, v.sizes
        # a token that ends behind the last entry starts less than the longest token before it
        base = max(0, len(last) - v.longest + 1)
        text = self.data[base:] if base else self.data
        at = len(last)
        for end, token in v.automaton.iter(text.decode("latin-1")):
            if end + base != at:        # filled already
                continue
            start = at - sizes[token]
            before = last[start] if start >= 0 else -1
            known = pairs.get(before << 32 | token)
            if v.valid(before, token) if known is None else known:
                last.append(token)
                at += 1
                if stop_when is not None and stop_when(at):
                    return

    def append(self, data: bytes) -> None:
        self.data += data
        self._extend()

    def replace(self, start: int, end: int, data: bytes) -> None:
        """Replace the bytes [start, end)."""
        old, grown = self.last, len(data) - (end - start)
        self.data = self.data[:start] + data + self.data[end:]
        self.last = old[:start]
        run = 0

        def settled(n: int) -> bool:
            nonlocal run
            run = run + 1 if n > start + len(data) and self.last[-1] == old[n - 1 - grown] else 0
            return run >= self.vocabulary.longest

        self._extend(settled)
        self.last += old[len(self.last) - grown:]

    def tokens(self) -> list[int]:
        out, at = [], len(self.last)
        while at:
            out.append(self.last[at - 1])
            at -= len(self.vocabulary.bytes[out[-1]])
        return out[::-1]


class TextEncoder:
    """Tokens of a text that grows and changes.  Every match of the pattern keeps the last tokens of
    its prefixes; only matches near a change are cut and encoded again."""

    def __init__(self, vocabulary: Vocabulary, pattern: str, text: str = ""):
        self.vocabulary = vocabulary
        self.pattern = regex.compile(pattern)
        self.text, self.starts, self.parts = "", [], []
        self.append(text)

    def _encode(self, piece: str, reuse: PrefixTokens | None = None) -> PrefixTokens:
        data = piece.encode()
        if reuse is not None and data.startswith(reuse.data):
            reuse.append(data[len(reuse.data):])
            return reuse
        return PrefixTokens(self.vocabulary, data)

    def append(self, text: str) -> None:
        """A match may change when text follows it, and so may the one before it (an apostrophe that
        becomes a contraction), no earlier one."""
        keep = max(0, len(self.starts) - 2)
        at = self.starts[keep] if keep < len(self.starts) else len(self.text)
        old = dict(zip(self.starts[keep:], self.parts[keep:], strict=True))
        del self.starts[keep:], self.parts[keep:]
        self.text += text
        for m in self.pattern.finditer(self.text, at):
            self.starts.append(m.start())
            self.parts.append(self._encode(m.group(), old.get(m.start())))

    def replace(self, start: int, end: int, text: str) -> None:
        """Replace the characters [start, end).  Cutting begins two matches before the edit and ends
        at the first cut behind it that the old text has too."""
        grown = len(text) - (end - start)
        first = max(0, np.searchsorted(self.starts, start, side="right") - 3)
        at = self.starts[first] if first < len(self.starts) else 0
        self.text = self.text[:start] + text + self.text[end:]
        old = {s + grown: k for k, s in enumerate(self.starts) if s >= end}
        edited = {s: self.parts[k] for k, s in enumerate(self.starts[first:], first) if s < end}
        starts, parts = self.starts[:first], self.parts[:first]
        for m in self.pattern.finditer(self.text, at):
            # a cut beyond the edit that was one before: the rest is cut alike
            if m.start() >= start + len(text) and m.start() in old:
                k = old[m.start()]
                self.starts = starts + [s + grown for s in self.starts[k:]]
                self.parts = parts + self.parts[k:]
                return
            starts.append(m.start())
            parts.append(self._edited(m.group(), edited.get(m.start())))
        self.starts, self.parts = starts, parts

    def _edited(self, piece: str, was: PrefixTokens | None) -> PrefixTokens:
        """The prefixes of a match that began here before: equal ends stay, the middle is replaced."""
        data = piece.encode()
        if was is None or len(data) < SHORT:
            return PrefixTokens(self.vocabulary, data)
        a, b = np.frombuffer(was.data, np.uint8), np.frombuffer(data, np.uint8)
        n = min(len(a), len(b))
        head = int(np.argmin(np.append(a[:n] == b[:n], False)))
        tail = min(int(np.argmin(np.append(a[::-1][:n] == b[::-1][:n], False))), n - head)
        was.replace(head, len(a) - tail, data[head:len(data) - tail])
        return was

    def tokens(self) -> list[int]:
        ranks = self.vocabulary.ranks
        out: list[int] = []
        for p in self.parts:
            whole = ranks.get(p.data)
            if whole is None:
                out += p.tokens()
            else:
                out.append(whole)
        return out


class Remembered(dict):
    """Match -> its ids as little-endian unsigned 32-bit integers.  When it is full, what was not
    asked for since it was last full goes."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.before: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        out = self.before.get(piece)
        if out is None:
            data = piece.encode()
            whole = self.vocabulary.ranks.get(data)
            ids = [whole] if whole is not None else PrefixTokens(self.vocabulary, data).tokens()
            out = struct.pack(f"<{len(ids)}I", *ids)
            if len(data) > SHORT:
                return out
        if len(self) >= REMEMBERED:
            self.before = dict(self)
            self.clear()
        self[piece] = out
        return out


class Codec:
    """Encodes whole texts and decodes ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.vocabulary = Vocabulary(ranks)
        self.pattern = regex.compile(pattern)
        self.ids = Remembered(self.vocabulary)

    def parts(self, text: str) -> Iterator[bytes]:
        """Ids of a text, ``AT_ONCE`` matches at a time."""
        found = (m.group() for m in self.pattern.finditer(text)) if len(text) > AT_ONCE else iter(self.pattern.findall(text))
        while some := list(itertools.islice(found, AT_ONCE)):
            yield b"".join(map(self.ids.__getitem__, some))

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(self.parts(text)), dtype="<u4")

    def decode(self, ids) -> bytes:
        return b"".join(map(self.vocabulary.bytes.__getitem__, ids))


_CODECS: dict[tuple, Codec] = {}


def codec_of(shared, key: tuple, pattern: str) -> Codec:
    """The codec of a Python worker, built once from the broadcast ranks."""
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(shared.value, pattern)
    return _CODECS[key]


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text (and ``ids`` if asked for)."""
    spark = docs.sparkSession
    ranks = read_ranks(spark, vocabulary)
    shared = spark.sparkContext.broadcast(ranks)
    key = (vocabulary, pattern, len(ranks), hash(frozenset(ranks.items())))

    def run(ids: list, texts: list[bytes]) -> dict:
        codec = codec_of(shared, key, pattern)
        out = {"doc_id": ids, "n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": []}
        for raw in texts:
            n, of_ids, of_text, held = 0, hashlib.sha256(), hashlib.sha256(), []
            for part in codec.parts(raw.decode()):
                tokens = np.frombuffer(part, dtype="<u4")
                n += len(tokens)
                of_ids.update(part)
                of_text.update(codec.decode(tokens.tolist()))
                if with_ids:
                    held.append(tokens)
            out["n_tokens"].append(n)
            out["ids_sha256"].append(of_ids.hexdigest())
            out["decoded_sha256"].append(of_text.hexdigest())
            out["ids"].append(np.concatenate(held).astype(np.int32) if held else np.empty(0, np.int32))
        return {k: pa.array(v, pa.list_(pa.int32())) if k == "ids" else v for k, v in out.items()}

    return text_map(keyed_texts(docs), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
                    + (", ids array<int>" if with_ids else ""))


def encode_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return encode_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                            public_tokenizers.PATTERN)
