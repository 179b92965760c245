"""Byte-level BPE encoding and decoding.

A text is cut by a pattern; each match is merged by itself. The bytes of a match are the leaves of a segment tree that
holds the rank of the pair each token forms with its right neighbour. The root's minimum is the next merge, the
leftmost leaf with that rank its place; a merge changes three leaves, each in logarithmic time.
"""

from __future__ import annotations

import base64
import functools
import re
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Above every rank: no pair.
NONE = 1 << 60
#: Children of a node of the segment tree.
FAN = 16
#: Matches kept with their tokens in a worker, and how long they may be.
CACHED, CACHED_LENGTH = 300_000, 64
#: Texts of characters below this (Latin letters) are split by the faster engine.
NEAR = 0x250
#: Characters from which matches are taken one by one, without a list of them.
LONG_TEXT = 4_000_000


def tokenizer_file(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Lines of base64 token and rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The tokens of one match."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n, rank = len(piece), ranks.get
    # levels[0] has the rank of the pair that starts at each byte; a node above has the least of its FAN children.
    levels = [[rank(piece[i:i + 2], NONE) for i in range(n - 1)] + [NONE]]
    while len(levels[-1]) > FAN:
        below = levels[-1]
        levels.append([min(below[i:i + FAN]) for i in range(0, len(below), FAN)])
    leaves, top = levels[0], levels[-1]
    after = list(range(1, n + 1))    # start of the next token
    before = list(range(-1, n))      # start of the previous one
    while (lowest := min(top)) < NONE:
        at = top.index(lowest)       # the leftmost at every level
        for below in levels[-2::-1]:
            at = below.index(lowest, at * FAN)
        gone = after[at]
        end = after[at] = after[gone]
        before[end] = at
        leaves[gone] = NONE
        leaves[at] = rank(piece[at:after[end]], NONE) if end < n else NONE
        left = before[at]
        if left >= 0:
            leaves[left] = rank(piece[left:end], NONE)
        changed = (gone, at, left)
        for below, above in zip(levels, levels[1:]):
            changed = {i // FAN for i in changed if i >= 0}
            for i in changed:
                above[i] = min(below[i * FAN:(i + 1) * FAN])
    out, at = [], 0
    while at < n:
        out.append(ranks[piece[at:after[at]]])
        at = after[at]
    return out


class _Pieces(dict):
    """Tokens by match, as the bytes of 32-bit numbers, worked out on first sight. When it is full it starts anew, and what is still used comes over."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.old = ranks, {}

    def __missing__(self, piece: str) -> bytes:
        tokens = self.old.get(piece) or array("i", merge(piece.encode(), self.ranks)).tobytes()
        if len(piece) <= CACHED_LENGTH:
            if len(self) >= CACHED:
                self.old = dict(self)
                self.clear()
            self[piece] = tokens
        return tokens


def _near_pattern(pattern: str) -> re.Pattern | None:
    """The pattern for the faster engine, which knows no categories: each as the characters below NEAR that it holds.
    None for a pattern with other escapes."""
    held = {c: "".join(re.escape(chr(i)) for i in range(NEAR) if regex.fullmatch(c, chr(i))) for c in (r"\p{L}", r"\p{N}", r"\s")}
    plain = pattern.replace(r"\S", f"[^{held[chr(92) + 's']}]")
    for negated in re.findall(r"\[\^[^\]]*\]", pattern):
        inner = negated
        for category, characters in held.items():
            inner = inner.replace(category, characters)
        plain = plain.replace(negated, inner)
    for category, characters in held.items():
        plain = plain.replace(category, f"[{characters}]")
    return None if r"\p" in plain else re.compile(plain)


class Encoder:
    def __init__(self, data: bytes, pattern: str):
        ranks = read_ranks(data)
        self.pieces, self.pattern = _Pieces(ranks), regex.compile(pattern)
        self.near, self.far = _near_pattern(pattern), re.compile(f"[^\x00-{chr(NEAR - 1)}]")

    def encode(self, text: str) -> np.ndarray:
        pattern = self.near if self.near and not self.far.search(text) else self.pattern
        if len(text) < LONG_TEXT:
            found = pattern.findall(text)
        else:
            found = (m.group() for m in pattern.finditer(text))
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, found)), np.int32)


@functools.lru_cache(maxsize=2)
def _encoder(data: bytes, pattern: str) -> Encoder:
    return Encoder(data, pattern)


@functools.lru_cache(maxsize=2)
def _tokens(data: bytes) -> list[bytes]:
    ranks = read_ranks(data)
    out = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


def encode(docs: DataFrame, text: str = "text", output: str = "ids", path: str | None = None,
           pattern: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """The rows of docs with `output`, the token ids of the text; `keep` names the columns to keep (all if not given).

    A null or empty text has no tokens. Special tokens are not known: their strings are ordinary text. A column that
    is already named as the output is replaced. Repeated rows are encoded each, very long texts whole; an empty table gives an
    empty result. `path` is read on the driver; its bytes travel with the tasks.
    """
    data = open(path or tokenizer_file(), "rb").read()
    pattern = pattern or split_pattern()
    kept = [c for c in (docs.columns if keep is None else keep) if c != output]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(output, T.ArrayType(T.IntegerType(), False), False)])
    carried = [c for c in kept if c != text]

    def batches(source):
        encoder = _encoder(data, pattern)
        for batch in source:
            ids = [encoder.encode(t.as_py() or "") for t in batch.column(text)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), _lists(ids)], names=[*kept, output])

    return docs.select(text, *carried).mapInArrow(batches, schema)


def decode(rows: DataFrame, ids: str = "ids", output: str = "decoded", path: str | None = None) -> DataFrame:
    """The rows with `output`, the bytes that the ids stand for. Null or no ids: no bytes. An unknown id raises."""
    data = open(path or tokenizer_file(), "rb").read()
    kept = [c for c in rows.columns if c != output]
    schema = T.StructType([rows.schema[c] for c in kept] + [T.StructField(output, T.BinaryType(), False)])

    def batches(source):
        token = _tokens(data).__getitem__
        for batch in source:
            column = batch.column(ids)
            texts = [b"".join(map(token, x.values.to_pylist())) if x.is_valid else b"" for x in column]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(texts, pa.binary())],
                                             names=[*kept, output])

    return rows.select(*kept).mapInArrow(batches, schema)


def round_trip(docs: DataFrame, text: str = "text", ids: str = "ids", decoded: str = "decoded", path: str | None = None,
               pattern: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """encode() and decode() in one pass: the rows of docs with the token ids and the bytes they stand for. The bytes come from
    the ids and the vocabulary alone, as in decode()."""
    data = open(path or tokenizer_file(), "rb").read()
    pattern = pattern or split_pattern()
    kept = [c for c in (docs.columns if keep is None else keep) if c not in (ids, decoded)]
    schema = T.StructType([docs.schema[c] for c in kept] + [
        T.StructField(ids, T.ArrayType(T.IntegerType(), False), False), T.StructField(decoded, T.BinaryType(), False)])

    def batches(source):
        encoder, token = _encoder(data, pattern), _tokens(data).__getitem__
        for batch in source:
            found = [encoder.encode(t.as_py() or "") for t in batch.column(text)]
            texts = [b"".join(map(token, x.tolist())) for x in found]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), _lists(found), pa.array(texts, pa.binary())],
                                             names=[*kept, ids, decoded])

    return docs.select(text, *[c for c in kept if c != text]).mapInArrow(batches, schema)


def _lists(found: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(found) + 1, np.int32)
    np.cumsum([len(x) for x in found], out=offsets[1:])
    flat = np.concatenate(found) if found else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
