"""Token counts of a unigram vocabulary, without the tokens.

An Aho-Corasick automaton reports every vocabulary piece that ends at each character; dynamic programming keeps, per
character, the best score of a segmentation that ends there and its number of pieces. Ties go to the candidate that
starts first, as the tokenizers do that go by start and replace only for a better score.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SPACE = "▁"
#: An unknown character scores this much below the worst piece.
UNKNOWN_PENALTY = 10.0
CACHED, CACHED_LENGTH = 400_000, 64


def read_vocabulary(path: str) -> tuple[tuple[str, float], ...]:
    """Pieces and scores of a SentencePiece file; control, unknown and byte pieces never match text."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return tuple((model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())
                 if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)))


def vocabulary_file(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Counter:
    """Counts pieces of chunks. Chunks are parts of a text between which every segmentation has a border."""

    def __init__(self, vocabulary: tuple[tuple[str, float], ...], byte_fallback: bool):
        import ahocorasick

        self.automaton, self.byte_fallback, self.cache = ahocorasick.Automaton(), byte_fallback, {}
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), score))
        self.any = bool(vocabulary)
        self.automaton.make_automaton()
        self.unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        # Sums of whole numbers are exact, so the best of a text is the best of its chunks, ties included. Unknown
        # characters that fuse across a border could count once, so fusing also needs the text whole.
        exact = byte_fallback and all(float(s).is_integer() for _, s in vocabulary)
        inner = any(SPACE in p.lstrip(SPACE) for p, _ in vocabulary)
        line = "" if any("\n" in p for p, _ in vocabulary) else "\n"
        self.chunks = None
        if exact and not inner:
            self.chunks = re.compile(f"{SPACE}*[^{SPACE}{line}]+|{SPACE}+" + ("|\n" if line else "")).findall

    def count_chunk(self, chunk: str) -> int:
        n = len(chunk)
        best, count = [0.0] + [None] * n, [0] * (n + 1)
        fused = [False] * (n + 1)   # the best segmentation ends in an unknown piece
        ready = 0                   # ends up to here are settled

        def settle(end: int, single: bool) -> None:
            if single:
                return
            score = best[end - 1] + self.unknown
            if best[end] is None or score > best[end]:
                best[end] = score
                if self.byte_fallback:
                    count[end] = count[end - 1] + len(chunk[end - 1].encode())
                else:
                    count[end] = count[end - 1] + (not fused[end - 1])
                fused[end] = True

        single = False
        for last, (length, score) in (self.automaton.iter(chunk) if self.any else ()):
            end = last + 1
            while ready < last:
                ready += 1
                settle(ready, single)
                single = False
            score += best[end - length]
            if best[end] is None or score > best[end]:
                best[end], count[end], fused[end] = score, count[end - length] + 1, False
            single = single or length == 1
        while ready < n:
            ready += 1
            settle(ready, single)
            single = False
        return count[n]

    def count(self, text: str) -> int:
        if not text:
            return 0
        prepared = SPACE + text.replace(" ", SPACE)
        if self.chunks is None:
            return self.count_chunk(prepared)
        total, cache = 0, self.cache
        for chunk in self.chunks(prepared):
            found = cache.get(chunk)
            if found is None:
                found = self.count_chunk(chunk)
                if len(chunk) <= CACHED_LENGTH:
                    if len(cache) >= CACHED:
                        cache.clear()
                    cache[chunk] = found
            total += found
        return total


@functools.lru_cache(maxsize=2)
def _counter(vocabulary: tuple[tuple[str, float], ...], byte_fallback: bool) -> Counter:
    return Counter(vocabulary, byte_fallback)


def count_tokens(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 vocabulary: tuple[tuple[str, float], ...] | None = None, byte_fallback: bool = True) -> DataFrame:
    """doc_id and n_tokens of each row, under the best-scoring segmentation by the vocabulary.

    A space becomes the piece mark and one is put before the text; a null or empty text has 0 tokens. A character
    that no piece covers counts as its UTF-8 bytes, or, without byte_fallback, a run of them as one token. Repeated
    rows count each, a null id stays null, other columns are not read. The vocabulary (default: the pieces and scores
    of the installed 32,000-piece file) is read on the driver and travels with the tasks.
    """
    vocabulary = read_vocabulary(vocabulary_file()) if vocabulary is None else vocabulary
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("n_tokens", T.LongType(), False)])

    def batches(source):
        counter = _counter(vocabulary, byte_fallback)
        for batch in source:
            counts = np.fromiter((counter.count(t.as_py() or "") for t in batch.column(1)), np.int64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts)], names=["doc_id", "n_tokens"])

    return docs.select(docs[doc_id], docs[text]).mapInArrow(batches, schema)
