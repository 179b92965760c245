"""Document quality from a conditional random field over lines.

Every line is good or bad; its own features and its neighbours' decide. A document's score is the mean of its lines'
forward-backward marginals, weighted by length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.llm import crf
from paylake.llm.common import staged

#: The model is fitted on at most so many labelled documents, cut into segments of so many lines, of which at most so
#: many are used; both are drawn by hash. A document gives at most DOC_SEGMENTS of them, a label at most LABEL_SHARE.
TRAIN_DOCS, SEGMENT_LINES, TRAIN_SEGMENTS, DOC_SEGMENTS, LABEL_SHARE = 4_000, 30, 2_500, 25, 0.75
THRESHOLD = 0.7
#: Characters of text that are turned into features at a time.
CHUNK = 2_000_000


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text falls into the part that no label is learnt from; a null id counts as empty."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts == part


def _segments(source):
    """(label, text, id) batches to (place, label, text_key, features): segments of a document's lines, features in one
    list. The place is the hash of the id and the segment's number; those with the least places are kept."""
    import xxhash

    for batch in source:
        places, labels, keys, rows = [], [], [], []
        for label, text, name in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
            lines = crf.lines_of(text.as_py() or "")
            features = crf.line_features(lines)
            drawn = sorted((xxhash.xxh3_64_intdigest(f"{at // SEGMENT_LINES} {name}".encode("utf-8", "replace")) >> 1, at)
                           for at in range(0, len(lines), SEGMENT_LINES))[:DOC_SEGMENTS]
            for place, at in drawn:
                places.append(place)
                labels.append(label)
                keys.append(xxhash.xxh3_128_digest("\n".join(lines[at:at + SEGMENT_LINES]).encode("utf-8", "replace")))
                rows.append(features[at:at + SEGMENT_LINES].ravel().tolist())
        yield pa.RecordBatch.from_arrays(
            [pa.array(places, pa.int64()), pa.array(labels, pa.int32()), pa.array(keys, pa.binary()),
             pa.array(rows, pa.list_(pa.float64()))], names=["place", "label", "text_key", "features"])


def train(docs: DataFrame, labels: DataFrame, learn_from: Column, doc_id: str = "doc_id", text: str = "text",
          label: str = "quality") -> crf.Model:
    """The model from labelled documents for which learn_from (a condition on doc_id) holds.

    Both steps of the sample are drawn by hash, so they do not depend on the order of rows. Segments of the same text and
    label count once. Without documents of both
    labels, as of an empty table, every score of a text with words is 0.5. Labels other than 0 and 1, and rows with nulls, are left out.
    """
    known = (labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label"))
             .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & learn_from)
             .groupBy("doc_id").agg(F.max("label").alias("label"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCS))
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(known), "doc_id")
    parts = texts.select("label", "text", F.col("doc_id").cast("string").alias("name")).mapInArrow(
        _segments, "place long, label int, text_key binary, features array<double>")
    once = staged(parts.groupBy("label", "text_key").agg(F.min(F.struct("place", "features")).alias("s"))
                  .select("label", "text_key", "s.place", "s.features"), "quality-segments")
    order = ["place", "label", "text_key"]
    of = lambda y: once.filter(F.col("label") == y).orderBy(*order).limit(int(TRAIN_SEGMENTS * LABEL_SHARE))
    sample = of(0).union(of(1)).orderBy(*order).limit(TRAIN_SEGMENTS).collect()
    return crf.fit([np.array(r.features).reshape(-1, len(crf.FEATURES)) for r in sample], [r.label for r in sample])


def _scores(model: crf.Model, texts: list[str]) -> list[float]:
    features, lengths = [], []
    for text in texts:
        lines = crf.lines_of(text)
        features.append(crf.line_features(lines))
        lengths.append(np.array([len(x) for x in lines], float))
    starts = np.concatenate([[0], np.cumsum([len(f) for f in features])]).astype(int)
    emissions = crf.with_neighbours(np.concatenate(features), starts[:-1]) @ model.weights
    out = []
    for length, begin, end in zip(lengths, starts[:-1], starts[1:]):
        out.append(float(length @ model.marginals(emissions[begin:end]) / length.sum()) if end > begin else 0.0)
    return out


def score(docs: DataFrame, model: crf.Model, text: str = "text", output: str = "score",
          keep: list[str] | None = None) -> DataFrame:
    """The rows of docs with `output`, between 0 and 1; `keep` names the columns to keep (all if not given).

    A text without a line that holds a word (null, empty, white space) scores 0. Repeated rows are scored each; a column
    already named as the output is replaced; a very long text is scored whole; an empty table gives an empty result.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c != output]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(output, T.DoubleType(), False)])

    def batches(source):
        for batch in source:
            found, chunk, size = [], [], 0
            for value in batch.column(text):
                chunk.append(value.as_py() or "")
                size += len(chunk[-1])
                if size > CHUNK:
                    found += _scores(model, chunk)
                    chunk, size = [], 0
            if chunk:
                found += _scores(model, chunk)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(found, pa.float64())],
                                             names=[*kept, output])

    return docs.select(text, *[c for c in kept if c != text]).mapInArrow(batches, schema)
