"""Toxicity by the nearest labelled examples.

A bounded sample of labelled documents, without near copies, is the index. An example is the TF-IDF vector of all its words,
with document frequencies of the whole corpus; words that are clearly commoner in toxic examples, the terms, weigh more. The
nearest examples by exact cosine vote, closer ones with more weight, and the vote is calibrated on the examples themselves,
each left out once.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections import Counter
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.llm.neighbours import Index

#: At most so many toxic and clean examples, drawn by hash.
TOXIC_EXAMPLES, CLEAN_EXAMPLES = 3_000, 6_000
#: A term has at least this log-likelihood ratio (about one in a million by chance) and is in so many times as large a
#: share of the toxic examples. Its weight is multiplied by EMPHASIS.
LIKELIHOOD, LIFT, EMPHASIS = 24.0, 4.0, 3.0
#: Examples of a label whose sets of words have this Jaccard similarity are copies of one.
NEAR_COPY = 0.8
K = 10
#: Added to 1 - cosine before its inverse is taken as a vote's weight.
SOFTEN = 0.1
THRESHOLD = 0.5
_PUNCTUATION = bytes(i for i in range(33, 127) if not chr(i).isalnum())
_SPACED = bytes.maketrans(_PUNCTUATION, b" " * len(_PUNCTUATION))
#: Texts whose neighbours a worker remembers, texts searched together, and rows and characters taken up at a time.
CACHED, GROUP, ROWS, CHARS = 50_000, 32, 512, 2_000_000


def _spaced(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace").translate(_SPACED)


def tokens(text: str) -> list[bytes]:
    """Lower-case words without ASCII punctuation."""
    return _spaced(text).split()


def _entries(texts: list[str], place: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The entries of texts, ordered by text and place: the number of the text, the place of one of its tokens(), and how often it
    has that. Words without a place have no entry. Each different word of the texts is looked up once."""
    lists = pc.ascii_split_whitespace(pa.array(map(_spaced, texts), pa.large_binary(), size=len(texts)).cast(pa.large_string()))
    coded = lists.flatten().dictionary_encode()
    words = pa.LargeListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary.cast(pa.large_binary()))
    different = pc.binary_join(words, pa.scalar(b"\n", pa.large_binary()))[0].as_py().split(b"\n")   # far faster than a value at a time
    found = np.fromiter(map(place.get, different, repeat(-1)), np.int64, len(different))
    places = found[coded.indices.to_numpy()]
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy())[places >= 0]
    keys, number = np.unique(owner * max(1, len(place)) + places[places >= 0], return_counts=True)
    owner, places = np.divmod(keys, max(1, len(place)))
    return owner, places, number


def _portions(column: pa.Array):
    """The texts of a column, a null as an empty one, in lists of at most ROWS, and of CHARS characters but for the last text."""
    texts, size = [], 0
    for value in column:
        texts.append(value.as_py() or "")
        size += len(texts[-1])
        if len(texts) == ROWS or size >= CHARS:
            yield texts
            texts, size = [], 0
    if texts:
        yield texts


@dataclass
class Model:
    terms: list[bytes]
    words: bytes                                            # of the vectors, with spaces between
    idf: np.ndarray                                         # of each word, times EMPHASIS for terms
    example_ids: list
    example_labels: list[int]
    examples: np.ndarray                                    # an entry per example and word: its example,
    places: np.ndarray                                      # its word
    values: np.ndarray                                      # and its weight
    weights: tuple[float, float, float] = (0.0, 0.0, 0.0)   # bias, vote, closeness
    unseen: float = 0.5                                     # score of a document without neighbours
    _index: Index | None = field(default=None, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_index": None, "_place": None, "_seen": None}

    def index(self) -> Index:
        if self._index is None:
            self._place, self._seen = {t: i for i, t in enumerate(self.words.split())}, {}
            self._index = Index.of(self.examples, self.places, self.values, len(self.example_ids), len(self._place))
        return self._index

    def vote(self, near: list[tuple[int, float]]) -> tuple[float, float]:
        """Share of toxic among the neighbours, by inverse distance, and the best cosine."""
        share = [1 / (1 - min(1.0, c) + SOFTEN) for _, c in near]
        toxic = sum(w for w, (i, _) in zip(share, near) if self.example_labels[i])
        return toxic / sum(share), near[0][1]

    def judge(self, text: str) -> tuple[float, list[tuple[int, float]]]:
        """Score and neighbours of a text."""
        return self.judge_all([text])[0]

    def judge_all(self, texts: list[str]) -> list[tuple[float, list[tuple[int, float]]]]:
        """judge() of several texts, searched in groups; a text that comes again is not searched again."""
        index = self.index()
        keys = [hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=16).digest() for text in texts]
        if len(self._seen) + len(texts) > CACHED:
            self._seen.clear()
        new = {key: text for key, text in zip(keys, texts) if key not in self._seen}
        todo = list(new.items())
        queries = self._queries([text for _, text in todo])
        for at in range(0, len(todo), GROUP):
            group = todo[at:at + GROUP]
            for (key, _), near in zip(group, index.search_all(queries[at:at + GROUP], K)):
                score = self.unseen
                if near:
                    vote, close = self.vote(near)
                    score = _logistic(self.weights[0] + self.weights[1] * vote + self.weights[2] * close)
                self._seen[key] = (score, near)
        return [self._seen[key] for key in keys]

    def _queries(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text the places of its words in the vocabulary, in order, and their weights."""
        owner, places, number = _entries(texts, self._place)
        weights = _unit(number, self.idf[places], owner)
        ends = np.searchsorted(owner, np.arange(len(texts) + 1))
        return [(places[a:b], weights[a:b]) for a, b in zip(ends[:-1], ends[1:])]


def _unit(number: np.ndarray, idf: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """TF-IDF weights of the entries of vectors of length 1; `vector` tells whose each is."""
    raw = (1 + np.log(number)) * idf
    return raw / np.sqrt(np.bincount(vector, raw * raw))[vector]


def _logistic(x: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def _calibrate(model: Model, share: dict[int, float], without: dict[int, int], prior: float) -> None:
    """Fits the logistic curve on left-one-out votes. share weighs the examples of a label up to all labelled documents;
    without counts the examples of a label that have no word in the index; prior is the share of toxic labels."""
    index, rows, labels = model.index(), [], []
    alone, size = dict(without), len(model.example_ids)
    ends = np.searchsorted(model.examples, np.arange(size + 1))
    own = lambda i: (model.places[ends[i]:ends[i + 1]], model.values[ends[i]:ends[i + 1]])
    for at in range(0, size, GROUP):
        group = range(at, min(at + GROUP, size))
        for i, near in zip(group, index.search_all([own(i) for i in group], K, list(group))):
            if near:
                rows.append((1.0, *model.vote(near)))
                labels.append(model.example_labels[i])
            else:
                alone[model.example_labels[i]] = alone.get(model.example_labels[i], 0) + 1
    toxic, clean = (alone.get(y, 0) * share.get(y, 1.0) for y in (1, 0))
    model.unseen = (toxic + prior) / (toxic + clean + 1.0)
    if not rows:
        return
    x, y = np.array(rows), np.array(labels, float)
    weight = np.array([share.get(int(v), 1.0) for v in y])
    beta, ridge = np.zeros(3), np.diag([1e-3, 1e-1, 1e-1])
    for _ in range(50):  # Newton's steps
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - ridge @ beta
        hessian = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge
        move = np.linalg.solve(hessian, gradient)
        beta += np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-9:
            break
    model.weights = tuple(beta.tolist())


def _bags(source):
    """(doc_id, label, text) batches to a row per document with its words and how often it has each."""
    for batch in source:
        found = [Counter(tokens(text.as_py() or "")) for text in batch.column(2)]
        words = pa.array([list(c) for c in found], pa.list_(pa.binary()))
        numbers = pa.array([list(c.values()) for c in found], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), words, numbers],
                                         names=["doc_id", "label", "at", "words", "numbers"])


def _without_copies(examples: np.ndarray, places: np.ndarray, labels: np.ndarray, n_words: int) -> np.ndarray:
    """Which examples stay: all but those that are a near copy of an earlier one that stays and has the same label."""
    size = len(labels)
    index = Index.of(examples, places, np.ones(len(places)), size, n_words)
    length = np.bincount(examples, minlength=size)
    ends = np.searchsorted(examples, np.arange(size + 1))
    stays = np.zeros(size, bool)
    for i in range(size):
        common = index.overlaps(places[ends[i]:ends[i + 1]])
        copy = stays & (labels == labels[i]) & (common >= NEAR_COPY * (length + length[i] - common)) & (common > 0)
        stays[i] = not copy.any()
    return stays


def _likelihood(a: np.ndarray, b: np.ndarray, toxic: int, clean: int) -> np.ndarray:
    """Log-likelihood ratio of words in `a` of the toxic and `b` of the clean examples."""
    part = lambda count, of: np.where(count > 0, count * np.log(np.maximum(count, 1) * (toxic + clean) / ((a + b) * float(of))), 0.0)
    return 2 * (part(a, toxic) + part(b, clean))


def train(docs: DataFrame, labels: DataFrame, learn_from: Column, doc_id: str = "doc_id", text: str = "text",
          label: str = "toxic", emphasis: float = EMPHASIS) -> Model:
    """The model from labelled documents for which learn_from (a condition on doc_id) holds.

    Every word of the examples is in the vectors; terms weigh `emphasis` times. Words that no example has are in no vector and do
    not count for its length. Only the sample of examples is bounded; document frequencies are counted over all documents.
    Repeated labels of an id count once (toxic if any says so), an empty table has no examples. Labels other than 0 and 1, and rows with
    nulls, are left out. Without examples of both labels every score is the same. The driver holds the entries of all
    examples.
    """
    known = (labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label"))
             .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & learn_from)
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    all_labelled = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    drawn = lambda y, n: known.filter(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    chosen = drawn(1, TOXIC_EXAMPLES).union(drawn(0, CLEAN_EXAMPLES))
    texts = (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter(F.col("text").isNotNull())
             .join(F.broadcast(chosen), "doc_id"))
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("label", T.IntegerType()),
                           T.StructField("at", T.LongType()), T.StructField("words", T.ArrayType(T.BinaryType())),
                           T.StructField("numbers", T.ArrayType(T.IntegerType()))])
    bags = texts.select("doc_id", "label", "text", F.xxhash64("text").alias("at")).mapInArrow(_bags, schema).toArrow()
    bags = bags.sort_by([("doc_id", "ascending"), ("at", "ascending")]).combine_chunks()
    ids, example_labels = bags["doc_id"].to_pylist(), bags["label"].to_numpy().astype(np.int64)
    if len(set(example_labels.tolist())) < 2:
        return Model([], b"", np.zeros(0), [], [], *[np.zeros(0, np.int64)] * 2, np.zeros(0),
                     unseen=0.5 if not all_labelled else float(example_labels.any()))

    lists = bags["words"].combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    coded = lists.flatten().dictionary_encode()
    ranked = pc.sort_indices(coded.dictionary)
    vocabulary = coded.dictionary.take(ranked).to_pylist()
    rank = np.empty(len(vocabulary), np.int64)
    rank[ranked.to_numpy()] = np.arange(len(vocabulary))
    places = rank[coded.indices.to_numpy()]
    examples = np.repeat(np.arange(len(ids)), pc.list_value_length(lists).to_numpy())
    numbers = pc.list_flatten(bags["numbers"]).to_numpy()
    order = np.lexsort((places, examples))
    places, examples, numbers = places[order], examples[order], numbers[order]

    stays = _without_copies(examples, places, example_labels, len(vocabulary))
    toxic, clean = (int((stays & (example_labels == y)).sum()) for y in (1, 0))
    a, b = (np.bincount(places[(stays & (example_labels == y))[examples]], minlength=len(vocabulary)) for y in (1, 0))
    is_term = (a + b > 0) & (a * clean >= LIFT * b * toxic)
    is_term[is_term] = _likelihood(a[is_term], b[is_term], toxic, clean) >= LIKELIHOOD

    used = a + b > 0
    entry = stays[examples] & used[places]
    examples, places, numbers = examples[entry], (np.cumsum(used) - 1)[places[entry]], numbers[entry]
    indexed, examples = np.unique(examples, return_inverse=True)
    terms = [vocabulary[i] for i in np.flatnonzero(is_term)]
    words = [vocabulary[i] for i in np.flatnonzero(used)]
    total, frequency = max(1, docs.count()), np.zeros(len(words))
    counted = document_frequencies(docs, text, words).toArrow()
    frequency[counted["term"].to_numpy()] = counted["n"].to_numpy()
    idf = (np.log((1 + total) / (1 + frequency)) + 1) * np.where(is_term[used], emphasis, 1.0)
    model = Model(terms, b" ".join(words), idf, [ids[i] for i in indexed], example_labels[indexed].tolist(),
                  examples.astype(np.int32), places.astype(np.int32), _unit(numbers, idf[places], examples))
    share = {y: all_labelled.get(y, 0) / n for y, n in ((1, toxic), (0, clean)) if n}
    without = {y: n - model.example_labels.count(y) for y, n in ((1, toxic), (0, clean))}
    _calibrate(model, share, without, all_labelled.get(1, 0) / sum(all_labelled.values()))
    return model


def document_frequencies(docs: DataFrame, text: str, vocabulary: list[bytes]) -> DataFrame:
    """term (its place in the vocabulary) and n, the documents of the whole table that hold it."""
    joined = b" ".join(vocabulary)

    def counts(source):
        place = {t: i for i, t in enumerate(joined.split())}
        total = np.zeros(len(place), np.int64)
        for batch in source:
            for texts in _portions(batch.column(0)):
                total += np.bincount(_entries(texts, place)[1], minlength=len(total))
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["term", "n"])

    return docs.select(text).mapInArrow(counts, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))


@functools.lru_cache(maxsize=1)
def _loaded(data: bytes) -> Model:
    import pickle

    return pickle.loads(data)


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score and evidence of each row: the nearest examples with their cosine and label.

    A null or empty text, and one without any word of the model, has no evidence and scores as such examples do. Repeated
    rows are scored each; a null id stays null; other columns are not read; very long texts are taken whole; an empty table
    gives an empty result.
    """
    import pickle

    data = pickle.dumps(model)
    kind = docs.schema[doc_id].dataType
    near = T.StructType([T.StructField("doc_id", T.StringType()), T.StructField("cosine", T.DoubleType()),
                         T.StructField("toxic", T.IntegerType())])
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("score", T.DoubleType(), False),
                           T.StructField("evidence", T.ArrayType(near), False)])

    def batches(source):
        known = _loaded(data)
        names, labels = np.array(list(map(str, known.example_ids)), object), np.array(known.example_labels, np.int32)
        for batch in source:
            judged = []
            for texts in _portions(batch.column(1)):
                judged += known.judge_all(texts)
            ends = np.zeros(len(judged) + 1, np.int32)
            np.cumsum([len(near) for _, near in judged], out=ends[1:])
            near = [one for _, found in judged for one in found]
            who = np.array([i for i, _ in near], np.int64)
            flat = pa.StructArray.from_arrays([pa.array(names[who], pa.string()), pa.array([c for _, c in near], pa.float64()),
                                               pa.array(labels[who], pa.int32())], names=["doc_id", "cosine", "toxic"])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s for s, _ in judged], pa.float64()),
                                              pa.ListArray.from_arrays(pa.array(ends), flat)], names=["doc_id", "score", "evidence"])

    return docs.select(docs[doc_id], docs[text]).mapInArrow(batches, schema)
