"""The two classifiers, exact search and the pipeline."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from paylake.llm import crf, neighbours, quality_classifier, queries, topk, toxicity

FOLDER = "/root/testdata/sf0.001"


# --- quality ---

def test_marginals_equal_enumeration():
    pick = np.random.default_rng(1)
    for n in range(1, 7):
        emissions, transitions = pick.normal(0, 2, n), pick.normal(0, 1, (2, 2))
        weight = np.zeros(n)
        total = 0.0
        for code in range(2 ** n):
            y = [code >> i & 1 for i in range(n)]
            w = np.exp(sum(emissions[i] * y[i] for i in range(n)) + sum(transitions[y[i], y[i + 1]] for i in range(n - 1)))
            total += w
            weight += w * np.array(y)
        assert crf.Model(np.zeros(1), transitions).marginals(emissions) == pytest.approx(weight / total)


def test_training_raises_the_likelihood():
    pick = np.random.default_rng(2)
    d = len(crf.FEATURES)
    labels = [i % 2 for i in range(60)]
    segments = [np.clip(pick.normal(0.3 + 0.3 * y, 0.2, (1 + i % 5, d)), 0, 1) for i, y in enumerate(labels)]
    model = crf.fit(segments, labels)
    right = sum((model.marginals(crf.with_neighbours(s, np.zeros(1, int)) @ model.weights).mean() > 0.5) == y
                for s, y in zip(segments, labels))
    assert right > 55
    assert not crf.fit(segments[:1], [1]).weights.any() and not crf.fit([], []).weights.any()


def test_quality_scores_of_odd_texts(spark):
    texts = [None, "", "  \n ", "ok", "a\n\nb", "x" * 300_000, "line\n" * 3000]
    model = crf.fit([crf.line_features(["good words here."]), crf.line_features(["!!! ###"])], [1, 0])
    df = spark.createDataFrame([(i, t, 9.0) for i, t in enumerate(texts)] + [(None, "ok", 9.0)], "doc_id long, text string, score double")
    out = {r.doc_id: r.score for r in quality_classifier.score(df, model).collect()}
    assert len(out) == 8 and out[0] == out[1] == out[2] == 0.0 and all(0 <= s <= 1 for s in out.values())
    assert quality_classifier.score(df.limit(0), model).columns == ["doc_id", "text", "score"]


def test_no_labels_no_opinion(spark):
    df = spark.createDataFrame([(1, "a b", 1)], "doc_id long, text string, quality int")
    empty = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    learn = F.lit(True)
    assert quality_classifier.score(df, quality_classifier.train(df, empty, learn)).first().score == 0.5
    assert toxicity.score(df, toxicity.train(df, empty, learn)).first().score == 0.5


def accuracy(spark, name, label, parts, part):
    out = contract.queries()[name](spark, "/root/testdata/sf0.01")
    assert out.count() == 1000 and out.filter("score < 0 OR score > 1").count() == 0
    for r in out.limit(50).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % parts == part)
    return out.join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").filter("held_out") \
        .agg(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0]


def test_held_out_quality(spark):
    assert accuracy(spark, "op1_quality_classifier", "quality", 4, 2) > 0.95


def test_copies_and_long_documents_do_not_fill_the_sample(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(quality_classifier, "TRAIN_SEGMENTS", 100)
    monkeypatch.setattr(quality_classifier.crf, "fit", lambda segments, labels: taken.extend(zip(labels, segments)))
    long = "\n".join(f"line {i} of a long text" for i in range(30_000))          # 1,000 segments
    rows = [(0, long)] + [(1 + i, "one text, many times") for i in range(300)] + [(1000 + i, f"text {'x' * i} alone") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") < 1000).cast("int").alias("quality"))
    quality_classifier.train(docs, labels, F.lit(True))
    assert len(taken) == 100 and sum(y == 1 for y, _ in taken) in (25, 26)
    assert sum(y == 1 and len(x) == 1 for y, x in taken) <= 1


# --- toxicity ---

def test_held_out_toxicity(spark):
    assert accuracy(spark, "op8_toxicity", "toxic", 5, 0) > 0.9


@pytest.mark.parametrize("block,frequent,rare", [(64, 1 / 10, 1 / 100), (7, 1 / 8, 1 / 20), (16, 1.0, 0.0), (500, 0.0, 1.0)])
def test_neighbours_equal_brute_force(monkeypatch, block, frequent, rare):
    pick = random.Random(5)
    vectors = []
    for _ in range(500):
        raw = {t: pick.random() for t in pick.sample(range(30), pick.randrange(1, 6))}
        norm = sum(w * w for w in raw.values()) ** 0.5
        vectors.append({t: w / norm for t, w in raw.items()})
    vectors += vectors[:20]   # ties
    for name, value in {"BLOCK": block, "RARE": rare, "FREQUENT": frequent}.items():
        monkeypatch.setattr(neighbours, name, value)
    index = neighbours.Index(vectors, 31)
    for i in range(0, 520, 7):
        query = dict(sorted(vectors[i].items()))
        cosine = [sum(w * v.get(t, 0) for t, w in query.items()) for v in vectors]
        expected = sorted((j for j in range(520) if cosine[j] > 0 and j != i), key=lambda j: (-round(cosine[j], 12), j))[:10]
        got = index.nearest(query, 10, but=i)
        assert [round(c, 12) for _, c in got] == [round(cosine[j], 12) for j in expected]
    together = index.search_all([(np.array(sorted(v)), np.array([v[t] for t in sorted(v)])) for v in vectors[:50]], 10)
    plain = lambda found: [(j, round(c, 9)) for j, c in found]
    assert list(map(plain, together)) == [plain(index.nearest(dict(sorted(v.items())), 10)) for v in vectors[:50]]
    assert index.nearest({30: 1.0}, 10) == [] and neighbours.Index([], 0).nearest({}, 3) == []


def test_toxicity_evidence_and_copies(spark):
    pick = random.Random(1)
    word = lambda: "".join(pick.choices("abcdefghijk", k=5))
    rows, labels = [], []
    for i in range(300):
        words = [word() for _ in range(20)]
        if i % 4 == 0:
            for w in pick.sample(["vile", "foul", "nasty"], 2):
                words.insert(pick.randrange(20), w)
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    copy = " ".join(word() for _ in range(20))
    rows += [(1000 + i, copy + f" x{i}") for i in range(40)]    # copies that happen to be labelled toxic
    labels += [(1000 + i, 1) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True))
    assert sorted(model.terms) == [b"foul", b"nasty", b"vile"]
    probe = spark.createDataFrame([(1, "so Vile, and foul!", 0.0), (2, copy, 0.0), (3, None, 0.0), (None, "", 0.0), (1, "so Vile, and foul!", 0.0)],
                                  "doc_id long, text string, score double")
    out = toxicity.score(probe, model).collect()
    assert len(out) == 5 and out[0] == out[4]
    assert out[0].score > 0.9 and len(out[0].evidence) == 10 and all(e.toxic for e in out[0].evidence)
    assert sum(e.cosine > 0.8 for e in out[1].evidence) == 1       # 40 copies are one example
    assert out[2].evidence == out[3].evidence == [] and out[2].score == out[3].score < 0.5
    nothing = spark.createDataFrame([], "doc_id long, text string")
    assert toxicity.score(nothing, model).collect() == []
    blank = toxicity.train(nothing, spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True))
    assert len({r.score for r in toxicity.score(probe, blank).collect()}) == 1
    long = spark.createDataFrame([(1, "so Vile, and foul! " * 50_000)], "doc_id long, text string")
    assert toxicity.score(long, model).first().score > 0.5


def test_all_words_find_the_nearest_examples(spark):
    pick = random.Random(7)
    pool = ["".join(pick.choices("abcdefgh", k=4)) for _ in range(300)]
    rows = [(i, " ".join(pick.choices(pool, k=25) + (["so", "vile"] if i % 4 == 0 else []))) for i in range(200)]
    rows += [(1000 + i, rows[4][1] + f" x{i}") for i in range(30)]    # near copies of a toxic example
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0 or i >= 1000)) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, F.lit(True))
    assert set(model.example_ids) == set(range(200))       # clean ones too, copies once
    assert set(model.terms) == {b"so", b"vile"}            # always after the same word, yet terms
    counts, frequency = {}, {}
    for i, t in rows:
        counts[i] = {w: t.split().count(w) for w in t.split()}
        for w in counts[i]:
            frequency[w] = frequency.get(w, 0) + 1

    def vector(count):
        raw = {w: (1 + np.log(n)) * (np.log((1 + len(rows)) / (1 + frequency[w])) + 1) * (3 if w in ("so", "vile") else 1)
               for w, n in count.items() if w in known}
        return {w: x / sum(y * y for y in raw.values()) ** 0.5 for w, x in raw.items()}

    known = {w for i in range(200) for w in counts[i]}
    vectors = {i: vector(counts[i]) for i in range(200)}
    for r in toxicity.score(docs.filter("doc_id < 40 OR doc_id >= 1000"), model).collect():
        query = vector(counts[r.doc_id])
        cosine = sorted((round(sum(x * v.get(w, 0) for w, x in query.items()), 9) for v in vectors.values()), reverse=True)
        assert [round(e.cosine, 9) for e in r.evidence] == cosine[:10]
        assert all(round(sum(x * vectors[int(e.doc_id)].get(w, 0) for w, x in query.items()), 9) == round(e.cosine, 9) for e in r.evidence)
    empty = toxicity.score(spark.createDataFrame([(1, None), (2, ""), (3, "zzzz")], "doc_id long, text string"), model).collect()
    assert len({r.score for r in empty}) == 1 and empty[0].score < 0.5 and not any(r.evidence for r in empty)


# --- exact search ---

def plain_search(rows, k):
    floor = lambda v: [int(np.floor(256 * np.float64(x))) for x in v]
    usable = [(i, floor(v)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    queries_ = {}
    for i, v in usable:
        if i % 50 == 0:
            queries_[i] = min(v, queries_.get(i, v))
    for q, v in queries_.items():
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("block,kind", [(4096, "float"), (30, "float"), (30, "double")])
def test_search_equals_brute_force(spark, block, kind):
    pick = random.Random(block)
    rows = [(i, [pick.choice([0.0, 0.5, pick.uniform(-1, 1)]) for _ in range(8)]) for i in range(260)]
    rows += [(300 + i, rows[50][1]) for i in range(30)]           # ties
    rows += [(350, [0.0] * 8), (400, [1.0]), (401, []), (402, None), (403, [None] * 8), (404, [float("nan")] * 8),
             (405, [float("inf")] * 8), (None, [1.0] * 8), (100, [0.25] * 8)]
    if kind == "double":
        rows += [(450, [3e12] * 8), (451, [-3e12, 1e-300] * 4)]    # products beyond exact doubles
    df = spark.createDataFrame([(*r, 1) for r in rows], f"vec_id long, embedding array<{kind}>, score int")
    out = topk.search(df, F.col("vec_id") % 50 == 0, block=block, query_block=3).collect()
    expected = plain_search(rows, 5)
    clamp = lambda s: max(-2 ** 63, min(2 ** 63 - 1, s))
    if kind == "double":   # scores that stop at the ends of a long may tie there
        assert sorted((r.query_id, r.rank, r.score) for r in out) == [(q, r, clamp(s)) for q, r, _, s in expected]
    else:
        assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in out) == expected
    assert topk.search(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_reading_stops_before_the_end_of_the_lists():
    pick = np.random.default_rng(1)
    vectors = np.round(pick.normal(0, 3, (5000, 4))).astype(np.int64)
    vectors[7] = [90, 90, 90, 90]
    block = topk.SortedLists(np.arange(5000), vectors)
    read = []
    whole = block.order
    class Watched:  # noqa: E301
        def __getitem__(self, at):
            read.append(at)
            return whole[at]
    block.order = Watched()
    assert block.best(-1, np.array([1, 1, 1, 1]), 1)[0] == [7]
    assert len(read) <= 4


# --- all queries and the pipeline ---

@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_equal_sql(spark, name):
    from tests.compare import difference, duck, run_spark, run_sql

    got = run_spark(queries.QUERIES[name](spark, FOLDER))
    assert difference(got, run_sql(duck(FOLDER), queries.ORACLES[name])) is None


def test_names_and_stages():
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == list(range(1, 11))
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_the_pipeline_stage_by_stage(spark, tmp_path):
    from paylake.llm import bpe
    from tests.llm.test_text_ops import WORD, plain_components, plain_removal

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(120).repartition(3)
    columns, before, stages = docs.columns, None, dict(corpus_pipeline.STAGES)

    def step(name, docs):
        out = stages[name](spark, docs, FOLDER)
        out.write.parquet(str(tmp_path / name.replace(" ", "")))
        return spark.read.parquet(str(tmp_path / name.replace(" ", "")))

    before = docs.collect()
    kept = step("quality classifier", docs)
    assert kept.columns == columns and 0 < kept.count() < len(before)
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    single = step("near-duplicate removal", kept)
    assert sorted(r.doc_id for r in single.collect()) == sorted(d for d, _, c in plain_components(rows) if c == d)
    texts = {r.doc_id: r.text for r in single.collect()}
    cut = step("repeated passages", single)
    expected = {d: x[2] for d, x in zip(texts, plain_removal(texts.values(), 35)) if x[2]}
    assert {r.doc_id: WORD.findall(r.text) for r in cut.collect()} == expected
    assert all(r.n_chars == len(r.text) for r in cut.collect())
    mixed = step("mixing", cut)
    assert mixed.columns == columns and {r.doc_id for r in mixed.collect()} <= set(expected)
    last = step("encoding", mixed)
    assert last.count() == mixed.count() and last.filter("NOT decodes").count() == 0
    encoder = bpe.Encoder(open(bpe.tokenizer_file(), "rb").read(), bpe.split_pattern())
    assert all(r.ids == encoder.encode(r.text).tolist() for r in last.limit(20).collect())
    empty = spark.createDataFrame([], docs.schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, FOLDER).count() == 0, name


def test_entries_are_the_counts_of_the_words_of_each_text():
    texts = ["", "İstanbul CAFÉ\x0b\x1cfoo!!bar   x\ud800y", "!!!", "a a, a.b\nA", " ", "b c", "none of these"]
    place = {word: i for i, word in enumerate(sorted({w for t in texts[:6] for w in toxicity.tokens(t)}))}
    for known in (place, {}):
        owner, places, number = toxicity._entries(texts, known)
        found = [dict(zip(places[owner == i].tolist(), number[owner == i].tolist())) for i in range(len(texts))]
        assert found == [{known[w]: n for w, n in Counter(toxicity.tokens(t)).items() if w in known} for t in texts]
        assert sorted(zip(owner.tolist(), places.tolist())) == list(zip(owner.tolist(), places.tolist()))
    assert len(toxicity._entries([], place)[0]) == 0


def test_texts_are_taken_up_in_portions_bounded_by_characters(monkeypatch):
    monkeypatch.setattr(toxicity, "CHARS", 10)
    monkeypatch.setattr(toxicity, "ROWS", 3)
    column = pa.array(["a", None, "b", "c" * 30, "d" * 9, "e"])
    assert list(toxicity._portions(column)) == [["a", "", "b"], ["c" * 30], ["d" * 9, "e"]]
