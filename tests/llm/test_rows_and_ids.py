"""Columns with clashing names, ids with several texts and repeated rows: nothing is lost or overwritten."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from paylake.llm import bpe, minhash, quality_classifier, substring_dedup, topk
from paylake.llm.wordhash import WordHashes
from paylake.session import BATCH_BYTES, bounded_batches

PICK = random.Random(31)


def text(n=60):
    return " ".join(f"w{PICK.randrange(10**6)}" for _ in range(n))


def near(words, changes=1):
    words = words.split()
    for _ in range(changes):
        words[PICK.randrange(len(words))] = f"n{PICK.randrange(10**6)}"
    return " ".join(words)


def shingles(value):
    words = (value or "").lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def expected_components(rows):
    """Least id reachable for every id: links between texts, and all texts of an id."""
    sets = [shingles(t) for _, t in rows]
    label = {i: i for i, _ in rows if i is not None}
    changed = True
    while changed:
        changed = False
        for (i, _), a in zip(rows, sets):
            for (j, _), b in zip(rows, sets):
                if i is None or j is None or not (i == j or (a and b and 100 * len(a & b) >= 75 * len(a | b))):
                    continue
                least = min(label[i], label[j])
                if label[i] != least or label[j] != least:
                    label[i] = label[j] = least
                    changed = True
    return [(i, len(s), label.get(i), i is None or label[i] == i) for (i, _), s in zip(rows, sets)]


def several_texts():
    one, two, three, four = text(), text(), text(), text(200)
    rows = [(1, one), (1, two), (2, near(one)), (3, near(two)), (4, three), (4, three), (4, three), (5, near(three)), (6, three),
            (7, four), (8, near(four, 2)), (9, text()), (None, one), (None, one), (10, None), (11, ""), (10, text()), (12, "a b"), (13, "A B"),
            (14, "long " + four + " x" * 50_000), (15, "long " + four + " x" * 50_000)]
    return rows + [(20 + i, near(four)) for i in range(12)] + [(0, text()), (0, near(two))]


def test_ids_with_several_texts_equal_brute_force(spark):
    rows = several_texts()
    df = spark.createDataFrame([(i, t, "k", b"x", 1) for i, t in rows], "doc_id long, text string, node string, text_key binary, id int")
    for parts in (1, 7):
        found = minhash.near_duplicates(df.repartition(parts)).collect()
        assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected_components(rows)))


def test_comparison_in_blocks_by_words(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 100)
    rows = several_texts()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(str, map(tuple, minhash.near_duplicates(df).collect()))) == sorted(map(str, expected_components(rows)))


def test_the_near_duplicate_stage_keeps_every_text_of_a_kept_id(spark):
    rows = [(*r, "en", s, 5) for r, s in zip(several_texts(), "abcdefgh" * 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    kept = {i for i, _, _, k in expected_components([r[:2] for r in rows]) if k and i is not None}
    assert sorted((r.doc_id, r.text or "") for r in out if r.doc_id is not None) == sorted({(r[0], r[1] or "") for r in rows if r[0] in kept})
    assert sum(r.doc_id is None for r in out) == 2 and out[0].asDict().keys() == set(docs.columns)
    least = next(r for r in out if r.doc_id == 4)
    assert least.source == min(r[3] for r in rows if r[:2] == (4, least.text))


@pytest.mark.parametrize("shard_bytes", [substring_dedup.SHARD_BYTES, 1])
def test_dedup_keeps_columns_of_any_name(spark, monkeypatch, shard_bytes):
    monkeypatch.setattr(substring_dedup, "SHARD_BYTES", shard_bytes)
    passage = text(40)
    rows = [(i, "mykey", "mytext", 7, "r", text(5) + " " + passage + " " + text(3)) for i in range(3)] + [
        (9, "k9", "t9", 8, "r9", near(passage, 1)), (10, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, key string, __text string, `place.x` int, row string, text string")
    out = {r.doc_id: r for r in substring_dedup.dedup(docs).collect()}
    assert [c for c in substring_dedup.dedup(docs).columns] == [*docs.columns, "n_words", "n_removed"]
    for i, key, mine, place, row, value in rows:
        r = out[i].asDict()
        assert (r["key"], r["__text"], r["place.x"], r["row"]) == (key, mine, place, row)
        assert r["n_removed"] == (40 if i < 3 else 0) and len(r["text"].split()) == len((value or "").split()) - r["n_removed"]


def test_round_trip_is_encode_and_decode(spark):
    rows = [(1, "Hello  world's é\n\t 123"), (2, None), (3, ""), (4, "ß" * 3000 + " x" * 3000), (None, "a")]
    docs = spark.createDataFrame([(*r, [1], b"z") for r in rows], "doc_id long, text string, ids array<int>, decoded binary")
    both = bpe.round_trip(docs, keep=["doc_id", "text"]).orderBy("doc_id").collect()
    apart = bpe.decode(bpe.encode(docs, keep=["doc_id", "text"])).orderBy("doc_id").collect()
    assert [tuple(r) for r in both] == [tuple(r) for r in apart]
    assert all(bytes(r.decoded).decode() == (r.text or "") for r in both)
    assert bpe.round_trip(docs.filter(F.lit(False))).collect() == []
    assert bpe.decode(spark.createDataFrame([(None,), ([],)], "ids array<int>")).collect()[0].decoded == b""
    with pytest.raises(Exception, match="IndexError|out of range"):
        bpe.decode(spark.createDataFrame([([10 ** 8],)], "ids array<int>")).collect()


def test_very_long_texts_are_cut_into_matches_one_by_one(monkeypatch):
    encoder = bpe.Encoder(open(bpe.tokenizer_file(), "rb").read(), bpe.split_pattern())
    value = "Hello  world's é\n\t 123 " * 50
    expected = encoder.encode(value).tolist()
    monkeypatch.setattr(bpe, "LONG_TEXT", 10)
    assert encoder.encode(value).tolist() == expected


def test_runs_longer_than_a_place_holds_are_cut(monkeypatch):
    words = [b"w"] * 400 + [b"x%d" % i for i in range(100)]
    monkeypatch.setattr(substring_dedup, "SIZE_BITS", 5)
    _, _, first, size, twice = substring_dedup.runs_of(words, WordHashes())
    assert size.max() < 32 and size.sum() == len(words) - 34 and twice.any()
    assert (np.concatenate([[0], np.cumsum(size)])[:-1] == first).all()


def test_the_classifier_on_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (2, None)], "doc_id long, quality int")
    model = quality_classifier.train(docs, labels, ~quality_classifier.held_out(F.col("doc_id"), 4, 2))
    assert quality_classifier.score(docs, model).collect() == []
    some = spark.createDataFrame([(1, "a few words"), (1, "a few words"), (2, None), (None, " \n "), (3, "long line\n" * 30_000)],
                                 "doc_id long, text string")
    assert sorted(r.score for r in quality_classifier.score(some, model).collect()) == [0.0, 0.0, 0.5, 0.5, 0.5]
    assert topk.search(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)).collect() == []


def test_python_workers_get_batches_bounded_by_bytes(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.range(0, 60, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 40_000).alias("text"))

    def sizes(source):
        for batch in source:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["bytes"])

    before = spark.conf.get(name, None)
    try:
        spark.conf.unset(name)
        assert corpus_pipeline.encode(spark, docs, "").columns[-2:] == ["n_tokens", "decodes"]
        found = [r.bytes for r in docs.mapInArrow(sizes, "bytes long").collect()]
        assert sum(found) > 12_000_000 and max(found) < BATCH_BYTES + 1_000_000   # a row of 200 kB may go over
        spark.conf.set(name, "1000000")
        assert bounded_batches(spark).conf.get(name) == "1000000"   # a limit that was given stays
    finally:
        spark.conf.unset(name)
        if before is not None:
            spark.conf.set(name, before)
