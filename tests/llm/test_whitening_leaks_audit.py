"""Whitening, benchmark decontamination and the filter audit against brute force."""

import random
import re
from itertools import permutations

import numpy as np
import pytest

from paylake.llm import decontamination, filter_audit, oracle, queries, whitening
from tests.compare import difference, duck, run_spark, run_sql

TINY = "/root/testdata/sf0.001"


# --- Whitening -----------------------------------------------------------------------------------


def whitened(spark, rows, extra=False):
    schema = "vec_id long, embedding array<float>" + (", component int, x array<long>, n long, whitened double" if extra else "")
    df = spark.createDataFrame([(*r, 1, [1], 1, 1.0) if extra else r for r in rows], schema)
    return whitening.whiten(df, whitening.fit(df)).collect()


def expected_whitening(rows, components=16):
    usable = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    width = max(len(v) for _, v in usable)
    xs = [[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] + [1_000_000] * (width - len(v)) for _, v in usable]
    once = sorted(set(map(tuple, xs)))
    n, sums = len(once), [sum(column) for column in zip(*once)]
    centred = np.array([[(n * c - s) / n for c, s in zip(x, sums)] for x in once])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    many = min(components, int((values > 1e-12 * np.trace(covariance)).sum()))
    out = []
    for (i, _), x in zip(usable, xs):
        exact = [n * c - s for c, s in zip(x, sums)]
        w = np.array(exact, float) / n @ vectors[:, :many] / np.sqrt(values[:many])
        out += [(i, k + 1, n, sum(e * e for e in exact), w[k], values[k] / np.trace(covariance)) for k in range(many)]
    return out


def same_whitening(found, expected):
    assert len(found) == len(expected)
    order = lambda r: (r[0] is None, r[0] or 0, r[3], r[1], round(abs(r[4]), 6))
    found, expected = sorted(map(tuple, found), key=order), sorted(expected, key=order)
    signs = {}
    for f, e in zip(found, expected):
        assert f[:4] == e[:4] and f[5] == pytest.approx(e[5], rel=1e-9) and f[6] < 1e-9
        assert abs(f[4]) == pytest.approx(abs(e[4]), abs=1e-7)
        if abs(e[4]) > 1e-3:
            assert signs.setdefault(f[1], f[4] * e[4] > 0) == (f[4] * e[4] > 0)


def embeddings(n, width, seed, scale=None):
    pick = np.random.default_rng(seed)
    return [(i, [float(c) for c in v]) for i, v in enumerate(pick.standard_normal((n, width)) * (scale if scale is not None else 1.0))]


def test_whitening_equals_a_dense_eigensolver(spark):
    rows = embeddings(150, 48, 3, np.linspace(1, 3, 48))
    rows += [(500, rows[0][1]), (500, rows[0][1]), (None, rows[1][1]), (501, None), (502, [float("nan")] * 48),
             (503, [None] + [0.0] * 47), (504, [float("inf")] * 48), (505, rows[2][1][:20]), (506, [])]
    same_whitening(whitened(spark, rows, extra=True), expected_whitening(rows))


def test_a_close_spectrum_is_certified(spark):
    """All values but one within some per cent of each other."""
    rows = embeddings(2000, 60, 4)
    rows = [(i, [v[0] + 3 * (i % 2), *v[1:]]) for i, v in rows]
    same_whitening(whitened(spark, rows), expected_whitening(rows))


@pytest.mark.parametrize("rows,components", [
    (embeddings(5, 64, 5), 4), (embeddings(40, 3, 6), 3), ([(1, [1.0]), (2, [2.0]), (3, [2.0])], 1)])
def test_fewer_directions_than_components(spark, rows, components):
    found = whitened(spark, rows)
    assert {r.component for r in found} == set(range(1, components + 1))
    same_whitening(found, expected_whitening(rows))


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]])
def test_no_variance_gives_no_rows(spark, rows):
    assert whitened(spark, rows) == []


def test_large_entries_stay_exact(spark):
    rows = [(1, [3e16, 0.0]), (2, [0.0, 1.0]), (3, [1e30, 5.0])]
    found = whitened(spark, rows)
    assert {r.vec_id for r in found} == {1, 2, 3} and all(r.deviation is None for r in found if r.vec_id == 3)


def test_whitening_query_on_the_table(spark):
    found = queries.op11_embedding_whitening(spark, TINY).collect()
    rows = [tuple(r) for r in spark.read.parquet(f"{TINY}/embeddings.parquet").select("vec_id", "embedding").collect()]
    same_whitening(found, expected_whitening(rows))


# --- Decontamination -----------------------------------------------------------------------------

LEAK_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def leak_words(text):
    return LEAK_WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def expected_leaks(docs, items, window=10):
    windows = {}
    for item, text in items:
        words = leak_words(text)
        n = min(len(words), window)
        for i in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[i:i + n]), set()).add("" if item is None else str(item))
    out = []
    for doc_id, text in docs:
        words, hit, named = leak_words(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                found = windows.get(tuple(words[i:i + n]))
                if found:
                    hit |= set(range(i, i + n))
                    named |= found
        out.append((doc_id, len(words), len(hit), len(named), sorted(named), bool(hit)))
    return sorted(out, key=str)


LEAK_SCHEMA = "doc_id long, text string, key string, words int, n_words int, items int, hash long"


def leaks(spark, docs, items):
    df = spark.createDataFrame([(*d, "k", 1, 1, 1, 1) for d in docs], LEAK_SCHEMA)
    marks = spark.createDataFrame([(*i, 1, "k") for i in items], "item_id long, text string, n int, key string")
    return sorted((tuple(r) for r in decontamination.contamination(df, marks).collect()), key=str)


def leaky(seed, lengths):
    pick = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(6)] + ["É", "ß", "Σς", "x1"]
    line = lambda n: [pick.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(line(n))) for i, n in enumerate(lengths)]
    docs = []
    for i in range(60):
        words = line(pick.randrange(0, 60))
        for _ in range(pick.randrange(0, 3)):
            source = pick.choice(items)[1].split()
            at, begin = pick.randrange(0, len(words) + 1), pick.randrange(0, len(source))
            words[at:at] = source[begin:begin + pick.randrange(1, 25)]
        docs.append((i, pick.choice([" ", ", ", "\n", "-"]).join(pick.choice([w, w.upper() if w.isascii() else w]) for w in words)))
    return docs, items


@pytest.mark.parametrize("seed,lengths", [(1, [10, 11, 25, 40]), (2, [6, 7, 12, 30]), (3, [1, 3, 5, 9, 20]), (4, [14] * 5)])
def test_leaks_equal_brute_force(spark, seed, lengths):
    docs, items = leaky(seed, lengths)
    assert leaks(spark, docs, items) == expected_leaks(docs, items)


def test_leak_edge_cases(spark):
    run = " ".join(f"t{i}" for i in range(30))
    same = " ".join(["a"] * 40)
    docs = [(1, None), (2, ""), (3, " .,; "), (4, run), (4, run), (4, "other text"), (None, run.upper()), (5, same), (6, "a " * 9),
            (7, "x " * 30_000 + run + " y" * 30_000), (8, run[:-1]), (9, "t5 t6 t7 t8 t9 t10 t11 t12 t13"), (10, "T5.T6-t7 t8 t9 t10 t11 t12 t13 t14")]
    items = [(1, run), (1, "zz " * 12), (2, run), (None, same), (3, None), (4, "!?")]
    assert leaks(spark, docs, items) == expected_leaks(docs, items)
    assert leaks(spark, docs, []) == expected_leaks(docs, [])
    assert leaks(spark, [], items) == []


def test_every_shared_window_holds_a_common_fingerprint(spark):
    """The guarantee of winnowing, on single windows in random surroundings."""
    pick = random.Random(9)
    texts = []
    for _ in range(50):
        window = [f"v{pick.randrange(50)}" for _ in range(10)]
        texts.append(tuple([f"v{pick.randrange(50)}" for _ in range(pick.randrange(9))] + window
                           + [f"v{pick.randrange(50)}" for _ in range(pick.randrange(9))] for _ in range(2)))
    df = spark.createDataFrame(texts, "a array<string>, b array<string>")
    found = df.select(*[decontamination.fingerprints(df[c], 6, 5).getField("hash").alias(c) for c in "ab"])
    assert found.selectExpr("bool_and(arrays_overlap(a, b))").first()[0]


# --- Filter audit --------------------------------------------------------------------------------

AUDIT_SCHEMA = "doc_id long, text string, lang string, part string, key string, n int, fails int, e int"


def expected_audit(docs, labels):
    marks = {}
    for doc_id, good, toxic in labels:
        g, t = marks.get(doc_id, (0, 0))
        marks[doc_id] = (g or int(good == 1), t or int(toxic == 1))
    first = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    judged = []
    for doc_id, text, lang in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {c for c, f in zip("ABCDE", (
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            bool(re.search("[#$%&*|]", t)), doc_id is not None and doc_id > first[t])) if f}
        judged.append((lang or "", fails, *(marks.get(doc_id, (0, 0)) if doc_id is not None else (0, 0))))
    out, shapley = [], {}
    for part in {j[0] for j in judged}:
        for order in permutations("ABCDE"):
            for step, f in enumerate(order):
                mine = [j for j in judged if j[0] == part]
                there = [j for j in mine if not j[1] & set(order[:step])]
                removed = [j for j in there if f in j[1]]
                row = (part, "".join(order), step + 1, len(there) - len(removed), len(removed),
                       sum(f in j[1] for j in mine) - len(removed), sum(j[1] == {f} for j in mine),
                       sum(j[2] for j in removed), sum(j[3] for j in removed))
                shapley[part, f] = shapley.get((part, f), 0) + len(removed)
                out.append(row)
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def audited(spark, docs, labels):
    df = spark.createDataFrame([(*d, "p", "k", 1, 1, 1) for d in docs], AUDIT_SCHEMA)
    marks = spark.createDataFrame([(*x, "f") for x in labels], "doc_id long, quality int, toxic int, fails string")
    return sorted(tuple(r) for r in filter_audit.audit(filter_audit.failures(df), marks).collect())


def test_audit_equals_every_order_applied(spark):
    pick = random.Random(12)
    texts = []
    for _ in range(60):
        n = pick.choice([0, 3, 150, 220, 260])
        words = [pick.choice("abcdefgh") * pick.randrange(1, 9) if pick.random() < 0.5 else f"u{pick.randrange(10**6)}" for _ in range(n)]
        words += pick.choice([[], [], ["#"], ["AAAAAAAAAAAA"] * 30, ["é\x0b|"]])
        texts.append(pick.choice([" ", "\t", "\n"]).join(words))
    docs = [(i, t, pick.choice(["en", "de"])) for i, t in enumerate(texts)]
    docs += [(100 + i, pick.choice(texts), pick.choice(["en", None, ""])) for i in range(25)]
    docs += [docs[0], docs[0], (0, texts[1], "en"), (None, texts[2], "de"), (None, None, None), (7, None, "en"), (200, "", "de"),
             (300, "long " * 100_000, "en"), (301, "long " * 100_000, "de")]
    labels = [(i, pick.choice([0, 1, None]), pick.choice([0, 1, None])) for i in range(90)] + [(0, 1, 0), (0, 0, 1), (None, 1, 1), (999, 1, 1)]
    assert audited(spark, docs, labels) == expected_audit(docs, labels)


def test_audit_of_nothing(spark):
    assert audited(spark, [], []) == [] and audited(spark, [], [(1, 1, 1)]) == []
    assert audited(spark, [(None, None, None)], []) == expected_audit([(None, None, None)], [])


def test_lattice_counts_orders():
    edges = filter_audit.lattice(5)
    assert len(edges) == 80
    for f in range(5):   # every order applies a filter once
        assert sum(e.orders for e in edges if e.step_filter == f) == 120
    for e in edges:
        before = [f for f in range(5) if e.before >> f & 1]
        assert e.orders == sum(set(p[:len(before)]) == set(before) and p[len(before)] == e.step_filter for p in permutations(range(5)))


def test_a_hot_text_and_a_hot_id_are_spread(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "HEAVY_ROWS", 2)
    docs = [(i % 9, "same", "en") for i in range(40)] + [(3, f"t{i}", "en") for i in range(30)] + [(50, "x", "en")]
    labels = [(3, 1, 1), (0, 1, 0)]
    assert audited(spark, docs, labels) == expected_audit(docs, labels)


@pytest.mark.parametrize("name", ["op12_benchmark_decontamination", "op13_filter_audit"])
def test_query_equals_sql(spark, name):
    assert difference(run_spark(queries.QUERIES[name](spark, TINY)), run_sql(duck(TINY), oracle.ORACLES[name])) is None


def test_decontamination_runs_in_the_jvm(spark):
    found = queries.op12_benchmark_decontamination(spark, TINY)
    plan = found._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInArrow", "FlatMapGroups"):
        assert operator not in plan
