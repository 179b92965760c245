"""Tokenizers, substring removal and near-duplicates against brute force and public libraries."""

import random
import re

import pytest
from pyspark.sql import functions as F

from paylake.llm import bpe, components, minhash, substring_dedup, suffix_automaton, token_count, wordhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGE = [None, "", " ", "\n", "a", "a b", "é", "日本語 テキスト", "x" * 5000, "a\x1cb\x85c d", "'s don't  \n\n  end ", "1234 ½ Ⅷ ²",
        "<|endoftext|>", "😀😀 👩‍👩‍👧", "tab\tand\x0bmore\r\n", "\u0000zero", " leading", "trailing  "]


def documents(spark, texts, first=0):
    rows = [(first + i, t, -1, "keep", [1]) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words int, ids string, key array<int>")


# --- byte-level BPE ---

@pytest.fixture(scope="module")
def reference():
    import public_tokenizers
    import tiktoken

    ranks = bpe.read_ranks(open(bpe.tokenizer_file(), "rb").read())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoding_equals_the_library_and_decodes(spark, reference):
    texts = EDGE + ["".join(random.Random(i).choices("ab c'\n1é", k=200)) for i in range(30)]
    out = bpe.decode(bpe.encode(documents(spark, texts))).collect()
    assert len(out) == len(texts) and {"doc_id", "text", "n_words", "key", "ids", "decoded"} == set(out[0].asDict())
    for r in out:
        assert r.ids == reference.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()
    assert bpe.encode(documents(spark, [])).count() == 0


def test_every_character_class_is_split_alike(reference):
    encoder = bpe.Encoder(open(bpe.tokenizer_file(), "rb").read(), bpe.split_pattern())
    for code in [*range(0x2100), *range(0x2E80, 0x3100), 0x180E, 0x200B, 0xFEFF, 0x1D7D8, 0x1F600]:
        text = f"a{chr(code)}{chr(code)}b {chr(code)}1{chr(code)} "
        assert encoder.encode(text).tolist() == reference.encode_ordinary(text), hex(code)


def plain_merge(piece, ranks):
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], bpe.NONE), i) for i in range(len(parts) - 1))
        if rank == bpe.NONE:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def test_the_segment_tree_merges_like_a_scan():
    pick = random.Random(2)
    ranks = {bytes([i]): i for i in range(256)}
    tokens = [bytes([i]) for i in b"abc"]
    while len(ranks) < 300:  # any vocabulary whose tokens are made of earlier ones
        new = pick.choice(tokens) + pick.choice(tokens)
        if new not in ranks:
            ranks[new] = len(ranks)
            tokens.append(new)
    for _ in range(400):
        piece = bytes(pick.choices(b"abc", k=pick.randrange(1, 40)))
        assert bpe.merge(piece, ranks) == plain_merge(piece, ranks)


# --- unigram token counts ---

@pytest.mark.parametrize("byte_fallback", [True, False])
@pytest.mark.parametrize("whole", [True, False])
def test_counts_equal_the_library(byte_fallback, whole):
    from tokenizers import Tokenizer, models

    pick = random.Random(4)
    pieces = sorted({"".join(pick.choices("▁ab", k=pick.randrange(1, 5))) for _ in range(40)})
    if not whole:  # pieces with the mark in front only: the text is counted chunk by chunk
        pieces = sorted({p for p in pieces if "▁" not in p.lstrip("▁")})
    vocabulary = tuple((p, -float(pick.randrange(1, 6))) for p in pieces)   # many ties
    counter = token_count.Counter(vocabulary, byte_fallback)
    assert (counter.chunks is None) == (whole or not byte_fallback)
    extra = [(f"<0x{i:02X}>", 0.0) for i in range(256)] if byte_fallback else []
    # The library takes its worst score over all entries, so the unknown piece and the bytes score as the best.
    library = Tokenizer(models.Unigram([("<unk>", 0.0), *extra, *vocabulary], 0, byte_fallback))
    for _ in range(300):
        text = "".join(pick.choices("ab cé\n", k=pick.randrange(1, 25)))
        assert counter.count(text) == len(library.encode("▁" + text.replace(" ", "▁")).ids), repr(text)


def test_token_counts_of_a_table(spark):
    out = {r.doc_id: r.n_tokens for r in token_count.count_tokens(documents(spark, EDGE)).collect()}
    assert out[0] == out[1] == 0 and len(out) == len(EDGE) and all(n > 0 for i, n in out.items() if i > 1)
    assert token_count.count_tokens(documents(spark, EDGE), vocabulary=()).filter("doc_id = 6").first().n_tokens == 5
    assert token_count.count_tokens(documents(spark, [])).count() == 0


# --- substring dedup ---

def plain_removal(texts, length):
    words = [WORD.findall(t or "") for t in texts]
    starts = {}
    for d, w in enumerate(words):
        for i in range(len(w) - length + 1):
            starts.setdefault(tuple(w[i:i + length]), []).append((d, i))
    gone = {(d, i + k) for places in starts.values() if len(places) > 1 for d, i in places for k in range(length)}
    return [(len(w), sum((d, i) in gone for i in range(len(w))), [x for i, x in enumerate(w) if (d, i) not in gone])
            for d, w in enumerate(words)]


def repeated_texts():
    pick = random.Random(8)
    word = lambda: "".join(pick.choices("abcdefgh", k=3))
    passages = [[word() for _ in range(n)] for n in (34, 35, 36, 60, 90)]
    texts = [None, "", "w " * 34, "w " * 35, "w " * 36, "w " * 100, "p q " * 60, " ".join(passages[4]) + "\n" + " ".join(passages[4])]
    for _ in range(25):
        parts = []
        for _ in range(pick.randrange(1, 4)):
            parts += [word() for _ in range(pick.randrange(0, 30))] + pick.choice(passages)
        texts.append(pick.choice([" ", "\n"]).join(parts))
    near = passages[3][:]
    for i in range(12):
        near[pick.randrange(60)] = word()
        texts.append(" ".join(near))
    return texts + texts[20:23] + ["common lead in words of eight here now " + " ".join(word() for _ in range(40)) for _ in range(30)]


@pytest.mark.parametrize("shard_runs", [substring_dedup.SHARD_RUNS, 1])
def test_removal_equals_brute_force(spark, monkeypatch, shard_runs):
    monkeypatch.setattr(substring_dedup, "SHARD_RUNS", shard_runs)   # 1: every gram with several runs is split by window
    texts = repeated_texts()
    docs = documents(spark, texts).drop("n_words").repartition(5)
    out = {r.doc_id: r for r in substring_dedup.dedup(docs).collect()}
    for i, (n, removed, kept) in enumerate(plain_removal(texts, 35)):
        assert (out[i].n_words, out[i].n_removed, WORD.findall(out[i].text)) == (n, removed, kept), i
        if not removed:
            assert out[i].text == (texts[i] or "")


def test_removal_of_repeated_rows_ids_and_no_rows(spark):
    long = " ".join(f"w{i}" for i in range(50))
    df = spark.createDataFrame([(1, long), (1, long), (None, "x " + long), (1, "other")], "doc_id long, text string")
    assert sorted(r.n_removed for r in substring_dedup.dedup(df).collect()) == [0, 50, 50, 50]
    assert substring_dedup.dedup(df.limit(0)).columns == ["doc_id", "text", "n_words", "n_removed"]
    assert substring_dedup.dedup(df.limit(0)).count() == 0


def test_the_automaton_counts_weighted_occurrences():
    pick = random.Random(6)
    for _ in range(60):
        sequences = [[pick.choice("ab") for _ in range(pick.randrange(1, 14))] for _ in range(3)]
        weights = [pick.choice([1, 1, 2]) for _ in sequences]
        automaton = suffix_automaton.SuffixAutomaton(sequences, weights)
        uses = {}
        for s, w in zip(sequences, weights):
            for i in range(len(s) - 3):
                uses[tuple(s[i:i + 4])] = uses.get(tuple(s[i:i + 4]), 0) + w
        for s in sequences:
            expected = {i + k for i in range(len(s) - 3) if uses[tuple(s[i:i + 4])] > 1 for k in range(4)}
            assert {i for a, b in automaton.repeated_spans(s, 4) for i in range(a, b)} == expected


def test_sliding_least_values():
    import numpy as np

    values = np.array([random.Random(1).randrange(100) for _ in range(80)])
    for width in range(1, 40):
        assert wordhash.sliding_min(values, width).tolist() == [min(values[i:i + width]) for i in range(81 - width)]


# --- near duplicates ---

def shingle_set(text):
    words = [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in WORD.findall(text or "")]
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def plain_components(rows):
    sets, at = [shingle_set(t) for _, t in rows], list(range(len(rows)))

    def root(i):
        while at[i] != i:
            i = at[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both) or rows[i][0] == rows[j][0]:
                at[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), d), d)
    return [(d, len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(rows)]


def similar_rows():
    pick = random.Random(12)
    word = lambda: "".join(pick.choices("abcdefghij", k=4))
    texts = ["", " ", "one", "ONE", "one two", "A b c d", "a b c d", "ä b c d", "Ä b c d", "a b c d e", "r " * 500]
    for size in (30, 80, 200):
        base = [word() for _ in range(size)]
        for k in range(18):   # a chain: each copy is changed a little more
            texts.append(" ".join(base))
            for _ in range(pick.randrange(0, max(2, size // 60))):
                base[pick.randrange(size)] = word()
    base = [word() for _ in range(120)]
    for _ in range(40):       # a star around one text, at the edge of similarity
        copy = base[:]
        for _ in range(pick.randrange(0, 5)):
            copy[pick.randrange(120)] = word()
        texts.append(" ".join(copy))
    pick.shuffle(texts)
    return [(100 + i, t) for i, t in enumerate(texts)] + [(7, None), (400, texts[3]), (400, texts[3]), (401, texts[20]), (401, texts[50])]


def test_components_equal_brute_force(spark):
    rows = similar_rows()
    df = spark.createDataFrame([(*r, -1) for r in rows], "doc_id long, text string, component_id int").repartition(4)
    out = minhash.near_duplicates(df).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out) == sorted(plain_components(rows))
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_null_ids_and_no_rows(spark):
    df = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (3, "a b c"), (2, "a b c")], "doc_id long, text string")
    out = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in minhash.near_duplicates(df).collect())
    assert out == [(0, 0, True), (0, 0, True), (2, 2, True), (3, 2, False)]
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_signatures_estimate_similarity():
    import numpy as np

    pick = np.random.default_rng(3)
    shared, own = pick.integers(0, 2 ** 63, 600).astype(np.uint64), pick.integers(0, 2 ** 63, (2, 100)).astype(np.uint64)
    rows = minhash.signatures([np.unique(np.concatenate([shared, o])) for o in own])
    assert abs((rows[0] == rows[1]).mean() - 600 / 800) < 0.13


def test_components_of_a_long_path(spark):
    links = spark.range(60).select((F.col("id") * 37 % 61).alias("a"), ((F.col("id") + 1) * 37 % 61).alias("b"))
    out = components.components(links).collect()
    assert len(out) == 61 and {r.component for r in out} == {0}
    assert components.components(links.limit(0)).count() == 0
