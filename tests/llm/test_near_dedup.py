"""Near-duplicate groups against all pairs of exact sets."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from lakestrata.llm import near_dedup
from lakestrata.llm.near_dedup import NearDuplicates, components
from lakestrata.llm.words import shingle_sets, word_hashes

from .helpers import documents, rows_of

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORDS.findall(low)
    if 0 < len(words) < k:
        return {tuple(words)}
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute(rows, k, part, whole):
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and None not in (rows[i][0], rows[j][0]):
                if whole * common >= part * len(a | sets[j]):
                    parent[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        known = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and doc is not None]
        least = min(known, default=None)
        out.append((doc, len(sets[i]), least, doc is None or doc == least))
    return sorted(out, key=repr)


def near_copies(rng, n, words, edits):
    base = [rng.choice(VOCABULARY) for _ in range(words)]
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(words)] = rng.choice(VOCABULARY)
        yield " ".join(copy)


RNG = random.Random(5)
VOCABULARY = ["".join(RNG.choice("abcdeéx") for _ in range(6)) for _ in range(3000)]


def corpus():
    texts = []
    for n, words, edits in [(40, 60, 5), (3, 200, 3), (2, 8, 1), (90, 150, 14), (4, 2500, 60)]:
        texts += near_copies(RNG, n, words, edits)
    texts += [" ".join(RNG.choices(VOCABULARY, k=RNG.randrange(1, 80))) for _ in range(60)]
    texts += [texts[0]] * 30 + [texts[0].upper().replace("É", "é")] * 3
    texts += ["", "", " \n\t ", None, "one", "ONE", "two words", "one two three", "x" * 100_000]
    numbers = list(range(100, 100 + len(texts)))
    RNG.shuffle(numbers)
    rows = list(zip(numbers, texts, strict=True))
    return rows + [(None, texts[0]), (None, "alone"), rows[5], rows[5], (100, "another text")]


@pytest.mark.parametrize("blocks", [256, 16])
@pytest.mark.parametrize("k,share", [(3, (85, 100)), (5, (80, 100))])
def test_groups_are_those_of_all_pairs(spark, monkeypatch, blocks, k, share):
    monkeypatch.setattr(near_dedup, "BUCKET_BLOCK", blocks)
    monkeypatch.setattr(near_dedup, "CLUSTER_BLOCK", blocks)
    rows = corpus()
    docs = documents(spark, rows).selectExpr("*", "1 AS set_key", "2 AS component_id")
    got = NearDuplicates(shingle=k, share=share).groups(docs.repartition(5))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, k, *share)


def test_no_rows_and_no_links(spark):
    assert NearDuplicates().groups(documents(spark, [])).count() == 0
    got = rows_of(NearDuplicates().groups(documents(spark, [(4, "a b"), (2, "c d")])))
    assert all(r["kept"] and r["component_id"] == r["doc_id"] for r in got)


def test_long_chains_are_one_component(spark):
    rows = [(i, i + 1) for i in range(300)] + [(1000, 2000), (-5, -5)]
    links = spark.createDataFrame(rows, "a long, b long").repartition(4)
    got = {r["node"]: r["component"] for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(301)}, 1000: 1000, 2000: 1000}


def test_word_hashes_do_not_depend_on_the_batch(monkeypatch):
    from lakestrata.llm import words

    texts = ["Some Words\there", "", None, "words  here", "x" * 300 + " y " * 200, "É é", "here"]
    filled = pa.array([t or "" for t in texts])
    whole, index = word_hashes(filled)
    assert np.diff(index).tolist() == [len(WORDS.findall(t or "")) for t in texts]
    names = {}
    for h, w in zip(whole.tolist(), [w for t in texts for w in WORDS.findall((t or ""))]):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
        assert names.setdefault(low, h) == h
    assert len(set(names.values())) == len(names)
    monkeypatch.setattr(words, "_RUN", 40)
    again, index_again = word_hashes(filled)
    assert again.tolist() == whole.tolist() and index_again.tolist() == index.tolist()
    sliced, _ = word_hashes(filled.slice(3))
    assert sliced.tolist() == whole[index[3] :].tolist()


def test_estimates_are_close():
    a = np.arange(1, 1001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    nd = NearDuplicates()
    texts = pa.array([" ".join(map(str, range(i, i + 1000))) for i in (0, 50, 300)])
    sets = list(shingle_sets(texts, 1))
    signatures = [near_dedup.signature(near_dedup.minima(s, nd.factors)) for s in sets]
    packed = np.array([np.frombuffer(s, dtype=np.uint8) for s in signatures])
    estimate = near_dedup.similarities(packed[0], packed[1:])
    assert abs(estimate[0] - 950 / 1050) < 0.1 and abs(estimate[1] - 700 / 1300) < 0.15
    assert near_dedup.shared(a[:900], np.sort(a[:900])) >= 0
