"""Decontamination, license scans and fingerprints against plain forms."""

import hashlib
import random
import re
from itertools import pairwise

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakestrata.llm import fingerprints as fp
from lakestrata.llm import license_scan as ls
from lakestrata.llm.decontaminate import drop_leaks, find_leaks

from .helpers import documents, rows_of

RNG = random.Random(23)
WORDS = ["".join(RNG.choices("abcdeé", k=5)) for _ in range(400)]


def prose(n):
    return " ".join(RNG.choices(WORDS, k=n))


# Decontamination


def bench_words(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", low)


def grams(words, k):
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute_leaks(docs, items, k, threshold):
    out = []
    for doc, text in docs:
        for item, wanted in set(items):
            words = bench_words(wanted)
            n = min(k, len(words))
            held = grams(words, n) if n else set()
            shared = len(held & grams(bench_words(text), n)) if n else 0
            if held and shared >= threshold * len(held):
                out.append((doc, item, len(held), shared))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_chars", [16_000_000, 300])
def test_leaks_are_those_of_all_pairs(spark, monkeypatch, block_chars):
    monkeypatch.setattr("lakestrata.llm.decontaminate.BLOCK_CHARS", block_chars)
    items = [(i, prose(RNG.randrange(6, 60))) for i in range(25)]
    items += [(30, "two words"), (31, ""), (32, None), (33, items[0][1]), (None, "no number at all here"), (34, items[0][1])]
    docs = [(i, prose(200)) for i in range(30)]
    for i in range(60):
        words = items[i % 25][1].split()
        for _ in range(i // 12):
            words[RNG.randrange(len(words))] = "changed"
        inside = RNG.choice([" ", "\n", ", "]).join(words)
        docs.append((100 + i, f"{prose(50)} {inside.upper() if i % 3 else inside} {prose(5000 if i == 7 else 20)}"))
    docs += [(200, None), (201, ""), (202, "x two, WORDS y"), (None, items[0][1]), (203, items[0][1]), (203, items[0][1])]
    frame = documents(spark, docs).selectExpr("*", "1 AS item_id", "2 AS shared").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS doc_id")
    got = find_leaks(frame, bench, 5, 0.8)
    rows = sorted(((r.doc_id, r.item_id, r.n_shingles, r.shared) for r in got.collect()), key=repr)
    want = brute_leaks(docs, items, 5, 0.8)
    assert rows == want
    left = drop_leaks(frame, bench, 5, 0.8)
    assert left.columns == frame.columns
    leaked = {d for d, *_ in want}
    assert sorted(repr(r.doc_id) for r in left.collect()) == sorted(repr(d) for d, _ in docs if d not in leaked)


def test_no_items_and_no_documents(spark):
    docs, none = documents(spark, [(1, prose(20))]), spark.createDataFrame([], "item_id long, text string")
    assert find_leaks(docs, none).count() == 0
    assert drop_leaks(docs, none).count() == 1
    assert find_leaks(docs.limit(0), spark.createDataFrame([(1, "a b")], none.schema)).count() == 0


# License scans


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 30), max_size=9))
def test_longest_increasing(values):
    places = ls.longest_increasing(values)
    assert all(i < j and values[i] < values[j] for i, j in pairwise(places))
    best = [1] * len(values)
    for i in range(len(values)):
        for j in range(i):
            if values[j] < values[i]:
                best[i] = max(best[i], best[j] + 1)
    assert len(places) == max(best, default=0)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcdefgh"), max_size=20), st.lists(st.sampled_from("abcdefgh"), max_size=20))
def test_alignment_is_a_common_subsequence(a, b):
    pairs = ls.align(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(i < k and j < m for (i, j), (k, m) in pairwise(pairs))
    assert ls.align(a, a) == [(i, i) for i in range(len(a))]


def brute_best(template, words):
    """The most matched words of any window of the spread."""
    best = 0
    for start in range(max(len(words), 1)):
        best = max(best, len(ls.align(words[start : start + template.spread], template.words)))
    return best if best >= template.needed else 0


def test_best_match_is_not_below_that_of_any_window():
    template = ls.Template("t", ls.TEMPLATES["Apache-2.0-header"], 0.8)
    for edits in (0, 5, 8):
        for place in (0, 3, 500):
            words = list(template.words)
            for _ in range(edits):
                words[RNG.randrange(len(words))] = "other"
            text = prose(place).split() + words + prose(400).split()
            found = template.best(text)
            assert (found[0] if found else 0) >= brute_best(template, text) * 0.95
            if edits == 0:
                assert found == (len(words), place, place + len(words) - 1)
    assert template.best(prose(3000).split()) is None
    twice = list(template.words) * 2
    assert template.best(twice)[0] == len(template.words)


@pytest.mark.parametrize("name", ["MIT-notice", "Apache-2.0-notice", "all-rights-reserved", "MIT", "GPL-header"])
def test_adjacent_copies_match_at_every_offset(name):
    template = ls.Template(name, ls.TEMPLATES[name], 0.8)
    size = len(template.words)
    for copies in (2, 3, 5):
        for place in range(2 * template.spread if size < 20 else 60):
            text = prose(place).split() + template.words * copies + prose(7).split()
            n, start, end = template.best(text)
            assert n == size and end - start == size - 1
            assert text[start : end + 1] == template.words


def test_edited_copies_match_as_much_as_any_stretch_holds():
    template = ls.Template("t", ls.TEMPLATES["Apache-2.0-notice"], 0.7)

    def plain_common(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            before = row[:]
            for j, y in enumerate(b, 1):
                row[j] = before[j - 1] + 1 if x == y else max(before[j], row[j - 1])
        return row[-1]

    for _ in range(60):
        text = prose(RNG.randrange(12)).split()
        for _ in range(RNG.randrange(1, 5)):
            copy = list(template.words)
            copy[RNG.randrange(len(copy))] = RNG.choice(["other", *template.words])
            text += copy
        best = max(plain_common(text[i : i + template.spread], template.words) for i in range(len(text)))
        found = template.best(text)
        assert (found[0] if found else 0) == (best if best >= template.needed else 0)
        if found:
            assert plain_common(text[found[1] : found[2] + 1], template.words) == found[0]


def test_scan(spark):
    texts = [(i, f"{prose(30)}\n{text}\n{prose(30)}") for i, text in enumerate(ls.TEMPLATES.values())]
    texts += [(100, None), (101, ""), (102, prose(50_000)), (103, "all was reserved and rights were kept"), (None, "All rights reserved."), (None, "All rights reserved."), (104, "x" * 300_000)]
    docs = documents(spark, texts).selectExpr("*", "1 AS license", "2 AS matched")
    rows = rows_of(ls.scan_licenses(docs))
    assert len(rows) == len(texts)
    by = {r["doc_id"]: r for r in rows}
    for i, name in enumerate(ls.TEMPLATES):
        assert by[i]["license"] == name and by[i]["coverage"] == 1.0
    assert all(by[i]["license"] is None and by[i]["coverage"] == 0 for i in (100, 101, 102, 103, 104))
    assert by[None]["license"] == "all-rights-reserved"
    assert ls.scan_licenses(docs.limit(0)).count() == 0


def test_bsd_texts_are_told_apart(spark):
    two, three, begins = (ls.TEMPLATES[n] for n in ("BSD-2-Clause", "BSD-3-Clause", "BSD-beginning"))
    changed = three.replace("the copyright holder nor", "the Example Project nor")
    words = two.split()
    cut = " ".join(words[: len(words) * 9 // 10])
    texts = [(1, f"x y {two} z"), (2, f"Copyright {three}"), (3, begins), (4, changed), (5, cut), (6, f"{two} {three}")]
    by = {r["doc_id"]: r for r in rows_of(ls.scan_licenses(documents(spark, texts)))}
    names = {i: by[i]["license"] for i in by}
    assert names == {1: "BSD-2-Clause", 2: "BSD-3-Clause", 3: "BSD-beginning", 4: "BSD-3-Clause", 5: "BSD-2-Clause", 6: "BSD-3-Clause"}
    assert by[1]["coverage"] == by[2]["coverage"] == by[3]["coverage"] == 1.0 > by[4]["coverage"] > 0.9


# Fingerprints


def own_prose(rng, doc):
    """A common word before every two words that no other text has, so that texts share only their end."""
    pairs = range(rng.randrange(8, 110))
    said = " ".join(f"{rng.choice(fp.ANCHORS)} n{doc}x{i} m{doc}x{i}" for i in pairs)
    return said + " the end of a text."


def test_edited_texts_and_likeness(spark):
    rng = random.Random(7)
    texts = [(i * 3, own_prose(rng, i)) for i in range(40)]
    texts += [(200, None), (201, ""), (202, "é" * 7), (203, "."), (204, texts[3][1]), (-9, texts[3][1]), (205, "word " * 60_000), (206, texts[4][1].upper())]
    docs = documents(spark, texts).selectExpr("*", "1 AS block", "2 AS spots", "3 AS edited").repartition(5)
    got = fp.fingerprints(docs)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
    by = {r["doc_id"]: r for r in rows_of(got)}
    ordered = sorted(texts)
    assert len(by) == len(texts)
    for (doc, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        text, following = text or "", following or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        r = by[doc]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert (r["near_edited"] == 1) == (r["fingerprint"] == r["edited_fingerprint"])
        if len(text) > 300 and doc < 200:
            assert 0.2 < r["near_edited"] < 0.9 and r["near_next"] < 0.2
    assert by[204]["fingerprint"] == by[-9]["fingerprint"] == by[9]["fingerprint"]
    assert by[206]["fingerprint"] == by[12]["fingerprint"]


def plain_spots(words):
    """Anchor and chain of each spot, as words."""
    out = set()
    for i, w in enumerate(words):
        if w in fp.ANCHORS:
            content = [x for x in words[i + 1 : i + 7] if x not in fp.ANCHORS]
            out.add((w, tuple(content[:3])))
    return out


def test_spots_are_anchor_and_chain(spark):
    text = "The alpha of beta gamma and the delta; epsilon. The alpha, of beta gamma zeta"
    words = re.findall(r"\w+", text.lower())
    one = fp.spots(spark.createDataFrame([(text,)], "text string"), "text", "s").first()["s"]
    sampled = one and [s for s in one]
    assert len(set(sampled)) == len(sampled) and sampled == sorted(sampled)
    assert len(plain_spots(words)) <= len(sampled) <= len(plain_spots(words)) + 1 + len(set(words))


def test_repeated_null_single_and_no_rows(spark):
    some = [(None, "the null one here"), (None, "the other null"), (5, "the same five"), (5, "the same five")]
    rows = rows_of(fp.fingerprints(documents(spark, some)))
    assert len(rows) == 4
    assert {r["near_next"] for r in rows if r["doc_id"] == 5} >= {1.0}
    single = rows_of(fp.fingerprints(documents(spark, [(1, "the only text of all")])))
    assert single[0]["near_next"] == 1.0
    assert fp.fingerprints(documents(spark, [])).count() == 0


def test_pruned_likeness(spark):
    pairs = [([1, 2, 3], [2, 3, 4]), ([1], [1, 2, 3, 4, 5]), ([], []), ([], [1]), ([7], [7])]
    frame = spark.createDataFrame(pairs, "a array<long>, b array<long>")
    rows = frame.select("a", "b", fp.likeness("a", "b").alias("x"), fp.likeness("a", "b", 0.5).alias("y")).collect()
    for r in rows:
        exact = len({*r.a} & {*r.b}) / len({*r.a} | {*r.b}) if r.a or r.b else 1.0
        assert r.x == exact
        assert r.y == (exact if exact >= 0.5 or r.y else 0.0)


def sets_of(spark, texts):
    frame = documents(spark, texts).withColumn("text", F.coalesce("text", F.lit("")))
    return {r["doc_id"]: frozenset(r["s"]) for r in fp.spots(frame, "text", "s").collect()}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


@pytest.mark.parametrize("least", [0.5, 0.8, 1.0])
def test_similar_texts_are_those_of_all_pairs(spark, least):
    """Edited texts of all degrees, copies, short and empty ones, and spots that most texts have."""
    rng = random.Random(int(least * 10))
    texts = []
    for i in range(30):
        words = own_prose(rng, i).split()
        for j in range(4):
            cut = rng.randrange(len(words) // (j + 2) + 1)
            texts.append((len(texts), " ".join(words[cut:] if j % 2 else words[: len(words) - cut])))
    texts += [(200, texts[3][1]), (201, texts[3][1].upper()), (202, None), (203, ""), (204, "the end"), (None, "the end")]
    docs = documents(spark, texts).selectExpr("*", "1 AS n", "2 AS spot", "3 AS part")
    members, links = fp.similar_texts(docs, least)
    names = members.collect()
    assert sorted((r["doc_id"] for r in names), key=str) == sorted((d for d, _ in texts), key=str)
    held = sets_of(spark, [t for t in texts if t[0] is not None])
    of = {}
    for r in names:
        if r["doc_id"] is not None:
            assert of.setdefault(r["fingerprint"], held[r["doc_id"]]) == held[r["doc_id"]]
    want = {
        (a, b): jaccard(of[a], of[b]) for a in of for b in of if a < b and jaccard(of[a], of[b]) >= least
    }
    got = {(r["a"], r["b"]): r["likeness"] for r in links.collect()}
    assert got == want
    assert got or least == 1.0
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_no_similar_texts(spark):
    members, links = fp.similar_texts(documents(spark, []))
    assert members.count() == links.count() == 0
    with pytest.raises(ValueError):
        fp.similar_texts(documents(spark, []), 0.0)


@pytest.mark.parametrize("least", [0.1, 0.5, 0.8])
def test_partitions_and_pruning_lose_nothing(spark, least):
    rng = random.Random(5)
    pool = [rng.randrange(-(2**63), 2**63) for _ in range(60)]
    sets = [sorted(rng.sample(pool, rng.choice([1, 2, 5, 20, 40, 50, 58]))) for _ in range(50)] + [[]]
    frame = spark.createDataFrame([(a, b) for a in sets for b in sets], "a array<long>, b array<long>")
    rows = frame.select(
        "a",
        "b",
        fp.likeness("a", "b", least).alias("x"),
        fp.likeness("a", "b", least, halves=True).alias("y"),
        fp.length_part(F.size("a"), least).alias("p"),
        fp.length_part(F.size("b"), least).alias("q"),
    ).collect()
    pruned = 0
    for r in rows:
        exact = jaccard(frozenset(r["a"]), frozenset(r["b"]))
        for found in (r["x"], r["y"]):
            assert found == exact or (found == 0 and exact < least)
        pruned += r["y"] == 0 < exact
        if r["a"] and r["b"] and exact >= least:
            assert abs(r["p"] - r["q"]) <= 1
    assert pruned


def test_lengths_at_the_edge_of_a_partition(spark):
    pairs = [(n, m) for n in range(1, 200) for m in range(n, 200) if 5 * n >= 4 * m]
    frame = spark.createDataFrame(pairs, "n int, m int")
    apart = F.abs(fp.length_part(F.col("n"), 0.8) - fp.length_part(F.col("m"), 0.8))
    assert frame.select(F.max(apart)).first()[0] == 1
