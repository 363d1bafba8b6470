from __future__ import annotations

import random

import numpy as np
import pytest

from snapledger.llm import near_dup
from snapledger.llm.chunk_dedup import dedup_substrings, repeated_spans
from snapledger.llm.graph import components
from snapledger.llm.queries import QUERIES
from tests.llm import brute


def _words(r, n, prefix="w"):
    return [f"{prefix}{r.randrange(3000)}" for _ in range(n)]


def _copies(r, n, size, edits):
    """A text and copies of it with some words exchanged."""
    base = _words(r, size)
    out = [list(base) for _ in range(n)]
    for words in out[1:]:
        for _ in range(r.randrange(edits)):
            words[r.randrange(size)] = f"e{r.randrange(10**6)}"
    return [" ".join(w) for w in out]


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(1, i) for i in range(2, 60)] + [(500, 500), (None, 3), (7, 900)]
    df = spark.createDataFrame(links, "a long, b long")
    found = {r.node: r.comp for r in components(df).collect()}
    assert {found[i] for i in range(100, 141)} == {100} and {found[i] for i in [*range(1, 60), 900]} == {1}
    assert found[500] == 500 and None not in found
    assert components(df.limit(0)).collect() == []


def test_near_duplicates_query(spark, tables, texts):
    want = brute.near_components(texts, 85)
    found = {r.doc_id: r for r in QUERIES["op5_near_duplicates"](spark, tables).collect()}
    assert {i: r.component_id for i, r in found.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in found.values())
    assert all(found[i].n_shingles == len(brute.shingles(t)) for i, t in texts.items())


@pytest.mark.parametrize("percent", [80, 85])
def test_a_large_group_of_near_copies(spark, percent):
    """Larger than a leaf, of very different degrees of similarity, amid exact copies and strangers."""
    r = random.Random(percent)
    texts = _copies(r, 150, 90, 9) + _copies(r, 60, 200, 30) + [" ".join(_words(r, 60)) for _ in range(60)]
    texts += [texts[3]] * 40
    docs = dict(enumerate(texts))
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    found = near_dup.near_duplicates(df, percent=percent)
    assert {r.doc_id: r.component_id for r in found.collect()} == brute.near_components(docs, percent)


def test_bunches_that_share_classes_are_merged(spark):
    small = [(1, 10), (1, 11), (2, 10), (2, 11), (2, 12), (3, 11), (3, 12), (4, 20), (4, 21)]
    # Together these have more classes than a bunch may: they stay as they are.
    large = [(5, 100 + k) for k in range(90)] + [(6, 100)] + [(6, 200 + k) for k in range(90)]
    found = {}
    for r in near_dup._merged(spark.createDataFrame(small + large, "bunch long, cls long")).collect():
        found.setdefault(r.bunch, []).append(r.cls)
    want = [[10, 11, 12], [20, 21], [100 + k for k in range(90)], [100] + [200 + k for k in range(90)]]
    assert sorted(map(sorted, found.values())) == sorted(want)


def test_bunches_of_a_large_group_are_dealt_anew(spark):
    """Where many bunches share a large group's classes, pairs of blocks hold each pair in fewer rows; long sets take more blocks."""
    r = random.Random(3)
    bunches = [r.sample(range(600), 250) for _ in range(40)]
    rows = [(k, c, 100) for k, bunch in enumerate(bunches) for c in bunch] + [(50, 9000, 100), (50, 9001, 100)]
    for size, most in ((100, 4 * 600), (10_000, 6 * 600)):
        df = spark.createDataFrame([(k, c, size) for k, c, _ in rows], "bunch long, cls long, size long")
        found = {}
        for x in near_dup._merged(df).collect():
            found.setdefault(x.bunch, []).append(x.cls)
        assert all(len(set(c)) == len(c) for c in found.values()) and sum(map(len, found.values())) <= most
        pairs = {(a, b) for c in found.values() for a in c for b in c}
        assert all((a, b) in pairs for bunch in bunches for a in bunch for b in bunch) and (9000, 9001) in pairs
        assert max(map(len, found.values())) * size <= 1.5 * near_dup.HELD and len(found) < 40
    # Bunches that share little stay as they are.
    chain = [(k, 100 * k + j, 100) for k in range(20) for j in range(120)]
    kept = near_dup._merged(spark.createDataFrame(chain, "bunch long, cls long, size long"))
    assert sorted(map(tuple, kept.collect())) == sorted((k, c) for k, c, _ in chain)


def test_steps_do_not_look_classes_up(spark, monkeypatch):
    """Rows of large nodes carry what a step needs: no step joins all its rows with the classes or with their components."""
    monkeypatch.setattr(near_dup, "LEAF", 6)
    monkeypatch.setattr(near_dup, "WIDE", 12)
    r = random.Random(11)
    texts = _copies(r, 60, 120, 25) + [" ".join(_words(r, 50)) for _ in range(20)]
    plans, materialize = [], near_dup.materialize

    def planned(df, label):
        plans.append((label, df._jdf.queryExecution().optimizedPlan().toString()))
        return materialize(df, label)

    monkeypatch.setattr(near_dup, "materialize", planned)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    near_dup.near_duplicates(df, percent=85).collect()
    steps = [plan for label, plan in plans if label == "nodes"]
    later = [plan for label, plan in plans if label == "open-rows"][1:]
    assert steps and later and not any("Join" in plan for plan in steps)
    assert all(plan.count("Join") == 1 for plan in later)


def test_work_on_families_of_near_copies(spark, monkeypatch):
    """A few strays don't make a large node branch again and again."""
    r = random.Random(8)
    texts = [t for _ in range(20) for t in _copies(r, 6, 80, 6)] + _copies(r, 150, 90, 4)
    # Strays: close enough to the large family to share nodes, too far for links.
    texts += [" ".join([*texts[120].split(" ")[:81], *_words(r, 9, f"s{k}-")]) for k in range(5)]
    labels, materialize = [], near_dup.materialize
    monkeypatch.setattr(near_dup, "materialize", lambda df, label: (labels.append(label), materialize(df, label))[1])
    docs = dict(enumerate(texts))
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    found = near_dup.near_duplicates(df, percent=85)
    assert {r.doc_id: r.component_id for r in found.collect()} == brute.near_components(docs, 85)
    assert labels.count("large-nodes") == 1


def test_rows_of_a_node_are_named_by_what_may_be_similar(spark):
    """Rows don't grow with the square of a node, and members of other sizes or without a partner stay out."""
    r = np.random.default_rng(5)

    def near(base):
        sign = base.copy()
        sign[r.integers(64)] ^= 1
        return sign

    bases = r.integers(0, 1 << 16, (70, 64), dtype=np.uint16)
    signs = [x for b in bases[:60] for x in (near(b), near(b), near(b), near(b))] + list(bases[60:]) + [bases[0]]
    sizes = [100] * (len(signs) - 1) + [50]
    shorts = near_dup.shortened(np.array(signs))
    rows = [(1, k, -1, bytearray(x.tobytes()), n, k) for k, (x, n) in enumerate(zip(shorts, sizes, strict=True))]
    # The same node by another path counts once.
    rows += [(2, *row[1:]) for row in rows]
    df = spark.createDataFrame(rows, "node long, cls long, side int, short binary, size long, comp long")
    found = {}
    for x in near_dup._candidates(df, 85).collect():
        found.setdefault(x.bunch, set()).add(x.cls)
    assert sorted(map(sorted, found.values())) == [[4 * k + j for j in range(4)] for k in range(60)]
    # All of one family: one bunch, or if the sets are long, pairs of blocks that hold every pair.
    one = [(1, k, -1, bytearray(shorts[0].tobytes()), 100, k) for k in range(300)]
    assert near_dup._candidates(spark.createDataFrame(one, df.schema), 85).groupBy("bunch").count().collect()[0]["count"] == 300
    one = [(*row[:4], 10**5, row[5]) for row in one]
    kept = near_dup._candidates(spark.createDataFrame(one, df.schema), 85).collect()
    assert len(kept) <= 300 * (1 + 300 / near_dup.LEAF)
    found = {}
    for x in kept:
        found.setdefault(x.bunch, set()).add(x.cls)
    assert {(a, b) for c in found.values() for a in c for b in c} == {(a, b) for a in range(300) for b in range(300)}
    assert max(map(len, found.values())) <= 2 * near_dup.LEAF


def test_blocks_hold_each_pair_with_a_stray(spark):
    rows = [(7, k, 400, 150, k < 150, k == 390) for k in range(400)]
    df = spark.createDataFrame(rows, "node long, cls long, n long, m long, stray boolean, hub boolean")
    join = near_dup._Join(None, None, 5, 85, 8)
    for dealt, role in ((join._blocks(df), 150), (join._stray_blocks(df), 150), (join._hub_blocks(df), None)):
        nodes, pairs = {}, set()
        for x in dealt.collect():
            nodes.setdefault(x.node, []).append((x.cls, x.side))
        for held in nodes.values():
            pairs |= {(a, b) for a, s in held for b, t in held if a < b and (s != t or s < 0)}
        want = {(k, j) for k in range(150) for j in range(k + 1, 400)} if role else {(min(k, 390), max(k, 390)) for k in range(400) if k != 390}
        assert want <= pairs
        if role is None:
            assert pairs == want


def test_later_steps_of_a_family_with_many_strays(spark, monkeypatch):
    """Small limits send the nodes through all steps; a step after the first writes its nodes and its open rows only."""
    monkeypatch.setattr(near_dup, "LEAF", 6)
    monkeypatch.setattr(near_dup, "WIDE", 12)
    r = random.Random(11)
    texts = _copies(r, 60, 120, 3) + _copies(r, 60, 120, 25) + [" ".join(_words(r, 50)) for _ in range(20)]
    base = texts[0].split(" ")
    for _ in range(60):
        words = list(base)
        for _ in range(r.randrange(2, 7)):
            words[r.randrange(120)] = f"x{r.randrange(10**6)}"
        texts.append(" ".join(words))
    labels, materialize = [], near_dup.materialize
    monkeypatch.setattr(near_dup, "materialize", lambda df, label: (labels.append(label), materialize(df, label))[1])
    docs = dict(enumerate(texts))
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    found = {x.doc_id: x.component_id for x in near_dup.near_duplicates(df, percent=85).collect()}
    want = brute.near_components(docs, 85)
    # Links are confirmed, so components are parts of the true ones; five steps deep a pair at the threshold may be missed.
    assert all(want[c] == want[i] for i, c in found.items()) and sum(found[i] != want[i] for i in want) <= 2
    assert labels.count("open-rows") > 1 and labels.count("hub-links") == labels.count("large-nodes") == 1


def test_near_duplicates_edges(spark, odd, empty):
    found = near_dup.near_duplicates(odd).collect()
    assert len(found) == odd.count()
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    assert by_id[5].component_id == 4 and by_id[4].kept and not by_id[5].kept
    assert by_id[1].n_shingles == by_id[2].n_shingles == by_id[3].n_shingles == 0 and by_id[3].component_id == 3
    kept = near_dup.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    # Of the two equal rows one stays, the copy with the larger id goes, rows without words or an id stay.
    assert sorted(map(str, [r.doc_id for r in kept.collect()])) == ["1", "2", "3", "4", "6", "None", "None"]
    assert near_dup.near_duplicates(empty).collect() == [] and near_dup.drop_near_duplicates(empty).collect() == []
    words = _words(random.Random(4), 40_000)
    long = [(1, " ".join(words)), (2, " ".join([*words[:200], "changed", *words[200:]])), (3, "A b\tC d"), (4, "a B c\nd")]
    df = spark.createDataFrame(long, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_dup.near_duplicates(df).collect()} == {1: 1, 2: 1, 3: 3, 4: 3}


def test_recall_is_as_stated():
    assert near_dup.recall(0.85, 0.85, 8) > 0.9999 and near_dup.recall(0.8, 0.8, 8) > 0.9999
    assert near_dup.recall(0.85, 0.85, 8, steps=3) > 0.98


def test_substrings_query(spark, tables, texts):
    """Every document with a shared passage of more than 50 words is found, and none without one of 25."""

    def shared(n):
        seen = {}
        for i, t in texts.items():
            words = t.split(" ")
            for k in range(len(words) - n + 1):
                seen.setdefault(tuple(words[k : k + n]), set()).add(i)
        return set().union(*[v for v in seen.values() if len(v) > 1])

    found = {r.doc_id: r for r in QUERIES["op4_substring_dedup"](spark, tables).collect()}
    assert shared(51) <= set(found) <= shared(20)
    for i, r in found.items():
        assert r.n_repeated == sum(s.end - s.start for s in r.repeated) and r.n_removed <= r.n_repeated
        assert all(0 <= s.start < s.end <= len(texts[i]) for s in r.repeated)


def test_passages_resist_shifts(spark):
    r = random.Random(1)
    passage = " ".join(_words(r, 60, "pässage"))
    rows = [(k, " ".join(_words(r, 5 + 13 * k)) + " " + passage + " " + " ".join(_words(r, 40))) for k in range(6)]
    rows += [(10, " ".join(_words(r, 300))), (11, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in repeated_spans(df).collect()}
    assert set(found) == {0, 1, 2, 3, 4, 5, 11} and found[0].n_removed == 0
    for k in range(1, 6):
        (span,) = found[k].removed
        text = rows[k][1]
        # The texts may agree on a few characters beyond the passage.
        assert len(passage) - 150 < span.end - span.start < len(passage) + 20
        assert text[span.start + 20 : span.end - 20] in passage
    assert len(found[11].removed) == 1 and found[11].n_removed > 0.8 * len(rows[0][1])
    kept = {r.doc_id: r.text for r in dedup_substrings(df).collect()}
    assert kept[0] == rows[0][1] and kept[10] == rows[6][1]
    assert all(len(kept[k]) == len(rows[k][1]) - found[k].n_removed for k in range(1, 6))


def test_substrings_edges(spark, odd, empty):
    assert repeated_spans(odd).collect() == [] and repeated_spans(empty).collect() == []
    same = dedup_substrings(odd)
    assert same.columns == [*odd.columns, "n_removed"]
    assert sorted(map(str, same.drop("n_removed").collect())) == sorted(map(str, odd.collect()))
    flat = [(1, "a" * 50_000), (2, "b" + "a" * 50_000), (3, "é" * 3000), (None, "é" * 3000), (4, "é" * 10)]
    found = {r.doc_id for r in repeated_spans(spark.createDataFrame(flat, "doc_id long, text string")).collect()}
    assert found == {1, 2, 3, None}
