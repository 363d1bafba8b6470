from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from snapledger.llm import runs
from snapledger.llm.queries import QUERIES
from tests.llm import brute


def _sequence(r):
    kinds, n = r.choice([1, 2, 3, 5]), r.choice([0, 1, 5, 6, 7, 12, 30, 60, 150])
    words = [r.randrange(kinds) for _ in range(n)]
    if r.random() < 0.5 and n > 10:
        a = r.randrange(n)
        p = 1 + r.randrange(max(1, (n - a) // 2 + 1))
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return np.array(words, np.int64)


@pytest.mark.parametrize(("min_words", "min_times"), [(6, 4), (3, 2), (5, 3)])
def test_runs_of_many_sequences(min_words, min_times):
    r = random.Random(min_words)
    for _ in range(500):
        sequences = [_sequence(r) for _ in range(r.randrange(1, 5))]
        found = runs.runs_of(sequences, min_words, min_times)
        expected = [(k, *x) for k, s in enumerate(sequences) for x in brute.runs(s.tolist(), min_words, min_times)]
        assert list(zip(*[f.tolist() for f in found], strict=True)) == expected


def test_agreement_in_both_directions():
    r = random.Random(4)
    for _ in range(100):
        words = [100, *[r.randrange(2) for _ in range(r.randrange(2, 80))], 101]
        grammar = runs.Grammar(np.array(words))
        a, b = np.array([(i, j) for i in range(1, len(words) - 1) for j in range(i + 1, len(words) - 1)]).reshape(-1, 2).T
        forward, backward = grammar.agreement(a, b), grammar.agreement(a, b, forward=False)
        for i, j, f, k in zip(a, b, forward, backward, strict=True):
            assert words[i : i + f] == words[j : j + f] and words[i + f] != words[j + f]
            assert words[i - k + 1 : i + 1] == words[j - k + 1 : j + 1] and words[i - k] != words[j - k]


def test_long_texts():
    """Long blocks, long periods and a word that is all there is are whole runs; nothing is cut at a slice's end."""
    once = [f"w{i}" for i in range(3000)]
    texts = [" ".join(once * 5), "x " * 400_000, " ".join(["a"] * 999 + ["b"]) * 4]
    _, found, kept = runs.slice_runs([t.encode() for t in texts], 6, 4)
    assert [[tuple(x.values()) for x in f] for f in found.to_pylist()] == [
        [(0, 15_000, 3000)], [(0, 400_000, 1)], brute.runs(texts[2].split()),
    ]
    assert kept[0].decode() == " ".join(once) and kept[1] == b"x"


def test_periodic_runs_query(spark, tables, texts):
    planted = 0
    for r in QUERIES["op13_periodic_runs"](spark, tables).collect():
        words = brute.WORD.findall(texts[r.doc_id] or "")
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
        found = brute.runs(words)
        best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=None)
        assert (r.n_words, r.n_runs) == (n, len(found))
        assert (r.start, r.length, r.period) == (best or (None,) * 3)
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)
        lines = "".join(f"{s},{k},{q}\n" for s, k, q in found)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(brute.collapsed(words, found).encode()).hexdigest()
    assert planted > 10


def test_runs_edges(spark, odd, empty):
    found = runs.find_runs(odd.withColumn("runs", odd["lang"]))
    others = [c for c in odd.columns if c != "n_words"]
    assert found.columns == [*others, "n_words", "runs", "collapsed"] and found.count() == odd.count()
    assert all(r.runs == [] and r.collapsed == " ".join(brute.WORD.findall(r.text or "")) for r in found.collect())
    assert runs.find_runs(empty).collect() == []
    once = runs.find_runs(odd, keep=["doc_id", "a.b"])
    assert once.columns == ["doc_id", "a.b", "n_words", "runs", "collapsed"]
    rows = spark.createDataFrame([(1, "a b " * 4), (1, "a b " * 4), (2, "\x85 \x85 \x85 \x85 \x85 \x85")], "id long, text string")
    assert [len(r.runs) for r in runs.find_runs(rows).collect()] == [1, 1, 1]
    with pytest.raises(ValueError):
        runs.find_runs(rows, min_times=1)


def test_null_ids_and_texts_in_the_query(spark, tmp_path):
    rows = [(None, "a b c d e f g h"), (None, None), (1, ""), (2, " \n "), (3, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()
    assert len(found) == 5 and all(r.collapsed_sha256 and r.runs_sha256 for r in found)
