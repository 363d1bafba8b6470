from __future__ import annotations

import hashlib


from snapledger.llm import quality
from snapledger.llm.line_dedup import dedup_lines
from snapledger.llm.queries import QUERIES
from tests.llm import brute


def test_line_dedup_query(spark, tables, texts):
    want = brute.line_dedup(texts)
    for r in QUERIES["op1_line_dedup"](spark, tables).collect():
        kept, lines, dropped = want[r.doc_id]
        assert (r.n_lines, r.n_dropped) == (lines, dropped)
        assert r.kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()
    assert any(dropped for _, _, dropped in want.values())


def test_line_dedup_edges(spark, odd, empty):
    found = dedup_lines(odd, min_docs=2)
    assert found.count() == odd.count() and found.columns == [*odd.columns, "n_lines", "n_dropped"]
    by_id = {(r.doc_id, r.text): r for r in found.collect()}
    # The line of documents 4 and 5 goes, though 4 is there twice; blank lines have no key.
    assert by_id[4, ""].n_dropped == 1 and by_id[5, ""].n_dropped == 1
    assert by_id[3, " \n\t"].n_lines == 2 and by_id[2, ""].n_lines == 1
    assert by_id[6, "ünïcödé 字漢😀 \x85 x"]["a.b"].startswith("`a.b`")
    assert dedup_lines(empty).collect() == []
    # Case and white space at the ends don't count, nor does a repeated line of one document.
    rows = [(k, f" HELLO\t\nown {k}\nÀ") for k in range(5)] + [(9, "hello\nhello\nà\nt"), (10, "t\nt")]
    texts = dict(rows)
    want = brute.line_dedup(texts, min_docs=5)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in dedup_lines(df, min_docs=5).collect()} == want


def test_a_long_document_and_a_line_of_all(spark):
    long = "\n".join(f"line {k % 7000}" for k in range(30_000))
    rows = [(k, "common line\n" + (long if k == 3 else f"own {k}")) for k in range(40)]
    found = {r.doc_id: r for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[3].text == long and found[5].text == "own 5" and found[3].n_dropped == 1


def test_quality_query(spark, tables, texts):
    for r in QUERIES["op9_quality_rules"](spark, tables).collect():
        n, chars, symbols, dup, repeated = brute.measures(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeated)
        assert r.base_failed == (n < 10 or 100 * repeated > 20 * n)
        assert r.kept == brute.passes(texts[r.doc_id])


def test_quality_keeps_labelled_good_documents(spark, tables, texts):
    """Documents labelled good are kept unless a base rule rejects them; most of the others are not."""
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{tables}/labels.parquet").collect()}
    kept = {r.doc_id: (r.kept, r.base_failed) for r in QUERIES["op9_quality_rules"](spark, tables).collect()}
    assert all(kept[i][0] or kept[i][1] for i, q in labels.items() if q == 1)
    assert sum(not kept[i][0] for i, q in labels.items() if q == 0) >= 0.95 * sum(q == 0 for q in labels.values())


def test_quality_edges(odd, empty, spark):
    ledger = quality.quality_ledger(odd)
    assert ledger.count() == odd.count() and ledger.filter("failed is null or n_words is null").isEmpty()
    kept = quality.filter_quality(odd, policy="strict")
    assert kept.columns == odd.columns and kept.count() == 0
    assert quality.quality_ledger(empty).collect() == [] and quality.filter_quality(empty).columns == empty.columns
    cases = ["a b c d e a b c d e", "x " * 60_000, "a b c d e f a b c d e f a b c d e", "w\n" * 30, "one two three four five six"]
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    found = {r.doc_id: r for r in quality.quality_ledger(df).collect()}
    for i, text in enumerate(cases):
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.measures(text)


def test_policies_and_ablations(spark, documents):
    ledger = quality.quality_ledger(documents)
    rows = {(r.policy, r.rule): r for r in quality.ablations(ledger).collect()}
    for (policy, rule), r in rows.items():
        rules = quality.POLICIES[policy]
        without = tuple(x for x in rules if x != rule)
        assert r.n_docs == documents.count() and r.n_kept == ledger.filter(quality.passes(policy)).count()
        assert r.n_kept_without == ledger.filter(quality.passes(without)).count()
        assert r.n_failing == ledger.filter(~quality.passes((rule,))).count()
    assert {(r.n_docs, r.n_kept) for r in quality.ablations(ledger.limit(0)).collect()} == {(0, 0)}


def test_native(spark, tables):
    for name in ("op1_line_dedup", "op9_quality_rules"):
        plan = QUERIES[name](spark, tables)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_a_filter_on_the_ledger_stays_above_it(documents):
    plan = quality.filter_quality(documents)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("xxhash64") <= 2
