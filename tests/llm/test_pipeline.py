from __future__ import annotations

import hashlib

import numpy as np

import corpus_pipeline
from tests.llm import brute


def _stored(spark, df, path):
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_stages_against_brute_force(spark, tables, tmp_path):
    """Each stage on what the one before kept, as rows written and read again."""
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns, schema = docs.columns, docs.schema
    items = [r.text for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    texts = {r.doc_id: r.text for r in docs.collect()}
    library = brute.byte_bpe()
    for name, stage in corpus_pipeline.STAGES:
        out = _stored(spark, stage(spark, docs, tables), f"{tmp_path}/{name}")
        if name == "quality_rules":
            texts = {i: t for i, t in texts.items() if brute.passes(t)}
        elif name == "line_dedup":
            texts = {i: kept for i, (kept, _, _) in brute.line_dedup(texts, corpus_pipeline.MIN_DOCS).items()}
        elif name == "near_duplicates":
            comps = brute.near_components(texts, corpus_pipeline.NEAR_PERCENT)
            texts = {i: t for i, t in texts.items() if comps[i] == i}
        elif name == "decontamination":
            texts = {i: t for i, t in texts.items() if not any(brute.holds_item(t, item) for item in items)}
        if name == "byte_bpe":
            found = {r.doc_id: r for r in out.collect()}
            assert set(found) == set(texts)
            for i, text in texts.items():
                ids = np.array(library.encode_ordinary(text), "<u4").tobytes()
                assert bytes(found[i].token_ids) == ids and found[i].n_tokens == len(ids) // 4
                assert found[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        else:
            assert out.columns == columns and out.schema == schema
            rows = out.collect()
            assert {r.doc_id: r.text for r in rows} == texts and len(rows) == len(texts)
            assert all(r.n_chars == len(r.text) for r in rows)
        docs = out
    assert len(texts) > 20


def test_run(spark, tables):
    out = corpus_pipeline.run(spark, tables)
    assert out.count() > 20 and {"doc_id", "n_tokens", "token_ids"} <= set(out.columns)


def test_odd_rows_and_empty_tables(spark, odd, empty, tables):
    docs = odd.withColumns({"source": odd["lang"], "n_chars": odd["doc_id"]})
    for rows in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, tables)
            kept = out.collect()
            assert name == "byte_bpe" or out.columns == rows.columns
            assert len(kept) == (0 if name == "quality_rules" else 7 if name == "near_duplicates" else 9) or rows.isEmpty()


def test_groups_of_copies_keep_a_text(spark, tmp_path):
    """Groups of exact copies leave one document, also beside near copies that share all of their lines; footers go."""
    word = lambda n: "".join(chr(97 + (n >> 4 * k) % 16) for k in range(3))
    line = lambda n: " ".join(word(n * 20 + k) for k in range(20)) + "."
    copied, beside, footer = f"{line(1)}\n{line(2)}", f"{line(3)}\n{line(4)}", "Read more about this on our pages."
    texts = [copied] * 25 + [beside] * 12
    texts += [f"{line(3)}\n{line(40 + k)}" for k in range(12)] + [f"{line(4)}\n{line(60 + k)}" for k in range(12)]
    texts += [f"{line(80 + k)}\n{footer}" for k in range(15)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = _stored(spark, stage(spark, docs, ""), f"{tmp_path}/{name}")
    found = {r.doc_id: r.text for r in docs.collect()}
    assert found[0] == copied and found[25] == beside
    assert list(found.values()).count(copied) == list(found.values()).count(beside) == 1
    assert all(found.values()) and not any(footer in t for t in found.values())
    assert len(found) == 2 + 24 + 15
