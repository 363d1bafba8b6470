from __future__ import annotations

import random
import textwrap
import tracemalloc

import numpy as np
import pyarrow as pa

from snapledger.llm import decontaminate, license_scan, wordhash
from snapledger.llm.decontaminate import drop_leaks, find_leaks
from snapledger.llm.license_templates import TEMPLATES, UNRELATED
from snapledger.llm.queries import QUERIES
from tests.llm import brute

QUESTION = (
    "If {n} has {a} apples and walks {b} km with {m} to the old market where {n} buys {c} pears"
    " then how many fruits does {n} carry home?"
)


def _question(n="Tom", m="Ann", a=3, b=5, c=12):
    return QUESTION.format(n=n, m=m, a=a, b=b, c=c)


def test_leaks_query(spark, tables, texts):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()}
    want = {(i, k) for i, t in texts.items() for k, item in items.items() if brute.holds_item(t, item)}
    found = QUERIES["op7_decontamination"](spark, tables).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want and want
    assert all(r.verbatim for r in found)


def test_other_names_and_numbers(spark):
    items = spark.createDataFrame([(1, _question()), (2, "two words"), (3, None), (4, " .. "), (2, "two words")], "item_id int, text string")
    swapped = _question("Bob", "Eve").replace("Bob buys", "Jim buys").replace("Bob carry", "Kim carry")
    rows = [
        (1, "Look: " + _question("Bob", "Eve", "seven", 1.5, 99)), (2, swapped), (3, "these TWO words, here"), (4, None), (5, ""),
        (6, _question().upper()), (None, "two\nwords"), (7, _question("Bob", "Eve", 4, 4, 4) + " " + "filler " * 20_000), (8, "two other words"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.item_id): r.verbatim for r in find_leaks(docs, items).collect()}
    # Fillers that change within a text are another question.
    assert found == {(1, 1): False, (6, 1): True, (7, 1): False, (3, 2): True, (None, 2): True}
    assert sorted(r.doc_id for r in drop_leaks(docs, items).collect()) == [2, 4, 5, 8]


STORY = "{n} has {a} apples. {m} has {b} pears. {n} gives {m} {c} apples. How many apples does {n} have now?"


def test_names_at_sentence_starts_and_slot_rich_windows(spark):
    story = lambda n, m, a, b, c: STORY.format(n=n, m=m, a=a, b=b, c=c)
    sums = "What is {} + {} * {} - {} ?"
    items = spark.createDataFrame(
        [(1, story("Tom", "Ann", 5, 3, 2)), (2, sums.format(12, 7, 3, 4)), (3, "He came home at noon. He then ate two old apples slowly.")],
        "item_id int, text string",
    )
    unsteady = story("Zoe", "Bob", 9, 8, 7).replace("Zoe gives", "Max gives").replace("does Zoe", "does Ida")
    rows = [
        (1, story("Zoe", "Bob", 9, 8, 7)), (2, "Well. " + sums.format(1, 2, 30, 5) + " Please say."), (3, unsteady),
        (4, "Tom has apples and pears and gives some of them to Ann. How many does he have now?"), (5, "What is it? 12 7 3 4"),
        (6, "She came home at noon. She then ate three old apples slowly."), (7, "Mia came home at noon. Lou then ate three old apples slowly."),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.item_id): r.verbatim for r in find_leaks(docs, items).collect()}
    assert found == {(1, 1): False, (2, 2): False, (6, 3): False}


def test_leaks_edges(spark, odd, empty):
    items = spark.createDataFrame([(None, "same text here"), (None, None)], "item_id int, text string")
    found = find_leaks(odd, items).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(4, None), (5, None)]
    clean = drop_leaks(odd, items)
    assert clean.columns == odd.columns and clean.count() == odd.count() - 3
    assert find_leaks(empty, items).collect() == [] and drop_leaks(empty, items).collect() == []
    assert find_leaks(odd, items.limit(0)).collect() == [] and drop_leaks(odd, items.limit(0)).count() == odd.count()


def test_license_classifier_on_held_out_paragraphs():
    model = license_scan.trained_licenses()
    right = wrong = missed = 0
    for text, family in license_scan.generated(seed=1234):
        (_, paragraphs), = license_scan.paragraphs_of(pa.array([text]))
        found = {f[1] for f in model.scan(paragraphs)}
        right += found == ({family} if family else set())
        wrong += bool(found - {family})
        missed += bool(family) and not found
    total = right + wrong + missed
    assert right / total > 0.9 and wrong / total < 0.01


def test_licenses_query(spark, tables, texts):
    notices = {
        "Released under the MIT License.": "mit",
        "Licensed under the Apache License, Version 2.0.": "apache",
        "This work is licensed under the GNU General Public License, version 3.": "gpl",
        "Licensed under CC BY-NC 4.0.": "cc-by-nc",
        "All rights reserved.": "proprietary",
    }
    want = {(i, family): t.split("\n").index(n) for i, t in texts.items() for n, family in notices.items() if n in t.split("\n")}
    found = {(r.doc_id, r.family): r.first_line for r in QUERIES["op2_license_scan"](spark, tables).collect()}
    assert found == want and want


def test_licenses_edges(spark, odd, empty):
    assert license_scan.scan_licenses(odd).collect() == [] and license_scan.scan_licenses(empty).collect() == []
    long = " ".join(UNRELATED * 40)
    rows = [(1, f"{long}\nx\nReleased under the MIT license"), (1, "All rights reserved."), (None, "Released under the MIT License.\n" * 3), (2, long)]
    # A notice in the middle of a long line is found, too.
    rows.append((3, f"{long} This work is licensed under the GNU General Public License, version 3. {long}"))
    found = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = {(r.doc_id, r.family, r.n_paragraphs, r.first_line) for r in found}
    assert got == {(1, "mit", 1, 2), (1, "proprietary", 1, 0), (None, "mit", 3, 0), (3, "gpl", 1, 0)}


def test_wrapped_notices(spark):
    """Every template wrapped at 72 columns, plain and in comments, is found where it begins."""
    rows, want = [], set()
    for family, name, text in TEMPLATES:
        for mark in ("", "# ", " * ", "// "):
            lines = ["Some words about the house.", "", *textwrap.wrap(text, 72), "", "And others, of the garden."]
            rows.append((f"{name}{mark}", "\n".join(mark + x for x in lines)))
            want.add((f"{name}{mark}", family, 1, 2))
    # Prose in the same paragraph before it.
    text = "\n".join([*textwrap.wrap(" ".join(UNRELATED[:6]), 72), *textwrap.wrap(TEMPLATES[2][2], 72)])
    rows.append(("amid", text))
    want.add(("amid", "mit", 1, len(textwrap.wrap(" ".join(UNRELATED[:6]), 72))))
    rows += [("none", "\n".join(textwrap.wrap(" ".join(UNRELATED * 3), 72))), ("parted", "Licensed under\n\nCC BY 4.0.")]
    found = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert {(r.doc_id, r.family, r.n_paragraphs, r.first_line) for r in found} == want


def test_a_worker_holds_slices_only():
    """Memory doesn't follow the batch: over 10 MB of texts give the same windows as text by text, within 80 MB besides."""
    r = random.Random(9)
    base = [" ".join(f"Word{r.randrange(5000)} of {r.randrange(90)} kg." for _ in range(12_000)) for _ in range(8)]
    texts = pa.array([*base, None, "", *6 * base, "a short one"])
    assert texts.nbytes > 10e6

    def keys(column):
        out = []
        for _, _, words in wordhash.text_slices(column, lower=False):
            found, _, _ = decontaminate._keys(decontaminate.Tokens(words), 8)
            out.append(int(np.bitwise_xor.reduce(found, initial=0)))
        return int(np.bitwise_xor.reduce(np.array(out, np.uint64), initial=0))

    singly = 0
    for k in range(8, len(texts)):
        singly ^= keys(texts.slice(k, 1))
    wordhash._powers.cache_clear()
    tracemalloc.start()
    together = keys(texts.slice(8))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert together == singly and peak < 80e6
