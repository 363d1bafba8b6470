"""Quality rules as a ledger of failure bits and measurements. DataFrame functions only.

Every rule is evaluated once per document: what it measured is kept as columns and whether it failed
as one bit of ``failed``. Policies are versions of a bit mask, so a policy is applied, compared or
ablated with bitwise operations on the stored ledger, without reading a text again. A row's
measurements come from that row alone: no shuffle, whatever the sizes of documents.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import SPACE_CLASS, SPACES, packed, unpacked

#: Words of a window whose repetition is counted.
WINDOW = 5

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_distinct_words", "n_lines",
)


def _rules() -> dict[str, Column]:
    """The condition under which each rule fails, in whole numbers; the place is the bit."""
    n = {name: F.col(name) for name in MEASURES}
    return {
        "few_words": n["n_words"] < 10,
        "repeated_words": 100 * n["n_repeat_words"] > 20 * n["n_words"],
        "symbols": 10 * n["n_symbols"] > n["n_words"],
        "capitals": 2 * n["n_capitals"] > n["word_chars"],
        "repeated_lines": 2 * n["n_dup_lines"] > n["n_lines"],
        "poor_vocabulary": 50 * n["n_distinct_words"] < n["n_words"],
        "short_words": n["word_chars"] < 2 * n["n_words"],
        "long_words": n["word_chars"] > 20 * n["n_words"],
    }


RULES = (
    "few_words", "repeated_words", "symbols", "capitals", "repeated_lines", "poor_vocabulary", "short_words", "long_words",
)
BASE = ("few_words", "repeated_words")

#: Versioned policies: the rules whose failure rejects a document.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": BASE,
    "v1": (*BASE, "symbols", "capitals"),
    "v2": (*BASE, "symbols", "capitals", "repeated_lines", "poor_vocabulary"),
    "strict": RULES,
}
CURRENT = "v2"


def mask(policy: str | tuple[str, ...]) -> int:
    """The bits of a policy, by name or as its rules."""
    rules = POLICIES[policy] if isinstance(policy, str) else policy
    return sum(1 << RULES.index(r) for r in rules)


def _measured(docs: DataFrame, text_col: str) -> DataFrame:
    """``_row`` and the measurements of its text."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    stripped = F.btrim(text, F.lit(SPACES))
    words = F.when(stripped == "", F.array().cast("array<string>")).otherwise(F.split(stripped, f"{SPACE_CLASS}+", -1))
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    replaced = [*MEASURES, "failed"]
    # Each stage is a projection of its own: what several later columns use is computed once.
    split = docs.select(packed(docs, replaced), text.alias("_text"), words.alias("_words"), lines.alias("_lines"))
    w = F.col("_words")
    starts = F.when(F.size(w) >= WINDOW, F.sequence(F.lit(0), F.size(w) - WINDOW)).otherwise(F.array().cast("array<int>"))
    windows = F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))
    counted = split.select(
        "_row",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.regexp_count("_text", F.lit("[A-Z]")).cast("long").alias("n_capitals"),
        F.size(F.array_distinct("_words")).cast("long").alias("n_distinct_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        windows.alias("_windows"),
    )
    return _with_repeats(counted)


def _with_repeats(counted: DataFrame) -> DataFrame:
    """Add ``n_repeat_words``: words in windows that occur twice or more.

    Most texts repeat no window, which one pass over the hashes shows; only the others are sorted.
    """
    h = F.col("_windows")
    repeats = F.size(F.array_distinct(h)) < F.size(h)
    placed = F.sort_array(F.transform(h, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    ordered = counted.withColumn("_placed", F.when(repeats, placed)).drop("_windows")
    p = F.col("_placed")

    def twice(x: Column, i: Column) -> Column:
        before, after = F.get(p, i - 1)["g"], F.get(p, i + 1)["g"]
        return F.coalesce(before == x["g"], F.lit(False)) | F.coalesce(after == x["g"], F.lit(False))

    starts = F.sort_array(F.transform(F.filter(p, twice), lambda x: x["i"]))
    marked = ordered.withColumn("_starts", F.when(p.isNotNull(), starts)).drop("_placed")
    s = F.col("_starts")
    # A start covers its window up to the next start.
    new_words = F.transform(s, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(s, i + 1) - x, F.lit(WINDOW))))
    total = F.aggregate(new_words, F.lit(0).cast("long"), lambda a, x: a + x)
    return marked.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long"))).drop("_starts")


def quality_ledger(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Every input row with its measurements (long) and ``failed``, one bit per rule that it fails.

    * Null or empty text has no words and fails ``few_words``; ratios are compared as products of whole
      numbers, so nothing is divided by zero.
    * Input columns with the names of measurements or ``failed`` are replaced. Repeated rows stay.
    * Windows are compared by 64-bit hashes within one text. An empty table gives an empty ledger.
    """
    measured = _measured(docs, text_col)
    rules = _rules()
    bits = sum(
        (F.when(rules[r], F.lit(1 << k)).otherwise(F.lit(0)) for k, r in enumerate(RULES)), F.lit(0)
    )
    # The condition always holds. A term that counts as not deterministic keeps the optimizer from copying the
    # measurements into filters on the ledger, where every element of an array would compute its array anew.
    once = F.when(F.spark_partition_id() >= 0, bits.cast("long"))
    return measured.select(*unpacked(measured), *MEASURES, once.alias("failed"))


def passes(policy: str | tuple[str, ...] = CURRENT) -> Column:
    """Whether a row of the ledger meets the policy."""
    return F.col("failed").bitwiseAND(F.lit(mask(policy))) == 0


def filter_quality(docs: DataFrame, text_col: str = "text", policy: str = CURRENT) -> DataFrame:
    """The rows of ``docs`` that meet the policy, with their own columns."""
    marked = docs.select(packed(docs, []), F.col(f"`{text_col}`").alias("_quality_text"))
    kept = quality_ledger(marked, "_quality_text").filter(passes(policy))
    return kept.select(*unpacked(kept))


def ablations(ledger: DataFrame, policies: Mapping[str, tuple[str, ...]] = POLICIES) -> DataFrame:
    """Per policy and rule in it: documents in all, kept, failing the rule, and kept if it were dropped.

    One aggregation over the ledger: each count is a sum over a bitwise test, and only one row leaves
    each task. A ledger without rows gives zeros.
    """
    failed, sums, rows = F.col("failed"), [F.count(F.lit(1)).alias("n")], []

    def count(name: str, condition: Column) -> None:
        sums.append(F.coalesce(F.sum(condition.cast("long")), F.lit(0)).alias(name))

    for v, (policy, rules) in enumerate(policies.items()):
        whole = mask(rules)
        count(f"kept_{v}", failed.bitwiseAND(F.lit(whole)) == 0)
        for rule in rules:
            bit = mask((rule,))
            count(f"fails_{v}_{rule}", failed.bitwiseAND(F.lit(bit)) != 0)
            count(f"without_{v}_{rule}", failed.bitwiseAND(F.lit(whole - bit)) == 0)
            names = (F.col("n"), F.col(f"kept_{v}"), F.col(f"fails_{v}_{rule}"), F.col(f"without_{v}_{rule}"))
            fields = ("n_docs", "n_kept", "n_failing", "n_kept_without")
            rows.append(
                F.struct(
                    F.lit(policy).alias("policy"),
                    F.lit(rule).alias("rule"),
                    *[c.alias(f) for c, f in zip(names, fields, strict=True)],
                )
            )
    return ledger.agg(*sums).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
