"""Personal data in texts: exact base patterns, and a semi-Markov conditional random field that adds spans.

The base patterns (email, ip, card, phone) are found in whole texts. Stretches of text around digits and at-signs are
then segmented by the field (``segment_model``), which knows more forms (numbers without a country code, grouped
cards, secrets after a key word) and decides boundaries and kinds jointly. Spans that it adds never touch a base span. Texts
are worked on where they lie; only stretches with a seed cost more than a scan.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger.llm.common import packed, unpacked
from snapledger.llm.pii_training import examples
from snapledger.llm.segment_model import SegmentModel

#: Kinds in the order of results; those of the base patterns come first.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")
#: Training examples of the field, drawn by the generator in ``pii_training``.
TRAINING_SIZE = 500
#: Characters on either side of a seed that the field sees.
REACH = 40
#: Characters from which a stretch is cut at the next space beside a letter, or else at the next space.
LONGEST = 4000
_APART = re.compile(r"(?<=[^\W\d_])\s|\s(?=[^\W\d_])")
_SPACE = re.compile(r"\s")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match takes whole runs of digits, so it can't begin inside one; that keeps long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_SEED = re.compile(r"[0-9@]")

Span = tuple[int, int, str]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, non-overlapping: an address begins where the run before its at-sign does, after the last match."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            done = domain.end()
            yield begin, done
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    """Whether the check digit fits."""
    doubled = [int(c) * 2 for c in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 * (d > 9) for d in doubled)) % 10 == 0


def _digits(text: str) -> str:
    return _NOT_DIGIT.sub("", text)


def _is_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def base_spans(text: str) -> list[Span]:
    """The base patterns' spans, by kind and begin; matches that fail their check are dropped without another try."""
    found: list[Span] = [(b, e, "email") for b, e in _emails(text)]
    if not _SEED.search(text):
        return found
    found += [(*m.span(), "ip") for m in _IP.finditer(text) if _is_ip(m[0])]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _digits(m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append((*m.span(), "card"))
    if "+" in text:
        found += [(*m.span(), "phone") for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return found


# --- features of whole spans -------------------------------------------------------------------------------------

_WORD_BEFORE = re.compile(r"([^\W\d_]+)[\s:=\"'#.(]*\Z")
#: Words that announce an entity.
_CUES = {
    "phone": "call phone tel telephone fax mobile cell dial sms whatsapp".split(),
    "card": "card visa mastercard credit debit pan".split(),
    "ip": "ip host server address gateway dns subnet".split(),
    "email": "email mail contact write to".split(),
    "secret": "token key secret password passwd pwd apikey bearer credential".split(),
}
_CUE_OF = {word: kind for kind, words in _CUES.items() for word in words}
_SHAPES = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("spelt", re.compile(r"[A-Za-z0-9._%+-]+ ?[\[(]?(at|@)[\])]? ?[A-Za-z0-9-]+( ?[\[(]?(dot|\.)[\])]? ?[A-Za-z0-9-]+)+", re.I)),
    ("quad", re.compile(r"[0-9]{1,3}(\.[0-9]{1,3}){3}")),
    ("grouped", re.compile(r"[0-9]{4}([ -]?[0-9]{4}){3}")),
    ("plain", re.compile(r"[0-9]+")),
    ("national", re.compile(r"\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-][0-9]{4}")),
    ("international", re.compile(r"\+[0-9]{1,3}[ .(-]*[0-9]([0-9 ().-]*)[0-9]")),
    ("date", re.compile(r"[0-9]{1,4}[-/.][0-9]{1,2}[-/.][0-9]{1,4}")),
    ("hex", re.compile(r"[0-9a-f]{32,}|[0-9A-F]{32,}")),
    ("mixed", re.compile(r"(?=[^\s]*[0-9])(?=[^\s]*[A-Za-z])[A-Za-z0-9_/+=-]{20,}")),
)


def may_be_entity(span: str) -> bool:
    """Whether a span may be an entity at all: enough digits, an address, or a long mixed run."""
    if len(span) < 7 or len(span) > 120:
        return False
    if "@" in span:
        return True
    n = sum(map(span.count, "0123456789"))
    return n >= 7 or (n >= 4 and span.count(".") == 3) or (len(span) >= 20 and n > 0 and " " not in span)


def span_features(text: str, begin: int, end: int) -> list[str]:
    """Names of the features of a span and of what stands around it."""
    span = text[begin:end]
    digits = _digits(span)
    names = ["bias", f"digits{min(len(digits), 20)}"]
    shapes = [name for name, pattern in _SHAPES if pattern.fullmatch(span)]
    names += [f"shape:{s}" for s in shapes] or ["shape:none"]
    if "quad" in shapes and _is_ip(span):
        names.append("ip")
    if 13 <= len(digits) <= 19:
        names.append(f"luhn{luhn(digits)}")
    letters = sum(c.isalpha() for c in span)
    names.append("letters" if letters else "no-letters")
    names += [f"has{c}" for c in " .-(:/,_" if c in span]
    names.append(f"opens{'+' if span[0] == '+' else 'd' if span[0].isdigit() else 'a' if span[0].isalpha() else 'x'}")
    names.append(f"closes{'d' if span[-1].isdigit() else 'a' if span[-1].isalpha() else 'x'}")
    left, right = text[begin - 1 : begin], text[end : end + 1]
    if left.isalnum() or left in set("._-@/+"):
        names.append("cut-left" if left else "edge-left")
    if right.isalnum() or (right in set("._-@/") and text[end + 1 : end + 2].isalnum()):
        names.append("cut-right")
    # More digits of the same number beyond a space or bracket.
    if re.match(r"[ ().-]{1,2}[0-9]", text[end : end + 3]):
        names.append("more-right")
    if re.search(r"[0-9+][ ().-]{1,2}\Z", text[max(0, begin - 3) : begin]):
        names.append("more-left")
    word = _WORD_BEFORE.search(text[max(0, begin - 24) : begin])
    cue = _CUE_OF.get(word[1].lower(), "other") if word else "none"
    names.append(f"cue:{cue}")
    names += [f"cue:{cue}+{s}" for s in shapes]
    return names


@lru_cache(maxsize=2)
def trained_model(size: int = TRAINING_SIZE, seed: int = 5) -> SegmentModel:
    """The field, fitted on ``size`` generated examples; the same on every run."""
    model = SegmentModel(KINDS, span_features, may_be_entity)
    model.fit(examples(size, seed))
    return model


def _stretches(text: str) -> Iterator[tuple[int, int]]:
    """The parts of a text that the field sees, long ones cut where no entity is likely to go on."""
    for begin, end in _around_seeds(text):
        while end - begin > LONGEST:
            cut = _APART.search(text, begin + LONGEST, end) or _SPACE.search(text, begin + LONGEST, end)
            if not cut:
                break
            yield begin, cut.start()
            begin = cut.end()
        yield begin, end


def _around_seeds(text: str) -> Iterator[tuple[int, int]]:
    """Parts of lines within REACH characters of a seed, ending between words where they can."""
    begin = end = -1
    for m in _SEED.finditer(text):
        if m.start() >= end:
            if end >= 0:
                yield begin, end
            line = text.rfind("\n", 0, m.start()) + 1
            begin = max(line, end if end >= 0 else 0, m.start() - REACH)
            cut = text.find(" ", begin, m.start())
            # A run without spaces longer than the reach is seen from where the reach begins.
            begin = cut + 1 if begin > line and cut >= 0 else begin
        stop = text.find("\n", m.start())
        end = min(len(text) if stop < 0 else stop, m.end() + REACH)
        cut = text.find(" ", end)
        end = end if cut < 0 or cut - end > REACH else min(cut, len(text) if stop < 0 else stop)
    if end >= 0:
        yield begin, end


def find_spans(text: str, model: SegmentModel) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans: the base ones and those that the field adds beside them; by kind and begin."""
    base = base_spans(text)
    taken = sorted((b, e) for b, e, _ in base)
    begins, reached = [b for b, _ in taken], list(accumulate((e for _, e in taken), max))
    added: list[Span] = []
    for begin, end in _stretches(text):
        for b, e, kind in model.decode(text[begin:end]):
            b, e = b + begin, e + begin
            before = bisect_left(begins, e)
            if not before or reached[before - 1] <= b:
                added.append((b, e, kind))
    every = sorted([*base, *added], key=lambda s: (KINDS.index(s[2]), s[0]))
    return base, every


SPANS = T.ArrayType(
    T.StructType([T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("kind", T.StringType())])
)


def find_personal_data(docs: DataFrame, text_col: str = "text", training_size: int = TRAINING_SIZE) -> DataFrame:
    """Every input row with ``base_spans`` and ``all_spans``: arrays of ``begin``, ``end`` (excluded) and ``kind``.

    Offsets count code points. Both are ordered by kind (email, ip, card, phone, secret) and begin.

    * Null and empty texts have no spans. Spans of one base kind don't overlap; those of different kinds may.
    * Input columns of these names are replaced; repeated rows stay; an empty table stays empty.
    * The field is fitted on ``training_size`` generated examples, no rows of the table.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trained_model(training_size))
    rows = docs.select(packed(docs, ["base_spans", "all_spans"]), F.col(f"`{text_col}`").alias("_text"))
    kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            base, every = [], []
            for text in batch.column("_text"):
                b, e = find_spans(text.as_py() or "", model)
                base.append([dict(zip(("begin", "end", "kind"), s, strict=True)) for s in b])
                every.append([dict(zip(("begin", "end", "kind"), s, strict=True)) for s in e])
            columns = [batch.column("_row"), pa.array(base, kind), pa.array(every, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["_row", "base_spans", "all_spans"])

    schema = T.StructType([rows.schema["_row"], T.StructField("base_spans", SPANS), T.StructField("all_spans", SPANS)])
    out = rows.mapInArrow(found, schema)
    return out.select(*unpacked(out), "base_spans", "all_spans")


def digest(spans: list[Span]) -> str:
    """What the query prints of spans, for tests."""
    return hashlib.sha256(",".join(f"{k}:{b}:{e}" for b, e, k in spans).encode()).hexdigest()


def redact(found: DataFrame, text_col: str = "text", spans_col: str = "all_spans") -> DataFrame:
    """Rows of ``find_personal_data`` with every span of their text replaced by its kind in angle brackets.

    Where spans of different kinds overlap, the first counts, and the longest of those that begin together.
    """
    order = F.array_sort(
        F.transform(spans_col, lambda s: F.struct(s["begin"].alias("b"), (-s["end"]).alias("e"), s["kind"].alias("k")))
    )
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(done, s):
        text = F.col(f"`{text_col}`")
        piece = F.concat(done["out"], F.substring(text, done["at"] + 1, s["b"] - done["at"]), F.lit("<"), s["k"], F.lit(">"))
        return F.when(s["b"] < done["at"], done).otherwise(F.struct(piece.alias("out"), (-s["e"]).alias("at")))

    cut = F.aggregate(order, start, step)
    ranged = found.withColumn("_cut", cut)
    rest = F.substring(F.col(f"`{text_col}`"), F.col("_cut.at") + 1, F.length(f"`{text_col}`"))
    return ranged.withColumn(text_col, F.concat("_cut.out", rest)).drop("_cut")
