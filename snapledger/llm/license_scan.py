"""Licence scan: a trained paragraph classifier with a calibrated unknown class, confirmed by templates.

A paragraph is a line, and so are consecutive lines with words together, as notices are often hard-wrapped; long ones are
taken in overlapping windows. Its features are the distinct word unigrams and bigrams, weighted
by the square root of their number, so that a stray word in a long paragraph counts little. Multinomial logistic regression
over the families and "unknown" is fitted on variations of the templates and of sentences that resemble them; a
temperature fitted on variations held out makes its probabilities honest, and a family is predicted only
if its probability reaches ``LEAST_PROBABILITY``. A prediction counts if enough of one of the family's templates stands in
the paragraph. Texts are scanned where they lie; a paragraph without a feature of the model is unknown without more work.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import row_key
from snapledger.llm.decontaminate import Tokens
from snapledger.llm.license_templates import TEMPLATES, UNRELATED
from snapledger.llm.wordhash import mix, text_slices

#: Words of a window of a long paragraph, and words from one window to the next.
WINDOW, STRIDE = 32, 16
#: Variations of each template and of each unrelated sentence to learn from; as many again calibrate.
VARIATIONS = 6
LEAST_PROBABILITY = 0.5
#: Share of a template's bigrams that a window must hold, of at most as many as fit in well.
LEAST_COVER = 0.6
MOST_BIGRAMS = 24

UNKNOWN = "unknown"
FAMILIES = (UNKNOWN, *dict.fromkeys(family for family, _, _ in TEMPLATES))


class Paragraphs:
    """Windows over the lines of a slice of texts, with the hashes of their unigrams and bigrams.

    ``lines`` are the line numbers of the tokens, ``first_line`` those of the texts' beginnings, in the slice. ``joined`` are
    the windows over consecutive lines: a line without words ends a paragraph, marks that stand alone are no words.
    """

    def __init__(self, tokens: Tokens, lines: np.ndarray, first_line: np.ndarray, across: int = 0):
        self.first_line, self.lines = first_line, lines
        n = len(tokens.plain)
        new = np.ones(n, bool)
        new[1:] = (tokens.text[1:] != tokens.text[:-1]) | (lines[1:] - lines[:-1] > across)
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], n)[: len(starts)]
        size = ends - starts
        count = np.where(size <= WINDOW, 1, -(-(size - WINDOW) // STRIDE) + 1)
        step = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        self.start = np.repeat(starts, count) + step * STRIDE
        self.end = np.minimum(self.start + WINDOW, np.repeat(ends, count))
        self.text, self.line = tokens.text[self.start], lines[self.start]
        self.unigrams = tokens.plain
        self.bigrams = np.zeros(n, np.uint64)
        if n > 1:
            self.bigrams[:-1] = mix(tokens.plain[:-1] + mix(tokens.plain[1:] + np.uint64(3)))
        # The last word of a paragraph has no bigram.
        self.paired = np.append(~new[1:], False) if n else np.zeros(0, bool)
        self._found: tuple[np.ndarray, list] | None = None
        self.joined = None if across else Paragraphs(tokens, lines, first_line, across=1)

    def _lookup(self, known: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Feature numbers and hits of all unigrams and bigrams; found once for lines and joined lines."""
        if self._found is None or self._found[0] is not known:
            found = []
            for hashes in (self.unigrams, self.bigrams):
                number = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                found.append((number, known[number] == hashes))
            self._found = known, found
            if self.joined is not None:
                self.joined._found = self._found
        return self._found[1]

    def features(self, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window and feature number of every distinct feature of the sorted hashes ``known`` that a window has."""
        places, numbers = [], []
        for (found, hit), usable, width in zip(self._lookup(known), (None, self.paired), (1, 2), strict=True):
            at = np.flatnonzero(hit if usable is None else hit & usable)
            # A token lies in at most two windows: the last that begins before it, and the one before that.
            last = np.searchsorted(self.start, at, side="right") - 1
            for back in (0, 1):
                window = last - back
                fits = (window >= 0) & (at + width <= self.end[np.maximum(window, 0)]) & (at >= self.start[np.maximum(window, 0)])
                places.append(window[fits])
                numbers.append(found[at[fits]])
        pairs = np.unique(np.concatenate(places) * len(known) + np.concatenate(numbers))
        return pairs // len(known), pairs % len(known)

    def norms(self) -> np.ndarray:
        return np.sqrt(2.0 * (self.end - self.start))


def paragraphs_of(texts: pa.Array) -> Iterator[tuple[int, Paragraphs]]:
    """For slices of texts the first one's place and their paragraphs."""
    for first, _, words in text_slices(texts, lower=False):
        tokens = Tokens(words)
        breaks = np.append(0, np.cumsum(words.data == 10))
        yield first, Paragraphs(tokens, breaks[tokens.starts], breaks[words.texts_at[:-1]])


def _varied(text: str, r: random.Random) -> str:
    """The wording with words lost, exchanged and added, in other letters, and amid other words."""
    words = [w for w in text.split() if r.random() > 0.08]
    words = [re.sub(r"[\d.]+", str(r.randint(1, 2030)), w) if r.random() < 0.2 else w for w in words]
    fill = "the of project code example team data file website book see also by 2021".split()
    words = [w if r.random() > 0.04 else r.choice(fill) for w in words] or text.split()
    before = [r.choice(fill) for _ in range(r.choice([0, 0, 0, 2, 5]))]
    after = [r.choice(fill) for _ in range(r.choice([0, 0, 0, 2, 5]))]
    out = " ".join(before + words + after)
    return out.upper() if r.random() < 0.1 else out


def generated(seed: int, variations: int = VARIATIONS) -> list[tuple[str, int]]:
    """Paragraphs and the numbers of their families, from the templates and the unrelated sentences."""
    r = random.Random(seed)
    out = [(text, FAMILIES.index(family)) for family, _, text in TEMPLATES] + [(text, 0) for text in UNRELATED]
    for family, _, text in TEMPLATES:
        out += [(_varied(text, r), FAMILIES.index(family)) for _ in range(variations)]
    common = " ".join(UNRELATED).split()
    for text in UNRELATED:
        out += [(_varied(text, r), 0) for _ in range(variations)]
        # And their words in any order, long and short.
        out += [(" ".join(r.choice(common) for _ in range(r.randint(3, 50))), 0) for _ in range(variations)]
    return out


class LicenseModel:
    """Sorted feature hashes, their weights for each family, biases and temperature; and the templates' bigrams."""

    def __init__(self, variations: int = VARIATIONS):
        train, held_out = generated(1, variations), generated(2, variations)
        self.known = self._vocabulary([text for text, _ in train])
        x, y = self._matrix([t for t, _ in train]), np.array([f for _, f in train])
        weights, _ = self._fit(x, y)
        # Only features that speak for some family stay; the model is fitted again on them.
        useful = np.flatnonzero(weights[:, 1:].max(axis=1) > 0.25)
        self.known = self.known[useful]
        self.weights, self.bias = self._fit(x[:, useful], y)
        x, y = self._matrix([t for t, _ in held_out]), np.array([f for _, f in held_out])
        logits = x @ self.weights + self.bias
        grid = np.geomspace(0.1, 4.0, 60)
        self.temperature = float(min(grid, key=lambda t: -self._log_softmax(logits / t)[np.arange(len(y)), y].mean()))
        self.templates = []
        for family, name, text in TEMPLATES:
            _, p = next(paragraphs_of(pa.array([text])))
            self.templates.append((FAMILIES.index(family), name, np.unique(p.bigrams[p.paired])))

    @staticmethod
    def _vocabulary(texts: list[str]) -> np.ndarray:
        hashes = []
        for _, p in paragraphs_of(pa.array(texts)):
            hashes += [p.unigrams, p.bigrams[p.paired]]
        return np.unique(np.concatenate(hashes))

    def _matrix(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), len(self.known)), np.float32)
        for first, p in paragraphs_of(pa.array(texts)):
            window, number = p.features(self.known)
            out[p.text[window] + first, number] = 1 / p.norms()[window]
        return out

    @staticmethod
    def _log_softmax(z: np.ndarray) -> np.ndarray:
        z = z - z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    def _fit(self, x: np.ndarray, y: np.ndarray, steps: int = 100, rate: float = 30.0, decay: float = 2e-5) -> tuple[np.ndarray, np.ndarray]:
        """Multinomial logistic regression by gradient descent with momentum and weight decay."""
        weights, bias = np.zeros((x.shape[1], len(FAMILIES)), np.float32), np.zeros(len(FAMILIES), np.float32)
        moved, moved_bias = np.zeros_like(weights), np.zeros_like(bias)
        target = np.eye(len(FAMILIES), dtype=np.float32)[y]
        for _ in range(steps):
            error = (np.exp(self._log_softmax(x @ weights + bias)) - target) / len(y)
            moved = 0.9 * moved - rate * 0.1 * (x.T @ error + decay * weights)
            moved_bias = 0.9 * moved_bias - 0.1 * error.sum(axis=0)
            weights, bias = weights + moved, bias + moved_bias
        return weights, bias

    def scan(self, p: Paragraphs) -> list[tuple[int, int, float, str, float]]:
        """Confirmed predictions: window, family, probability, template, and the share of the template found."""
        if not len(p.start):
            return []
        window, number = p.features(self.known)
        some, place = np.unique(window, return_inverse=True)
        if not len(some):
            return []
        logits = np.zeros((len(some), len(FAMILIES)))
        np.add.at(logits, place, self.weights[number] / p.norms()[window][:, None])
        chance = np.exp(self._log_softmax((logits + self.bias) / self.temperature))
        best = chance.argmax(axis=1)
        found = []
        for k in np.flatnonzero((best > 0) & (chance.max(axis=1) >= LEAST_PROBABILITY)).tolist():
            w = int(some[k])
            inside = slice(p.start[w], p.end[w])
            own = np.unique(p.bigrams[inside][p.paired[inside]])
            covers = [
                (min(1.0, np.isin(bigrams, own).sum() / min(len(bigrams), MOST_BIGRAMS)), name)
                for family, name, bigrams in self.templates
                if family == best[k]
            ]
            cover, name = max(covers)
            if cover >= LEAST_COVER:
                found.append((w, int(best[k]), float(chance[k, best[k]]), name, float(cover)))
        return found


    def notices(self, p: Paragraphs) -> list[tuple[int, int, int, str, float, float]]:
        """Text, line, family, template, probability and cover of all notices, on one line or over several.

        A notice over several lines has the line where its template begins; windows that overlap state the same one. Lines
        that state the family by themselves do not count for it, unless they are lines of its template that resemble a shorter one.
        """
        out = [(int(p.text[w]), int(p.line[w]), family, name, chance, cover) for w, family, chance, name, cover in self.scan(p)]
        alone: dict[tuple[int, int], set[str]] = {}
        for _, line, family, name, *_ in out:
            alone.setdefault((family, line), set()).add(name)
        templates = {name: bigrams for _, name, bigrams in self.templates}
        joined, over, parts = p.joined, [], set()
        before: dict[int, tuple[int, int]] = {}
        for w, family, chance, name, _ in self.scan(joined):
            start, end = int(joined.start[w]), int(joined.end[w])
            lines, own = joined.lines[start:end], joined.bigrams[start:end]
            if lines[0] == lines[-1]:
                continue
            stated = np.isin(own, templates[name]) & joined.paired[start:end]
            part = set()
            for line in np.unique(lines).tolist():
                names = alone.get((family, line))
                if names:
                    if name not in names and 2 * stated[lines == line].sum() >= (lines == line).sum():
                        part.add((family, line))
                    else:
                        stated &= lines != line
            cover = min(1.0, len(np.unique(own[stated])) / min(len(templates[name]), MOST_BIGRAMS))
            if cover < LEAST_COVER:
                continue
            parts |= part
            reached, line = before.get(family, (-1, 0))
            if reached <= start:
                # Two pairs in a row, if there are any: a lone one may be prose before the notice.
                runs = stated & np.append(stated[1:], False)
                line = int(lines[(runs if runs.any() else stated).argmax()])
            before[family] = end, line
            over.append((int(joined.text[w]), line, family, name, chance, cover))
        out = [f for f in out if (f[2], f[1]) not in parts] + over
        return out


@lru_cache(maxsize=2)
def trained_licenses(variations: int = VARIATIONS) -> LicenseModel:
    """The classifier; the same on every run."""
    return LicenseModel(variations)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", variations: int = VARIATIONS) -> DataFrame:
    """One row per document and licence family found in it.

    Columns: ``id_col``, ``family``, ``template`` (the best), ``n_paragraphs`` (lines where a notice begins), ``first_line`` (from 0),
    ``probability`` and ``cover`` (share of the template's bigrams), the largest of the paragraphs.

    * Null texts, and texts without words, have no licence. Lines are split at line feeds; a notice may
      go over lines that follow each other, with or without comment marks, but not over a line without words.
    * Equal rows give one result, rows of equal ids but other texts one each; null ids are kept as they are.
    * The model is fitted on ``variations`` variations of each template, no rows of the table. Other columns are not read.
      An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trained_licenses(variations))
    ident, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    rows = docs.select(ident.alias("_id"), *row_key(ident, text), text.alias("_text"))

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for first, p in paragraphs_of(batch.column("_text")):
                found = model.notices(p)
                if found:
                    text = np.array([f[0] for f in found])
                    taken = pa.array(text + first)
                    columns = [batch.column(c).take(taken) for c in ("_id", "_k1", "_k2")]
                    columns += [pa.array([FAMILIES[f[2]] for f in found]), pa.array([f[3] for f in found])]
                    lines = np.array([f[1] for f in found]) - p.first_line[text]
                    columns += [pa.array(lines), pa.array([f[4] for f in found]), pa.array([f[5] for f in found])]
                    yield pa.RecordBatch.from_arrays(columns, names)

    names = ["_id", "_k1", "_k2", "family", "template", "line", "probability", "cover"]
    kind = rows.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, _k1 long, _k2 long, family string, template string, line long, probability double, cover double"
    found = rows.mapInArrow(scanned, schema)
    grouped = found.groupBy("_k1", "_k2", "_id", "family").agg(
        F.max(F.struct("cover", "template")).alias("_best"),
        F.count_distinct("line").alias("n_paragraphs"),
        F.min("line").alias("first_line"),
        F.max("probability").alias("probability"),
    )
    return grouped.select(
        F.col("_id").alias(id_col), "family", F.col("_best.template").alias("template"), "n_paragraphs", "first_line",
        "probability", F.col("_best.cover").alias("cover"),
    )
