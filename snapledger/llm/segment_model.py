"""A semi-Markov conditional random field over the tokens of a short stretch of text.

Segments of up to ``MAX_TOKENS`` tokens are scored as a whole, by features of the whole span, for every kind of
entity; a token outside entities is a segment by itself. Dynamic programming over token positions and kinds chooses
boundaries and kinds jointly, and the same recursion in sums gives the likelihood that training climbs.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from typing import NamedTuple

import numpy as np

#: Tokens that an entity may have at most.
MAX_TOKENS = 18

_TOKEN = re.compile(r"[A-Za-z0-9]+|[^\W_]+|\s|.", re.S)

#: From a text and a span to the names of the features that the span has.
Features = Callable[[str, int, int], list[str]]


class Segment(NamedTuple):
    """A candidate: first and last (excluded) token, and the numbers of its features."""

    first: int
    last: int
    features: np.ndarray


class SegmentModel:
    """Kinds of entities, feature numbers, weights (features x kinds) and transitions (outside and kinds)."""

    def __init__(self, kinds: Sequence[str], features: Features, may_be: Callable[[str], bool]):
        self.kinds, self.features, self.may_be = tuple(kinds), features, may_be
        self.numbers: dict[str, int] = {}
        self.weights = np.zeros((0, len(kinds)))
        # transitions[a, b]: from a segment of kind a to one of kind b; 0 is outside.
        self.transitions = np.zeros((len(kinds) + 1, len(kinds) + 1))

    def tokens(self, text: str) -> list[tuple[int, int]]:
        return [m.span() for m in _TOKEN.finditer(text)]

    def candidates(self, text: str, tokens: list[tuple[int, int]], learn: bool = False) -> list[Segment]:
        """The spans that may be entities: from and to tokens that are no white space, on one line."""
        found = []
        for i, (begin, _) in enumerate(tokens):
            if text[begin].isspace():
                continue
            for j in range(i + 1, min(i + MAX_TOKENS, len(tokens)) + 1):
                last_begin, end = tokens[j - 1]
                if text[last_begin] == "\n":
                    break
                if text[last_begin].isspace() or not self.may_be(text[begin:end]):
                    continue
                names = self.features(text, begin, end)
                if learn:
                    ids = [self.numbers.setdefault(n, len(self.numbers)) for n in names]
                else:
                    ids = [k for k in map(self.numbers.get, names) if k is not None]
                found.append(Segment(i, j, np.array(ids, np.int64)))
        return found

    def _by_end(self, n: int, segments: list[Segment]) -> list[list[int]]:
        ends: list[list[int]] = [[] for _ in range(n + 1)]
        for k, s in enumerate(segments):
            ends[s.last].append(k)
        return ends

    def _scores(self, segments: list[Segment]) -> np.ndarray:
        return np.array([self.weights[s.features].sum(axis=0) for s in segments]).reshape(-1, len(self.kinds))

    def decode(self, text: str) -> list[tuple[int, int, str]]:
        """The best entities of a text: begin and end in characters, and kind."""
        tokens = self.tokens(text)
        segments = self.candidates(text, tokens)
        if not segments:
            return []
        n, kinds, trans = len(tokens), len(self.kinds), self.transitions
        scores, ends = self._scores(segments), self._by_end(n, segments)
        best = np.full((n + 1, kinds + 1), -np.inf)
        best[0, 0] = 0.0
        back: list[list[tuple[int, int] | None]] = [[None] * (kinds + 1) for _ in range(n + 1)]
        for j in range(1, n + 1):
            outside = best[j - 1] + trans[:, 0]
            before = int(outside.argmax())
            best[j, 0], back[j][0] = outside[before], (j - 1, before)
            for k in ends[j]:
                i = segments[k].first
                into = best[i][:, None] + trans[:, 1:]
                came = into.argmax(axis=0)
                total = into.max(axis=0) + scores[k]
                for y in np.flatnonzero(total > best[j, 1:]).tolist():
                    best[j, y + 1], back[j][y + 1] = total[y], (i, int(came[y]))
        found, j, y = [], n, int(best[n].argmax())
        while j > 0:
            i, before = back[j][y]
            if y:
                found.append((tokens[i][0], tokens[j - 1][1], self.kinds[y - 1]))
            j, y = i, before
        return found[::-1]

    def _gradient(self, n: int, segments: list[Segment], truth: dict[tuple[int, int], int]) -> tuple[float, list, np.ndarray]:
        """Log-likelihood of the true segmentation, and its gradient by segment scores and by transitions."""
        kinds, trans = len(self.kinds), self.transitions
        scores, ends = self._scores(segments), self._by_end(n, segments)
        forward = np.full((n + 1, kinds + 1), -np.inf)
        forward[0, 0] = 0.0
        for j in range(1, n + 1):
            forward[j, 0] = np.logaddexp.reduce(forward[j - 1] + trans[:, 0])
            for k in ends[j]:
                into = np.logaddexp.reduce(forward[segments[k].first][:, None] + trans[:, 1:], axis=0) + scores[k]
                forward[j, 1:] = np.logaddexp(forward[j, 1:], into)
        total = np.logaddexp.reduce(forward[n])
        backward = np.full((n + 1, kinds + 1), -np.inf)
        backward[n] = 0.0
        expected = np.zeros((len(segments), kinds))
        pairs = np.zeros_like(trans)
        for j in range(n, 0, -1):
            for k in ends[j]:
                i = segments[k].first
                through = trans[:, 1:] + (scores[k] + backward[j, 1:])[None, :]
                chance = np.exp(forward[i][:, None] + through - total)
                expected[k] = chance.sum(axis=0)
                pairs[:, 1:] += chance
                backward[i] = np.logaddexp(backward[i], np.logaddexp.reduce(through, axis=1))
            through = trans[:, 0] + backward[j, 0]
            pairs[:, 0] += np.exp(forward[j - 1] + through - total)
            backward[j - 1] = np.logaddexp(backward[j - 1], through)
        observed, value, state, j = np.zeros_like(expected), 0.0, 0, 0
        index = {(s.first, s.last): k for k, s in enumerate(segments)}
        starts = {i: (i, e) for i, e in truth}
        while j < n:
            span = starts.get(j)
            if span:
                k, y = index[span], truth[span]
                observed[k, y] += 1
                value += scores[k, y] + trans[state, y + 1]
                pairs[state, y + 1] -= 1
                state, j = y + 1, span[1]
            else:
                value += trans[state, 0]
                pairs[state, 0] -= 1
                state, j = 0, j + 1
        return value - total, observed - expected, -pairs

    def fit(self, examples: list[tuple[str, list[tuple[int, int, str]]]], passes: int = 8, rate: float = 0.5, decay: float = 1e-4) -> float:
        """Learn from texts with their entities; returns the mean log-likelihood of the last pass.

        AdaGrad over the examples in their order, with weight decay. Entities must be candidates.
        """
        prepared = []
        for text, entities in examples:
            tokens = self.tokens(text)
            segments = self.candidates(text, tokens, learn=True)
            begins, stops = {b: k for k, (b, _) in enumerate(tokens)}, {e: k + 1 for k, (_, e) in enumerate(tokens)}
            truth = {(begins[b], stops[e]): self.kinds.index(kind) for b, e, kind in entities}
            prepared.append((len(tokens), segments, truth))
        self.weights = np.zeros((len(self.numbers), len(self.kinds)))
        seen, seen_trans, likelihood = np.full_like(self.weights, 1e-2), np.full_like(self.transitions, 1e-2), 0.0
        for _ in range(passes):
            likelihood = 0.0
            for n, segments, truth in prepared:
                value, by_segment, by_pair = self._gradient(n, segments, truth)
                likelihood += value
                if segments:
                    ids = np.concatenate([s.features for s in segments])
                    parts = np.repeat(by_segment, [len(s.features) for s in segments], axis=0)
                    used, place = np.unique(ids, return_inverse=True)
                    gradient = np.zeros((len(used), len(self.kinds)))
                    np.add.at(gradient, place, parts)
                    gradient -= decay * self.weights[used]
                    seen[used] += gradient**2
                    self.weights[used] += rate * gradient / np.sqrt(seen[used])
                seen_trans += by_pair**2
                self.transitions += rate * by_pair / np.sqrt(seen_trans)
        return likelihood / max(1, len(prepared))
