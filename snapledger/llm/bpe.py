"""Byte-level BPE encoding and decoding with a two-tier lookup.

A text is split by the tokenizer's pattern. A minimal perfect hash over the vocabulary first resolves
pre-tokens that are tokens as a whole; the others are merged by rank with a heap over a linked list of
their bytes. Vocabulary and hash are built once on the driver and broadcast: their size is that of the
tokenizer's file, whatever the corpus. Documents are encoded where they lie, without a shuffle.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator, Sequence
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger.llm.common import sent, unpacked
from snapledger.llm.pieces import Memo, encode_slices

#: Bits of an id in the number of a pair of ids.
ID_BITS = 24


class PerfectHash:
    """Maps each of n known keys to a place of its own in n places; unknown keys are recognised.

    Hash and displace: keys fall into buckets, and buckets, the largest first, get the first displacement
    that sends their keys to free places. Buckets of one key name a free place directly.
    """

    def __init__(self, keys: Sequence[bytes]):
        n = len(keys)
        self.n, self.buckets = n, max(1, n // 2)
        members: list[list[int]] = [[] for _ in range(self.buckets)]
        hashes = [self._halves(k) for k in keys]
        for k, (low, _) in enumerate(hashes):
            members[low % self.buckets].append(k)
        self.displacement = np.zeros(self.buckets, np.int64)
        self.values = np.zeros(n, np.int64)
        self.keys: list[bytes] = [b""] * n
        taken = np.zeros(n, bool)
        order = sorted(range(self.buckets), key=lambda b: -len(members[b]))
        alone = []
        for bucket in order:
            group = members[bucket]
            if len(group) <= 1:
                alone.append(bucket)
                continue
            d = 0
            while True:
                d += 1
                places = [self._place(*hashes[k], d) for k in group]
                if len(set(places)) == len(places) and not any(taken[p] for p in places):
                    break
            self.displacement[bucket] = d
            for k, place in zip(group, places, strict=True):
                taken[place] = True
                self.keys[place], self.values[place] = keys[k], k
        free = iter(np.flatnonzero(~taken).tolist())
        for bucket in alone:
            for k in members[bucket]:
                place = next(free)
                self.displacement[bucket] = -place - 1
                self.keys[place], self.values[place] = keys[k], k
        # Plain lists are faster to index one by one.
        self.displacement, self.values = self.displacement.tolist(), self.values.tolist()

    @staticmethod
    def _halves(key: bytes) -> tuple[int, int]:
        h = xxhash.xxh3_128_intdigest(key)
        return h & 0xFFFFFFFFFFFFFFFF, h >> 64

    def _place(self, low: int, high: int, d: int) -> int:
        return (high + d * (low | 1)) % 0xFFFFFFFFFFFFFFC5 % self.n

    def index(self, key: bytes) -> int:
        """The position of ``key`` among the keys, or -1."""
        low, high = self._halves(key)
        d = self.displacement[low % self.buckets]
        place = -d - 1 if d < 0 else self._place(low, high, d)
        return self.values[place] if self.keys[place] == key else -1


class Codec:
    """A byte-level vocabulary with its ranks and splitting pattern."""

    def __init__(self, tokens: dict[bytes, int], pattern: str):
        self.pattern = pattern
        self.ranks = tokens
        self.hash = PerfectHash(list(tokens))
        self.ids = list(tokens.values())
        size = max(tokens.values(), default=-1) + 1
        lengths = np.zeros(size, np.int64)
        by_id: list[bytes] = [b""] * size
        for token, k in tokens.items():
            by_id[k], lengths[k] = token, len(token)
        # All tokens one after the other, and where each begins; an id without a token has no length.
        self.bytes, self.lengths = np.frombuffer(b"".join(by_id), np.uint8), lengths
        self.begins = np.cumsum(lengths) - lengths
        #: The id of each byte, and what two neighbouring tokens merge to: keys are their ids in one number.
        self.of_byte = [tokens.get(bytes([x]), -1) for x in range(256)]
        self.pairs = {
            tokens[token[:k]] << ID_BITS | tokens[token[k:]]: rank
            for token, rank in tokens.items()
            for k in range(1, len(token))
            if token[:k] in tokens and token[k:] in tokens
        }
        #: The same for two bytes, by their values.
        self.of_two = [tokens.get(bytes([x >> 8, x & 255]), -1) for x in range(1 << 16)]

    @staticmethod
    def from_rank_file(content: bytes, pattern: str) -> Codec:
        """From lines of a token in base64 and its rank."""
        lines = (line.split() for line in content.splitlines() if line)
        return Codec({base64.b64decode(token): int(rank) for token, rank in lines}, pattern)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in {"splitter", "memo"}}

    @cached_property
    def splitter(self) -> regex.Pattern:
        return regex.compile(self.pattern)

    @cached_property
    def memo(self) -> Memo:
        return Memo(lambda pieces: [array("I", self.encode(p.decode())).tobytes() for p in pieces])

    def encode(self, text: str) -> list[int]:
        """The ids of a text: each match of the pattern by itself."""
        ids: list[int] = []
        for word in self.splitter.findall(text):
            token = word.encode()
            whole = self.hash.index(token)
            if whole >= 0:
                ids.append(self.ids[whole])
            else:
                ids += self.merged(token)
        return ids

    def merged(self, word: bytes) -> list[int]:
        """The ids of a word that is no token: always the pair of lowest rank is merged, the leftmost first."""
        merge, of_two, n = self.pairs.get, self.of_two, len(word)
        ids = [*map(self.of_byte.__getitem__, word)]
        if -1 in ids:
            raise ValueError("a byte that the vocabulary does not know")
        # A part lives at its first byte; pair[k] is what the part at k and the next one merge to.
        pair = [of_two[a << 8 | b] for a, b in zip(word, word[1:])]
        heap = [r << 32 | k for k, r in enumerate(pair) if r >= 0]
        heapq.heapify(heap)
        pair.append(-1)
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        while heap:
            entry = heapq.heappop(heap)
            k, token = entry & 0xFFFFFFFF, entry >> 32
            if pair[k] != token:
                continue  # one of its parts has changed since
            gone = after[k]
            stop = after[k] = after[gone]
            ids[k], ids[gone] = token, -1
            pair[gone] = -1
            if stop < n:
                before[stop] = k
                pair[k] = r = merge(token << ID_BITS | ids[stop], -1)
                if r >= 0:
                    heapq.heappush(heap, r << 32 | k)
            else:
                pair[k] = -1
            left = before[k]
            if left >= 0:
                pair[left] = r = merge(ids[left] << ID_BITS | token, -1)
                if r >= 0:
                    heapq.heappush(heap, r << 32 | left)
        return [i for i in ids if i >= 0]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of several sequences of ids, and where each begins and ends."""
        counts = self.lengths[ids]
        if len(ids) and not counts.all():
            raise ValueError("an id that the vocabulary does not know")
        ends = np.concatenate([[0], np.cumsum(counts)])
        place = np.arange(ends[-1]) + np.repeat(self.begins[ids] - ends[:-1], counts)
        return self.bytes[place], ends[bounds]


def load_codec(path: str, pattern: str) -> Codec:
    """The codec of a rank file that the driver can read."""
    with open(path, "rb") as file:
        return Codec.from_rank_file(file.read(), pattern)


def _binary(data: np.ndarray, bounds: np.ndarray, width: int = 1) -> pa.Array:
    """A column of bytes from one array and where the values begin and end in it."""
    stops = pa.py_buffer((bounds * width).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, stops, pa.py_buffer(np.ascontiguousarray(data))])


def encode_texts(
    docs: DataFrame,
    codec: Codec,
    text_col: str = "text",
    ids_col: str = "token_ids",
    decoded_col: str | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Every input row, or its columns ``keep``, with the ids of its text, as little-endian unsigned 32-bit integers in ``ids_col``.

    With ``decoded_col`` the ids are decoded again in the same pass, as in ``decode_ids``.

    * Null or empty text has no ids: empty bytes. No special tokens are made; their strings are plain text.
    * Input columns of the names ``ids_col`` and ``decoded_col`` are replaced; repeated rows stay; an empty table stays empty.
    * Whole texts are encoded, of any length, in slices of a few MB.
    """
    shared = docs.sparkSession.sparkContext.broadcast(codec)
    added = [ids_col, *([decoded_col] if decoded_col else [])]
    rows, texts_of = sent(docs, text_col, added, keep)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared.value
        for batch in batches:
            done = 0
            for ids, bounds in encode_slices(texts_of(batch), codec.memo):
                n = len(bounds) - 1
                columns = [batch.column("_row").slice(done, n), _binary(ids, bounds, 4)]
                if decoded_col:
                    columns.append(_binary(*codec.decode(ids, bounds)))
                yield pa.RecordBatch.from_arrays(columns, names)
                done += n

    schema = T.StructType([rows.schema["_row"], *[T.StructField(f"_out{k}", T.BinaryType()) for k in range(len(added))]])
    names = schema.names
    out = rows.mapInArrow(encoded, schema)
    return out.select(*unpacked(out), *[F.col(f"_out{k}").alias(c) for k, c in enumerate(added)])


#: Ids decoded at a time.
SLICE_IDS = 1 << 20


def decode_ids(
    encoded: DataFrame,
    codec: Codec,
    ids_col: str = "token_ids",
    bytes_col: str = "decoded",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Every input row, or its columns ``keep``, with the bytes that its ids stand for; no ids (null or empty) give empty bytes.

    An input column of the name ``bytes_col`` is replaced. Ids outside the vocabulary are an error.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(codec)
    rows, ids_of = sent(encoded, ids_col, [bytes_col], keep)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared.value
        for batch in batches:
            ids = ids_of(batch).fill_null(b"").cast(pa.large_binary())
            bounds = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset : ids.offset + len(ids) + 1] // 4
            flat = np.frombuffer(ids.buffers()[2] or b"", "<u4")
            first = 0
            while first < len(ids):
                last = int(np.searchsorted(bounds, bounds[first] + SLICE_IDS, side="right")) - 1
                last = min(max(last, first + 1), len(ids))
                own = bounds[first : last + 1]
                found = _binary(*codec.decode(flat[own[0] : own[-1]], own - own[0]))
                yield pa.RecordBatch.from_arrays([batch.column("_row").slice(first, last - first), found], ["_row", "_out"])
                first = last

    out = rows.mapInArrow(decoded, T.StructType([rows.schema["_row"], T.StructField("_out", T.BinaryType())]))
    return out.select(*unpacked(out), F.col("_out").alias(bytes_col))


def default_codec(path: str | None = None, pattern: str | None = None) -> Codec:
    """The codec of the multilingual public vocabulary, unless another file and pattern are given."""
    import public_tokenizers

    return load_codec(path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), pattern or public_tokenizers.PATTERN)
