"""Encoding a column of texts piece by piece: numpy and Arrow inside a task.

A text is cut before each ASCII space that follows a character which is no white space, and before a mark
such as a comma that follows a letter or digit. Tokenizers whose pattern never crosses such a place give the
same ids for the pieces as for the whole text, and pieces repeat: each distinct one of a slice is encoded once and its
ids are copied to its places.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at a time; a longer document is one slice of its own.
SLICE_BYTES = 2 << 20
#: Pieces remembered by a task, twice; longer pieces than MEMO_BYTES are not remembered.
MEMO_SIZE = 150_000
MEMO_BYTES = 48

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

#: The ids of each piece, as little-endian unsigned 32-bit integers.
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True

#: Marks before which a text is cut.
MARKS = b",.;:!?"
_IS_MARK = np.zeros(256, bool)
_IS_MARK[list(MARKS)] = True

#: White space as a space and A-Z lower-cased, for models that drop white space and lower-case by themselves.
FOLDED = np.arange(256, dtype=np.uint8)
FOLDED[65:91] += 32
FOLDED[9:14] = 32

Encode = Callable[[Sequence[bytes]], list[bytes]]


class Memo:
    """Ids of pieces, the least recently used half of them dropped when the memo is full."""

    def __init__(self, encode: Encode, size: int = MEMO_SIZE):
        self.encode, self.size = encode, size
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def __call__(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of distinct pieces."""
        young, old = self.young, self.old
        found = [young.get(p) if p in young else old.get(p) for p in pieces]
        missing = [k for k, ids in enumerate(found) if ids is None]
        for k, ids in zip(missing, self.encode([pieces[k] for k in missing]), strict=True):
            found[k] = ids
        if len(young) + len(pieces) > self.size:
            self.old, self.young = young, {}
        self.young.update((p, ids) for p, ids in zip(pieces, found, strict=True) if len(p) <= MEMO_BYTES)
        return found


def _cuts(data: np.ndarray) -> np.ndarray:
    """Where pieces begin: ASCII white space after a character that is no white space of any kind."""
    space = _IS_SPACE[data]
    cut = np.zeros(len(data), bool)
    cut[1:] = space[1:] & ~space[:-1]
    # White space beyond ASCII ends in a byte of 0x80 and above after C2, or two after E1, E2 or E3.
    # Other characters of these blocks are only cut a little less often.
    at = np.flatnonzero(cut)
    wide = at[data[at - 1] >= 0x80]
    two = (data[wide - 2] == 0xC2) & (wide >= 2)
    three = (wide >= 3) & (data[wide - 3] >= 0xE1) & (data[wide - 3] <= 0xE3)
    cut[wide[two | three]] = False
    # Letters and digits of ASCII, and the letters of Latin-1 (C3 and a byte, but for two signs).
    mark = np.flatnonzero(_IS_MARK[data[1:]]) + 1
    last = data[mark - 1]
    latin = (mark >= 2) & (data[mark - 2] == 0xC3) & (last >= 0x80) & (last != 0x97) & (last != 0xB7)
    cut[mark[_ALNUM[last] | latin]] = True
    return cut


def _slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, side="right")) - 1
        last = min(max(last, first + 1), len(offsets) - 1)
        yield first, last
        first = last


def encode_slices(
    texts: pa.Array, memo: Memo, fold: np.ndarray | None = None, unless: bytes = b""
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For slices of ``texts`` in their order: all ids, and where each text's ids begin and end.

    Null and empty texts have no ids. ``fold`` maps the bytes of a slice to others that have the same ids, so that
    fewer pieces are distinct; slices that hold ``unless`` stay as they are.
    """
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = texts.buffers()[2]
    for first, last in _slices(offsets):
        begin, end = int(offsets[first]), int(offsets[last])
        if begin == end:
            yield np.zeros(0, "<u4"), np.zeros(last - first + 1, np.int64)
            continue
        buffer = whole.slice(begin, end - begin)
        data = np.frombuffer(buffer, np.uint8)
        if fold is not None and unless not in memoryview(buffer).tobytes():
            data = fold[data]
            buffer = pa.py_buffer(data)
        cut = _cuts(data)
        texts_at = offsets[first : last + 1] - begin
        cut[texts_at[:-1][texts_at[:-1] < len(data)]] = True
        starts = np.flatnonzero(cut)
        bounds = np.append(starts, len(data)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds), buffer])
        coded = pieces.dictionary_encode()
        ids = memo(coded.dictionary.to_pylist())
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        begins = np.cumsum(lengths) - lengths
        index = coded.indices.to_numpy(zero_copy_only=False)
        counts = lengths[index]
        ends = np.cumsum(counts)
        total = int(ends[-1])
        source = np.arange(total, dtype=np.int64) + np.repeat(begins[index] - (ends - counts), counts)
        flat = np.frombuffer(b"".join(ids), "<u4")[source]
        text_starts = np.searchsorted(starts, texts_at)
        yield flat, np.concatenate([[0], ends])[text_starts]
