"""Token ids in files of length-delimited binary records, with a separate offset index.

A folder holds ``records`` (files of frames), ``offsets`` (a Parquet index of every frame) and ids in the
order of the documents' key. A frame is

    length of the payload   8 bytes, little-endian
    masked checksum         4 bytes, of the 8 bytes before
    payload                 key (8 bytes, signed), bytes per id (1 byte: 2 or 4, plus 128 if the key is
                            null), ids; all little-endian
    masked checksum         4 bytes, of the payload
    line feed               1 byte

A masked checksum is CRC-32 rotated right by 15 bits plus 0xA282EAD8, modulo 2^32, so that a checksum over
data that holds checksums stays meaningful. Ids take two bytes where the vocabulary allows.

The files are written by Spark's own writer, one per task and range of keys: a lost executor's tasks
are repeated and only finished files count. Files are read whole, one per row, so ``max_records`` and the
number of shuffle partitions bound their size; the offset index serves single frames.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapledger.llm.pieces import FOLDED, Memo, encode_slices

_HEAD = struct.Struct("<QI")
_KEY = struct.Struct("<qB")
_SUM = struct.Struct("<I")
_END = b"\n"
_NO_KEY = 128
#: Pieces given to the tokenizers library at a time.
LIBRARY_PIECES = 4096
#: Pieces remembered, twice: the library takes long for each.
MEMO_PIECES = 180_000
#: How the model's special tokens begin; where they occur, the case of letters matters.
_SPECIAL = b"<|"
#: Words of letters a-z and of Latin-1, then marks of ASCII, but for those of contractions and special tokens.
_PLAIN = re.compile(r"([a-zÀ-ÖØ-öø-ÿ]*)([!-&(-/:;=>?@\[-`{}~]*)")


def _byte_letters() -> dict[int, str]:
    """Letters of Latin-1 as a byte-level model sees them: lower-cased, a character for each byte of UTF-8."""
    hidden = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
    names = {b: chr(256 + hidden.index(b)) if b in hidden else chr(b) for b in range(256)}
    return {c: "".join(names[b] for b in chr(c).lower().encode()) for c in range(0xC0, 0x100) if chr(c).isalpha()}


_BYTE_LETTERS = _byte_letters()


def plain_parts(piece: bytes) -> list[str] | None:
    """What normaliser and splitter make of a plain piece, without them; None for other pieces."""
    word = piece.lstrip(b" ")
    # Most words are of a-z, which stay as they are.
    if word.isalpha() and word.islower():
        return [word.decode()]
    found = _PLAIN.fullmatch(word.decode())
    if not word or found is None:
        return None
    return [part.translate(_BYTE_LETTERS) for part in found.groups() if part]


def masked(data: bytes) -> int:
    """The masked checksum of ``data``."""
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(key: int | None, ids: np.ndarray, width: int) -> bytes:
    head = _KEY.pack(0, width | _NO_KEY) if key is None else _KEY.pack(key, width)
    payload = head + ids.astype(f"<u{width}").tobytes()
    length = len(payload).to_bytes(8, "little")
    return length + _SUM.pack(masked(length)) + payload + _SUM.pack(masked(payload)) + _END


def parse(data: memoryview, offset: int) -> tuple[int | None, np.ndarray, int]:
    """Key and ids of the frame at ``offset``, and where the next one begins; damage is an error."""
    length, check = _HEAD.unpack_from(data, offset)
    if masked(data[offset : offset + 8]) != check:
        raise ValueError(f"damaged length at byte {offset}")
    begin = offset + _HEAD.size
    payload = data[begin : begin + length]
    end = begin + length
    if len(payload) != length or masked(payload) != _SUM.unpack_from(data, end)[0]:
        raise ValueError(f"damaged record at byte {offset}")
    key, width = _KEY.unpack_from(payload)
    ids = np.frombuffer(payload, f"<u{width & ~_NO_KEY}", offset=_KEY.size)
    return None if width & _NO_KEY else key, ids, end + _SUM.size + len(_END)


@lru_cache(maxsize=2)
def _memo(model: str) -> Memo:
    """One tokenizer and its memo per Python worker, kept from task to task."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(model)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    words = tokenizer.model

    def encode(pieces: list[bytes]) -> list[bytes]:
        found: list[bytes | None] = [None] * len(pieces)
        others = []
        for k, piece in enumerate(pieces):
            parts = plain_parts(piece)
            if parts is None:
                others.append(k)
            else:
                # The model's merges alone are needed.
                found[k] = array("I", [t.id for part in parts for t in words.tokenize(part)]).tobytes()
        # The library's results take some KB a piece until they are reduced to ids.
        for first in range(0, len(others), LIBRARY_PIECES):
            chosen = others[first : first + LIBRARY_PIECES]
            results = tokenizer.encode_batch_fast([pieces[k].decode() for k in chosen], add_special_tokens=False)
            for k, result in zip(chosen, results, strict=True):
                found[k] = array("I", result.ids).tobytes()
        return found

    return Memo(encode, MEMO_PIECES)


def library_memo(model: str) -> Callable[[], Memo]:
    """What encodes pieces by the tokenizers library with the given model file's content.

    For byte-level models that lower-case, split at white space, drop it, and split words from marks: a piece begins with
    white space or a mark, and the ids of a text are those of its pieces, one after the other.
    """
    return lambda: _memo(model)


def write_sequences(
    docs: DataFrame,
    folder: str,
    model: str,
    vocabulary_size: int,
    end_id: int | None = None,
    key_col: str = "doc_id",
    text_col: str = "text",
    max_records: int = 20_000,
) -> None:
    """Encode whole texts and write ``folder``: records in ascending order of the key, and their index.

    ``model`` is the content of a tokenizer's JSON file. Special tokens are not added; ``end_id`` is appended
    to every sequence if given.

    * Null or empty text gives a sequence of ``end_id`` alone, or an empty one. Equal keys are ordered by text.
    * Keys are 64-bit integers; records of null keys come first. Repeated rows are records each; other
      columns are not read.
    * An empty table gives a folder without records and an empty index.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    width = 2 if max(vocabulary_size, (end_id or 0) + 1) <= 1 << 16 else 4
    tail = np.array([] if end_id is None else [end_id], "<u4")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = library_memo(shared.value)()
        for batch in batches:
            keys, done = batch.column("_key").to_pylist(), 0
            for ids, bounds in encode_slices(batch.column("_text"), memo, FOLDED, _SPECIAL):
                frames = [
                    frame(keys[done + k], np.append(ids[bounds[k] : bounds[k + 1]], tail), width)
                    for k in range(len(bounds) - 1)
                ]
                done += len(frames)
                # Without the final line feed, which the writer adds.
                yield pa.RecordBatch.from_arrays([pa.array([f[:-1] for f in frames], pa.binary())], ["frame"])

    texts = docs.select(F.col(f"`{key_col}`").cast("long").alias("_key"), F.col(f"`{text_col}`").alias("_text"))
    ordered = texts.repartitionByRange("_key", F.xxhash64("_text")).sortWithinPartitions("_key", "_text")
    frames = ordered.mapInArrow(encoded, "frame binary")
    # The text writer puts out the bytes as they are, and a line feed after each value.
    frames.select(F.col("frame").cast("string")).write.option("maxRecordsPerFile", max_records).text(f"{folder}/records")
    _scan(spark, folder).write.parquet(f"{folder}/offsets")


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """The record files as rows: their place in the order of keys, name and content."""
    content = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/records")
    name = F.element_at(F.split("path", "/"), -1)
    # Task and, within a task, the running number of the file.
    place = F.regexp_extract(name, r"^part-(\d+)-", 1).cast("long") * 1_000_000 + F.regexp_extract(
        name, r"-c(\d+)", 1
    ).cast("long")
    return content.select(place.alias("file"), name.alias("name"), "content")


def _scan(spark: SparkSession, folder: str) -> DataFrame:
    """One row per frame, from the lengths: file, name, record, offset, size, key, n_tokens."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, name, content in zip(*(batch.column(k) for k in range(3)), strict=True):
                data, offset, rows = memoryview(content.as_buffer()), 0, []
                while offset < len(data):
                    key, ids, end = parse(data, offset)
                    rows.append((file.as_py(), name.as_py(), len(rows), offset, end - offset, key, len(ids)))
                    offset = end
                if rows:
                    kinds = [pa.string() if n == "name" else pa.int64() for n in names]
                    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names)

    names = ["file", "name", "record", "offset", "size", "key", "n_tokens"]
    schema = "file long, name string, record long, offset long, size long, key long, n_tokens long"
    return _files(spark, folder).mapInArrow(scanned, schema)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """The offset index: file, name, record, offset, size, key, n_tokens."""
    return spark.read.parquet(f"{folder}/offsets")


def read_sequences(spark: SparkSession, folder: str, key_col: str = "doc_id") -> DataFrame:
    """All sequences from the files: key, ``start`` (ids in all records before it) and ``token_ids``.

    ``token_ids`` are little-endian unsigned 32-bit integers. Checksums are verified; damage is an error.
    """

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, content in zip(batch.column("start"), batch.column("content"), strict=True):
                data, offset, at, rows, held = memoryview(content.as_buffer()), 0, start.as_py(), [], 0
                while offset < len(data):
                    key, ids, offset = parse(data, offset)
                    rows.append((key, at, ids.astype("<u4").tobytes()))
                    at += len(ids)
                    held += 4 * len(ids)
                    if held > 8 << 20 or offset >= len(data):
                        kinds = (pa.int64(), pa.int64(), pa.binary())
                        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                        yield pa.RecordBatch.from_arrays(columns, [key_col, "start", "token_ids"])
                        rows, held = [], 0

    # One row per file: the window and the broadcast are over as many rows as there are files.
    sizes = read_index(spark, folder).groupBy("file").agg(F.sum("n_tokens").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("file")) - F.col("_n")
    starts = sizes.select("file", before.alias("start"))
    placed = _files(spark, folder).join(F.broadcast(starts), "file").select("start", "content")
    return placed.mapInArrow(parsed, f"`{key_col}` long, start long, token_ids binary")


def read_shuffled(spark: SparkSession, folder: str, seed: int, key_col: str = "doc_id") -> DataFrame:
    """All sequences in a repeatable random order, each fetched by its place in the index.

    Only index rows are shuffled; the ids are read where they are needed. The files are opened by Arrow's
    file systems (local folders, HDFS and the common object stores).
    """
    records = f"{folder}/records"

    def fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(records if ":" in records else f"file://{records}")
        for batch in batches:
            keys, values = [], []
            for name, offset, size in zip(*(batch.column(c).to_pylist() for c in ("name", "offset", "size")), strict=True):
                with store.open_input_file(f"{root}/{name}") as file:
                    key, ids, _ = parse(memoryview(file.read_at(size, offset)), 0)
                keys.append(key)
                values.append(ids.astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(values, pa.binary())], [key_col, "token_ids"])

    order = F.xxhash64(F.lit(seed), "key", "file", "record")
    index = read_index(spark, folder).repartitionByRange(order).sortWithinPartitions(order)
    return index.select("name", "offset", "size").mapInArrow(fetched, f"`{key_col}` long, token_ids binary")
