"""Near duplicates by a chosen-path set similarity join over minwise tokens.

A document is the set of its word shingles. Equal sets form one class at once, by the digest of the set, and
only classes take part in what follows; their members come back at the end.

Classes are branched in ``trees`` independent trees. A step of a tree chooses some paths, each of
``TOKENS`` positions of the minwise signature: classes that agree on all of them meet in a node, whose key
is the path and the values. A pair of similarity s stays together on a path of a step with probability
s ** TOKENS; with ``threshold ** -TOKENS`` paths a step, a pair at the threshold is expected to stay together about
once, and unlike pairs part quickly.

* A node of at most ``LEAF`` classes is compared exhaustively in one task: pairs in descending order of
  estimated similarity, confirmed on the full sets, without pairs that are already connected. It hands on
  links of a forest, never all pairs.
* In a larger node of the first step every class is compared with the node's hub only, which connects the bulk of a large group of
  copies in linear work. Nodes whose classes were all connected by these hubs are done.
* In the others the classes outside the largest component are strays. Nodes of at most ``WIDE`` classes are compared exhaustively
  by short signatures, and at most ``LEAF`` strays with every block of their node. Others branch again, after their classes were
  compared with a hub.
* What is still large after ``STEPS`` steps agrees on nearly the whole signature: every block of strays is compared with every block.
  Nothing is dropped.

Links are confirmed on the full sets of 64-bit shingle hashes, so every reported link is real; each tree
misses a pair at the threshold with a probability that ``recall`` states, and the trees are independent.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapledger.llm.common import packed, row_key, unpacked
from snapledger.llm.graph import components
from snapledger.llm.wordhash import mix, text_slices, windows
from snapledger.operators.bloom import KeyFilter
from snapledger.session import discard, materialize, stored

#: Positions of a signature, and those that a path of one step agrees on.
POSITIONS = 64
TOKENS = 4
#: Classes up to which a node is compared exhaustively.
LEAF = 48
#: Classes up to which a larger node is compared as a whole by short signatures instead of branching again.
WIDE = 8 * LEAF
#: Shingles of all sets of a bunch of over 2 * LEAF classes, at most: 16 MB.
HELD = 2_000_000
#: What the rows of large nodes hold of their classes, so that no step has to look it up.
CARRIED = ("sign", "short", "size", "comp")
#: Steps of branching after which a node that is still large is compared block by block.
STEPS = 5
#: Bits of a position in the short signature that decides which members of a leaf may be similar.
SHORT_BITS = 4
#: Standard errors by which an estimated similarity may fall short before a pair is left out.
MARGIN = 4.0

_rng = np.random.default_rng(20240501)
_MULTIPLY = _rng.integers(1, 1 << 63, POSITIONS, dtype=np.uint64) | np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, POSITIONS, dtype=np.uint64)
_HIGH = np.uint64(32)


def signatures(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Minwise values (sets x POSITIONS) of non-empty sets of hashes given end to end.

    The minima of 32-bit hashes are kept as 16 bits: unlike ones agree in one of 65,536 cases, which only adds candidates.
    """
    out = np.empty((len(bounds) - 1, POSITIONS), np.uint16)
    for k in range(POSITIONS):
        values = ((sets * _MULTIPLY[k] + _ADD[k]) >> _HIGH).astype(np.uint32)
        least = np.minimum.reduceat(values, bounds[:-1])
        out[:, k] = (least ^ (least >> np.uint32(16))) & np.uint32(0xFFFF)
    return out


def shortened(signs: np.ndarray) -> np.ndarray:
    """The low bits of signatures, two positions a byte."""
    low = (signs & ((1 << SHORT_BITS) - 1)).astype(np.uint8)
    return low[:, ::2] | low[:, 1::2] << SHORT_BITS


def _sizes_fit(left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes can be linked."""
    return 100 * np.minimum(left, right) >= percent * np.maximum(left, right)


def paths_per_step(threshold: float) -> int:
    return math.ceil(round(threshold**-TOKENS, 6))


def recall(similarity: float, threshold: float, trees: int, steps: int = 1) -> float:
    """The probability that a pair meets in some leaf ``steps`` steps deep, at least."""
    stays = 1 - (1 - similarity**TOKENS) ** paths_per_step(threshold)
    return 1 - (1 - stays**steps) ** trees


@lru_cache(maxsize=100_000)
def _positions(path: int, first: int, paths: int) -> tuple[int, ...]:
    """Positions that ``path`` chooses, none of which its ancestors chose.

    Paths below ``first`` start at the root; the children of path p are ``paths`` numbers from ``first + p * paths``.
    """
    used: set[int] = set()
    above = path
    while above >= first:
        above = (above - first) // paths
        used |= set(_positions(above, first, paths))
    free = [k for k in range(POSITIONS) if k not in used]
    return tuple(np.random.default_rng(path + 7).permutation(free)[:TOKENS].tolist())


def _set_rows(texts: pa.Array, shingle: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For slices of texts: the first text's place, all distinct shingle hashes in order, and their bounds."""
    for first, last, words in text_slices(texts, lower=True):
        hashes, text, _ = windows(words.hashes(), words.bounds, shingle)
        for begin, end in itertools.pairwise(np.searchsorted(text, np.arange(last - first + 1)).tolist()):
            hashes[begin:end].sort()
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
        hashes, text = hashes[new], text[new]
        yield first, hashes, np.searchsorted(text, np.arange(last - first + 1))


def _digest(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def document_sets(docs: DataFrame, text_col: str, shingle: int) -> DataFrame:
    """``_row``, ``n_shingles``, the class (128-bit digest of the set) and its signatures, long and short; null for empty sets."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, hashes, bounds in _set_rows(batch.column("_text"), shingle):
                sizes = np.diff(bounds)
                filled = np.flatnonzero(sizes)
                classes: list[bytes | None] = [None] * len(sizes)
                signs: list[bytes | None] = [None] * len(sizes)
                shorts: list[bytes | None] = [None] * len(sizes)
                if len(filled):
                    found = signatures(hashes, np.append(bounds[:-1][filled], len(hashes)))
                    for k, sign, short in zip(filled.tolist(), found, shortened(found), strict=True):
                        classes[k] = _digest(hashes[bounds[k] : bounds[k + 1]])
                        signs[k], shorts[k] = sign.tobytes(), short.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_row").slice(first, len(sizes)),
                        pa.array(sizes, pa.int64()),
                        pa.array(classes, pa.binary()),
                        pa.array(signs, pa.binary()),
                        pa.array(shorts, pa.binary()),
                    ],
                    ["_row", "n_shingles", "cls", "sign", "short"],
                )

    rows = docs.select(F.col("_row"), F.col(text_col).alias("_text"))
    empty = F.lit(None).cast("binary")
    schema = rows.select("_row", F.lit(0).cast("long").alias("n_shingles"), empty.alias("cls"), empty.alias("sign"), empty.alias("short")).schema
    return rows.mapInArrow(measured, schema)


def _branch(rows: DataFrame, first: int, paths: int, root: bool) -> DataFrame:
    """Children (``path``, ``node``, ``cls``) of the root's rows (``cls``, ``sign``), or of a node's, which pass CARRIED on, too."""
    kept = ["cls"] if root else ["cls", *CARRIED]

    def children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sign = np.frombuffer(b"".join(batch.column("sign").to_pylist()), np.uint16).reshape(-1, POSITIONS)
            if root:
                groups = [(np.arange(len(sign)), range(first), np.zeros(len(sign), np.uint64))]
            else:
                path = batch.column("path").to_numpy()
                node = batch.column("node").to_numpy().view(np.uint64)
                groups = []
                for p in np.unique(path).tolist():
                    at = np.flatnonzero(path == p)
                    groups.append((at, range(first + p * paths, first + (p + 1) * paths), node[at]))
            for at, below, node in groups:
                taken = [batch.column(c).take(pa.array(at)) for c in kept]
                for p in below:
                    key = mix(node + np.uint64(p + 1))
                    for k in _positions(p, first, paths):
                        key = mix(key + sign[at, k])
                    columns = [pa.array(np.full(len(at), p, np.int64)), pa.array(key.view(np.int64)), *taken]
                    yield pa.RecordBatch.from_arrays(columns, ["path", "node", *kept])

    schema = "path long, node long, cls long"
    return rows.mapInArrow(children, schema if root else schema + ", sign binary, short binary, size long, comp long")


def _jaccard(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Sizes of intersection and union of two sorted sets."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return common, len(a) + len(b) - common


def _is_link(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common, union = _jaccard(a, b)
    return 100 * common >= percent * union


def _estimates(shorts: list[bytes]) -> np.ndarray:
    """Matching positions of every short signature with every other."""
    packed = np.frombuffer(b"".join(shorts), np.uint8).reshape(len(shorts), -1)
    sign = np.concatenate([packed & (1 << SHORT_BITS) - 1, packed >> SHORT_BITS], axis=1)
    out = np.empty((len(sign), len(sign)), np.int16)
    for k in range(len(sign)):
        out[k] = (sign == sign[k]).sum(axis=1)
    return out


def _matches(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Matching positions of the short signatures of each row."""
    x, y = (np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(len(c), POSITIONS // 2) for c in (left, right))
    low = (1 << SHORT_BITS) - 1
    return ((x ^ y) & low == 0).sum(axis=1) + ((x ^ y) >> SHORT_BITS == 0).sum(axis=1)


def _least_matches(percent: int, bits: int = 16) -> int:
    """Positions that two sets at the threshold share but for MARGIN errors; unlike minima agree in one of ``2 ** bits`` cases."""
    s = percent / 100
    s += (1 - s) / 2**bits
    return max(1, math.floor(POSITIONS * s - MARGIN * math.sqrt(POSITIONS * s * (1 - s))))


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each key, from batches that are sorted by it."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        starts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for begin, end in itertools.pairwise(starts):
            if held and keys[begin] != last:
                yield pa.Table.from_batches(held)
                held = []
            last = keys[begin]
            held.append(batch.slice(begin, end - begin))
    if held:
        yield pa.Table.from_batches(held)


def _parts(near: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links the least row that it is connected with."""
    part = np.arange(len(near))
    while True:
        least = np.minimum(part, np.where(near, part, len(part)).min(axis=1))
        least = least[least]
        if (least == part).all():
            return part
        part = least


def _bunches(rows: np.ndarray, near: np.ndarray, size: np.ndarray) -> Iterator[np.ndarray]:
    """The rows, or if they are too much for a task, for each pair of their blocks those with a link of the matrix ``near`` into the other one."""
    if len(rows) <= 2 * LEAF or size[rows].sum() <= HELD:
        yield rows
        return
    blocks = np.array_split(rows, math.ceil(len(rows) / LEAF))
    for i, a in enumerate(blocks):
        for b in blocks[i:]:
            links = near[np.ix_(a, b)]
            if links.any():
                yield np.union1d(a[links.any(axis=1)], b[links.any(axis=0)])


def _candidates(leaves: DataFrame, percent: int) -> DataFrame:
    """Rows (``bunch``, ``cls``, ``size``) of leaf members that some other member may be similar to.

    ``bunch`` names members of a node that are connected by such pairs; nodes with the same ones count once.
    Members of one ``side`` are not compared with each other, but for those of side -1.
    """
    least = _least_matches(percent, SHORT_BITS)

    def filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bunches: list[int] = []
        classes: list[int] = []
        sizes: list[int] = []

        def taken() -> pa.RecordBatch:
            columns = [pa.array(c, pa.int64()) for c in (bunches, classes, sizes)]
            return pa.RecordBatch.from_arrays(columns, ["bunch", "cls", "size"])

        for group in _groups(batches, "node"):
            if group.num_rows > 1:
                comp, size, cls = (group.column(c).to_numpy() for c in ("comp", "size", "cls"))
                side = group.column("side").to_numpy()
                may = (_estimates(group.column("short").to_pylist()) >= least) & (comp[:, None] != comp[None, :])
                may &= _sizes_fit(size[:, None], size[None, :], percent) & ((side[:, None] != side[None, :]) | (side[:, None] < 0))
                part = np.where(may.any(axis=1), _parts(may), -1)
                for p in np.unique(part[part >= 0]).tolist():
                    at = np.flatnonzero(part == p)
                    for held in _bunches(at[np.argsort(cls[at])], may, size):
                        held = held[np.argsort(cls[held])]
                        bunch = xxhash.xxh3_64_intdigest(cls[held].tobytes()) - (1 << 63)
                        bunches += [bunch] * len(held)
                        classes += cls[held].tolist()
                        sizes += size[held].tolist()
            if len(bunches) > 20_000:
                yield taken()
                bunches, classes, sizes = [], [], []
        if bunches:
            yield taken()

    ordered = leaves.select("node", "cls", "side", "short", "size", "comp").repartition("node").sortWithinPartitions("node")
    return ordered.mapInArrow(filtered, "bunch long, cls long, size long").distinct()


def _merged(bunches: DataFrame) -> DataFrame:
    """Rows (``bunch``, ``cls``) in which any two classes of a bunch are together, and the texts of most classes travel seldom.

    Bunches that share classes are a group. One of at most 2 * LEAF classes becomes one bunch. A larger one becomes a bunch for each pair
    of blocks of about WIDE / 2 classes, fewer where sets are long (``size``, if there), if that takes at most three quarters of its rows; else it stays as it is.
    """
    by_bunch, by_cls = Window.partitionBy("bunch"), Window.partitionBy("cls")
    named = bunches.withColumn("_low", F.min("cls").over(by_bunch)).withColumn("_low", F.min("_low").over(by_cls))
    grouped = named.withColumn("_group", F.min("_low").over(by_bunch))
    size = F.first("size") if "size" in bunches.columns else F.lit(0)
    members = grouped.groupBy("_group", "cls").agg(F.count(F.lit(1)).alias("_rows"), size.alias("_size"))
    groups = members.groupBy("_group").agg(F.count(F.lit(1)).alias("_n"), F.sum("_rows").alias("_rows"), F.sum("_size").alias("_held"))
    blocks = F.greatest(F.ceil(F.col("_n") / (WIDE // 2)), F.ceil(2 * F.col("_held") / HELD), F.lit(2)).cast("int")
    groups = groups.withColumn("_blocks", F.when(F.col("_n") <= 2 * LEAF, 1).otherwise(blocks))
    dealt_anew = (F.col("_blocks") == 1) | (4 * F.col("_n") * (F.col("_blocks") - 1) <= 3 * F.col("_rows"))
    kept = grouped.join(groups.filter(~dealt_anew).select("_group"), "_group").select("bunch", "cls")
    anew = members.select("_group", "cls").join(groups.filter(dealt_anew).select("_group", "_blocks"), "_group")
    own = F.pmod(F.xxhash64("cls"), "_blocks").cast("int").alias("_own")
    # A pair of one block meets in every pair of that block with another.
    others = F.when(F.col("_blocks") == 1, F.array(F.lit(0))).otherwise(F.array_remove(F.sequence(F.lit(0), F.col("_blocks") - 1), F.col("_own")))
    dealt = anew.select("_group", "cls", "_blocks", own).select("_group", "cls", "_own", F.explode(others).alias("_other"))
    bunch = F.xxhash64(F.lit("group"), "_group", F.least("_own", "_other"), F.greatest("_own", "_other"))
    return kept.unionByName(dealt.select(bunch.alias("bunch"), "cls"))


def _with_sets(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    """The rows, by slices, with the full sets of their texts as ``hashes`` in place of ``_text``."""
    for batch in batches:
        others = batch.drop_columns(["_text"])
        for first, hashes, bounds in _set_rows(batch.column("_text"), shingle):
            n = len(bounds) - 1
            data = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(bounds.astype(np.int64) * 8), pa.py_buffer(hashes)])
            yield others.slice(first, n).append_column("hashes", data)


def _confirmed(members: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (``a``, ``b``) of a spanning forest of each bunch of rows (``bunch``, ``cls``, ``short``, ``comp``, ``_text``).

    Texts travel, as they compress well and hashes don't.
    """
    least = _least_matches(percent, SHORT_BITS)

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(_with_sets(batches, shingle), "bunch"):
            names = group.column("cls").to_pylist()
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("hashes")]
            comps: dict[int, int] = {}
            root = [comps.setdefault(c, k) for k, c in enumerate(group.column("comp").to_pylist())]

            def find(k: int, root: list[int] = root) -> int:
                while root[k] != k:
                    root[k] = k = root[root[k]]
                return k

            matches = _estimates(group.column("short").to_pylist())
            sizes = np.array([len(x) for x in sets])
            left, right = np.nonzero(np.triu((matches >= least) & _sizes_fit(sizes[:, None], sizes[None, :], percent), 1))
            order = np.argsort(-matches[left, right], kind="stable")
            found = []
            for i, j in zip(left[order].tolist(), right[order].tolist(), strict=True):
                a, b = find(i), find(j)
                if a != b and _is_link(sets[i], sets[j], percent):
                    root[b] = a
                    found.append((names[i], names[j]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["a", "b"])

    ordered = members.repartition("bunch").sortWithinPartitions("bunch")
    return ordered.mapInArrow(linked, "a long, b long")


def _union(parts: list[DataFrame]) -> DataFrame:
    every = parts[0]
    for more in parts[1:]:
        every = every.unionByName(more)
    return every


def _starred(links: DataFrame) -> DataFrame:
    """The same connections as ``links``, batch by batch as links to the least class of each component: short ways take few rounds."""

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            root: dict[int, int] = {}

            def find(k: int, root: dict[int, int] = root) -> int:
                root.setdefault(k, k)
                while root[k] != k:
                    root[k] = k = root[root[k]]
                return k

            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                a, b = find(a), find(b)
                root[max(a, b)] = min(a, b)
            nodes = [k for k in root if root[k] != k]
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(map(find, nodes), pa.int64())], ["a", "b"])

    return links.mapInArrow(stars, "a long, b long")


class _Join:
    """One run of the join over the classes (``cls``, ``_k1``, ``_k2``, ``size``, ``sign``, ``short``)."""

    def __init__(self, classes: DataFrame, docs: DataFrame, shingle: int, percent: int, trees: int):
        self.classes, self.docs, self.shingle, self.percent = classes, docs, shingle, percent
        self.paths = paths_per_step(percent / 100)
        self.first = trees * self.paths
        self.links: list[DataFrame] = []
        self.comps: DataFrame | None = None

    def run(self) -> DataFrame:
        """Links (``a``, ``b``) between classes."""
        rows = _branch(self.classes.select("sign", "cls"), self.first, self.paths, root=True)
        with stored(rows, "nodes") as found:
            members = materialize(found.join(self._open_nodes(found), "node"), "members")
        # Most classes meet no other: what follows needs the signatures of the rest only.
        self.classes = materialize(self.classes.join(members.select("cls").distinct(), "cls"), "met-classes")
        leaves, done = [], [members]
        many = members.filter(F.col("n") > LEAF).drop("n")
        if not many.isEmpty():
            large = materialize(self._with(many, "sign", "short", "size"), "large-nodes")
            self._add_hub_links(large)
            # These hubs connect most of what is similar; their components spare the rest work.
            self.comps = components(_starred(self.links[0]))
            rows = self._with_comp(large)
            done.append(large)
            for step in range(STEPS):
                still = materialize(self._open_rows(rows), "open-rows")
                done.append(still)
                leaves.append(_whole(still.filter(F.col("n") <= WIDE)))
                still = still.filter(F.col("n") > WIDE)
                leaves.append(self._stray_blocks(still.filter(F.col("m") <= LEAF)))
                rest = still.filter(F.col("m") > LEAF)
                if rest.isEmpty():
                    break
                if step == STEPS - 1:
                    leaves.append(self._blocks(rest))
                    break
                if step:
                    leaves.append(self._hub_blocks(rest))
                children = rest.select("path", "node", "cls", *CARRIED)
                rows = materialize(_branch(children, self.first, self.paths, root=False), "nodes")
                done.append(rows)
        leaves.append(self._with_comp(self._with(_whole(members.filter(F.col("n") <= LEAF)), "short", "size")))
        bunches = materialize(_candidates(_union(leaves), self.percent), "bunches")
        for table in done:
            discard(table)
        with stored(_merged(bunches), "groups") as groups:
            self.links.append(materialize(self._confirmed(groups), "near-links"))
        discard(bunches)
        return _union(self.links)

    def _confirmed(self, bunches: DataFrame) -> DataFrame:
        """The links within rows (``bunch``, ``cls``) that are stored, by full sets made anew from a text of each class."""
        wanted = self.classes.join(bunches.select("cls").distinct(), "cls").select("cls", "_k1", "_k2", "short")
        wanted = materialize(self._with_comp(wanted), "wanted")
        # Few documents are wanted: the others' texts stay where they are, as far as a filter of bounded size can tell.
        known = KeyFilter.build(wanted, "_k1")
        docs = self.docs if known is None else self.docs.filter(known.might_contain(F.col("_k1")))
        # Repeated rows of the input give a text once.
        texts = docs.dropDuplicates(["_k1", "_k2"])
        members = bunches.join(wanted, "cls").join(texts, ["_k1", "_k2"]).select("bunch", "cls", "short", "comp", "_text")
        return _confirmed(members, self.shingle, self.percent)

    def _with_comp(self, rows: DataFrame) -> DataFrame:
        """Add the component known so far."""
        if self.comps is None:
            return rows.withColumn("comp", F.col("cls"))
        known = self.comps.select(F.col("node").alias("cls"), F.col("comp").alias("_comp"))
        return rows.join(known, "cls", "left").withColumn("comp", F.coalesce("_comp", "cls")).drop("_comp")

    def _with(self, rows: DataFrame, *columns: str) -> DataFrame:
        return rows.join(self.classes.select("cls", *columns), "cls")

    def _open_nodes(self, rows: DataFrame) -> DataFrame:
        """Nodes with classes of more than one component: ``node`` and the number of classes ``n``."""
        mark = F.xxhash64("comp")
        agg = [F.count(F.lit(1)).alias("n"), F.min(mark).alias("_low"), F.max(mark).alias("_high")]
        return self._with_comp(rows).groupBy("node").agg(*agg).filter("_low <> _high").select("node", "n")

    def _open_rows(self, seen: DataFrame) -> DataFrame:
        """The rows of nodes that more than one component is left in.

        ``n`` classes of the node, ``m`` of them strays outside its largest component, and whether the class is one, or the hub.
        """
        least = F.min(F.xxhash64("node", "cls")).alias("_least")
        sizes = seen.groupBy("node", "comp").agg(F.count(F.lit(1)).alias("_c"), least)
        top = F.max(F.struct("_c", "comp")).alias("_top")
        nodes = sizes.groupBy("node").agg(F.sum("_c").alias("n"), top, F.min("_least").alias("_least"))
        nodes = nodes.select("node", "n", (F.col("n") - F.col("_top._c")).alias("m"), F.col("_top.comp").alias("_most"), "_least")
        rows = seen.join(nodes.filter("m > 0"), "node")
        hub = (F.xxhash64("node", "cls") == F.col("_least")).alias("hub")
        return rows.select("path", "node", "cls", *CARRIED, "n", "m", (F.col("comp") != F.col("_most")).alias("stray"), hub)

    def _add_hub_links(self, large: DataFrame) -> None:
        """Compare the classes of large nodes with a hub of theirs."""
        with stored(self._near_hubs(large), "hub-pairs") as pairs:
            # The partners of a hub are dealt to bunches of about LEAF, each with the hub.
            sizes = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / LEAF).alias("_blocks"))
            dealt = pairs.join(sizes, "hub").withColumn("bunch", F.xxhash64("hub", F.pmod(F.xxhash64("cls"), "_blocks")))
            hubs = dealt.select("bunch", F.col("hub").alias("cls")).distinct()
            with stored(dealt.select("bunch", "cls").unionByName(hubs), "hub-bunches") as bunches:
                self.links.append(materialize(self._confirmed(bunches), "hub-links"))

    def _near_hubs(self, large: DataFrame) -> DataFrame:
        """Pairs (``cls``, ``hub``) that may be similar."""
        chance = F.struct(F.xxhash64("node", "cls"), "cls", "short", "size")
        hubs = large.groupBy("node").agg(F.min(chance).alias("h"))
        hubs = hubs.select("node", F.col("h.cls").alias("hub"), F.col("h.short").alias("hub_short"), F.col("h.size").alias("_of"))
        fit = 100 * F.least("size", "_of") >= self.percent * F.greatest("size", "_of")
        near = large.select("node", "cls", "short", "size").join(hubs, "node").filter("cls <> hub").filter(fit)
        least = _least_matches(self.percent, SHORT_BITS)

        def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kept = batch.filter(pa.array(_matches(batch.column("short"), batch.column("hub_short")) >= least))
                yield kept.select(["cls", "hub"])

        return near.select("cls", "hub", "short", "hub_short").mapInArrow(similar, "cls long, hub long").distinct()

    def _stray_blocks(self, rows: DataFrame) -> DataFrame:
        """Nodes as a node for each block of about LEAF classes of their largest component, with all their strays."""
        return _with_each_block(rows, "stray", F.col("n") - F.col("m"))

    def _hub_blocks(self, rows: DataFrame) -> DataFrame:
        """Nodes as a node for each block of about LEAF classes, with the hub."""
        return _with_each_block(rows, "hub", F.col("n"))

    def _blocks(self, rows: DataFrame) -> DataFrame:
        """Nodes as a node for each pair of a block of strays and another, of at most about LEAF classes together."""
        strays, others = (F.ceil(n / (LEAF // 2)).cast("int") for n in (F.col("m"), F.col("n") - F.col("m")))
        mark = F.xxhash64("cls")
        own = F.when(F.col("stray"), F.pmod(mark, strays)).otherwise(strays + F.pmod(mark, others)).cast("int")
        last = F.when(F.col("stray"), strays + others).otherwise(strays) - 1
        dealt = rows.select("*", own.alias("_own"), F.explode(F.sequence(F.lit(0), last)).alias("_other"))
        # What is in one block is compared once, in the pair of the block with itself.
        side = F.when(F.col("_own") == F.col("_other"), -1).otherwise((F.col("_own") < F.col("_other")).cast("int"))
        node = F.xxhash64("node", F.least("_own", "_other"), F.greatest("_own", "_other"))
        return _leaf(dealt.withColumn("node", node).withColumn("side", side))


def _leaf(rows: DataFrame) -> DataFrame:
    """The rows without what only a node that branches needs."""
    return rows.drop("path", "sign", "n", "m", "stray", "hub", "_own", "_other", "_block")


def _whole(rows: DataFrame) -> DataFrame:
    """Nodes whose classes are all compared with each other."""
    return _leaf(rows.withColumn("side", F.lit(-1)))


def _with_each_block(rows: DataFrame, role: str, others: Column) -> DataFrame:
    """Nodes as a node for each block of about LEAF of their ``others`` classes, with all classes of the role."""
    blocks = F.ceil(others / LEAF).cast("int")
    places = F.when(F.col(role), F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(F.pmod(F.xxhash64("cls"), blocks).cast("int")))
    side = F.when(F.col(role), -1).otherwise(0).alias("side")
    dealt = rows.select("*", side, F.explode(places).alias("_block"))
    return _leaf(dealt.withColumn("node", F.xxhash64(F.lit(role), "node", "_block")))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    percent: int = 80,
    trees: int = 8,
) -> DataFrame:
    """One row per input row: ``id_col``, ``n_shingles``, ``component_id``, ``kept``, and the hashes of the row.

    A document is the set of its distinct shingles of ``shingle`` words, A-Z lower-cased; with fewer words, the
    whole sequence is one. Documents are linked if 100 * intersection >= ``percent`` * union. ``component_id`` is the
    least id reachable over links, ``kept`` whether it is the row's own. ``_k1`` and ``_k2`` are hashes of id and text.

    * Documents without words (null, empty) have no shingles and are linked with nothing: ``component_id`` is their id.
    * Equal sets are always linked. Repeated rows give repeated results.
    * Rows without an id take part; they are kept only if no row of their component has an id.
    * Other columns are not read. An empty table gives no rows.
    """
    ident, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    source = docs.select(ident.alias("_id"), *row_key(ident, text), text.alias("_text"))
    narrow = source.select(F.struct("_id", "_k1", "_k2").alias("_row"), "_text")
    measured = materialize(
        document_sets(narrow, "_text", shingle).select("_row.*", "n_shingles", "cls", "sign", "short"), "documents"
    )
    classes = (
        measured.filter("cls IS NOT NULL")
        .groupBy("cls")
        .agg(F.min("_id").alias("_id"), F.min(F.struct("_id", "_k1", "_k2")).alias("_first"), F.first("n_shingles").alias("size"), F.first("sign").alias("sign"), F.first("short").alias("short"))
    )
    # Numbered once, so that all tables of the join carry eight bytes a class.
    number = F.monotonically_increasing_id().alias("_number")
    classes = materialize(classes.select("cls", number, "_id", "_first._k1", "_first._k2", "size", "sign", "short"), "classes")
    numbered = classes.select(F.col("_number").alias("cls"), "_k1", "_k2", "size", "sign", "short")
    links = _Join(numbered, source.select("_k1", "_k2", "_text"), shingle, percent, trees).run()
    found = components(_starred(links)).withColumnRenamed("node", "_number")
    # Components are named by classes; their least id names the documents'.
    comps = classes.select("cls", "_number", "_id").join(found, "_number")
    least = comps.groupBy("comp").agg(F.min("_id").alias("_least"))
    named = comps.join(least, "comp").select("cls", "_least")
    own = classes.select("cls", F.col("_id").alias("_own")).join(named, "cls", "left")
    own = own.select("cls", F.coalesce("_least", "_own").alias("_least"))
    component = F.coalesce("_least", "_id")
    return measured.join(own, "cls", "left").select(
        F.col("_id").alias(id_col),
        "n_shingles",
        component.alias("component_id"),
        component.eqNullSafe(F.col("_id")).alias("kept"),
        "_k1",
        "_k2",
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The input rows that ``near_duplicates`` keeps, with their columns: the least id of each component.

    Of repeated rows one stays; so it does of rows without an id that hold the same text.
    """
    ident, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    kept = near_duplicates(docs, id_col, text_col, **options).filter("kept").select("_k1", "_k2").distinct()
    rows = docs.select(packed(docs, []), *row_key(ident, text))
    stay = rows.join(kept, ["_k1", "_k2"]).dropDuplicates(["_k1", "_k2"])
    return stay.select(*unpacked(stay))
