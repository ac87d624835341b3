"""Self-join of documents on the Jaccard similarity of their word shingles, by partitioning the universe.

For sets of r and s shingles at similarity t or more, the symmetric difference is at most H = (r + s)(1 - t)/(1 + t).
Shingles are hashed into m segments, m fixed for a band of sizes; one differing shingle spoils one segment, so a similar pair
shares all but H of its non-empty segment subsets.  A subset's signature is the sum of its scrambled shingles.

*Allocation.* Where H is at most one (tiny sets) the whole set is one segment, and the set and its one-deletion neighbourhood
are indexed: a pair differing by one shingle always meets.  That costs one signature per shingle, which pays only there.
Larger sets index exact subsets: the first H + 1 + slack in one global order that puts the cheapest first, cost being the
expected number of sets with that subset, which falls with the shingles in it.  By pigeonhole two similar sets share at least
slack + 1 signatures.  The frequencies of all signatures come out of the same pass, so each set then gives up its ``slack`` most
frequent ones (again one global order, so one shared signature is left): widely shared passages are not compared.
m is the smallest number for which a set having too few non-empty segments is as unlikely as a hash collision (2**-64).

*Candidates.* A signature with few sets yields its pairs.  One with many yields block pairs of bounded size, compared inside
tasks; only links that join something new leave the task.  Both are filtered by a parity sketch: a differing shingle flips one
bit of 512 (of as many as the set has shingles, for long ones), so more differing bits than H exclude a pair for certain;
pairs are also counted: with fewer shared signatures than slack + 1, hot ones included, they are none.

*Verification.* Connected candidates meet once, by component in blocks of bounded size, and links are decided on the whole
shingle sets, recomputed from the texts.  Documents with the same set are one node throughout.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, stage_table, texts_of, tidied
from .components import components
from .shingles import WordHashes, mix, shingle_sets

SKETCH = 512             # parity bits of a set
_FEW = 16                # sets of one signature that are paired directly
_BLOCK = 1024            # sets compared in one task at a time
_BLOCK_SHINGLES = 1 << 22
_BROADCAST = 1_000_000   # rows (six numbers at most, some 50 MB together) up to which a filter on documents is broadcast
_LOWEST = 24             # sizes from here on are banded by factors of four


@dataclass(frozen=True)
class Limits:
    """Bounds that follow from the similarity ``num / den``."""

    num: int = 75
    den: int = 100

    def differ(self, total: int) -> int:
        """Most differing shingles of a similar pair with ``total`` shingles in both sets."""
        return total * (self.den - self.num) // (self.den + self.num)

    def largest(self, size: int) -> int:
        return size * self.den // self.num

    def smallest(self, size: int) -> int:
        return -(-size * self.num // self.den)

    def budget(self, size: int) -> int:
        """Most segments that a set of this size can have spoiled by any partner."""
        return self.differ(size + self.largest(size))

    def slack(self, size: int) -> int:
        return max(0, min(size - self.budget(size) - 1, 2 + size // 16))

    def prefix(self, size: int) -> int:
        return self.budget(size) + 1 + self.slack(size)

    def spare(self, size: int) -> int:
        """Signatures a set may give up: the slack of its smallest possible partner."""
        return self.slack(max(1, self.smallest(size)))

    @property
    def tiny(self) -> int:
        """Pairs with fewer shingles than this differ by one at most."""
        return next(t for t in range(2, 10**6) if self.differ(t) >= 2)

    def neighbours(self, size: int) -> bool:
        return size + self.smallest(size) < self.tiny

    def segmented(self, size: int) -> bool:
        return size + self.largest(size) >= self.tiny

    def bands(self, size: int) -> list[int]:
        """Bands of the larger sets that a set of this size can meet."""
        return sorted({band(size), band(self.largest(size))})

    def segments(self, which: int) -> int:
        """Segments of a band: enough that no set that enters it lacks non-empty ones, but for odds of 2**-64."""
        low, high = (1, _LOWEST) if which == 0 else (_LOWEST * 4 ** (which - 1), _LOWEST * 4 ** which)
        if which == 0:
            return 1 << 62
        sizes = {int(low + (high - low) * k / 32) for k in range(32)} | {self.smallest(low), high - 1}

        def fails(m: int, size: int) -> bool:
            k = self.prefix(size) - 1
            if k >= m:
                return True
            choose = math.lgamma(m + 1) - math.lgamma(k + 1) - math.lgamma(m - k + 1)
            return choose + size * math.log(max(k, 0.5) / m) > -64 * math.log(2)
        m = max(self.prefix(s) for s in sizes) + 1
        while any(fails(m, s) for s in sizes):
            m = m * 21 // 20 + 1
        return m


def band(size: int) -> int:
    return 0 if size < _LOWEST else 1 + int(math.log(size / _LOWEST, 4) + 1e-9)


def node_of(items: np.ndarray) -> np.uint64:
    """Hash of a set."""
    return mix(mix(items + np.uint64(1)).sum(dtype=np.uint64, keepdims=True))[0]


class _Signatures:
    """Signatures of shingle sets."""

    def __init__(self, limits: Limits):
        self.limits, self.m = limits, {}

    def of(self, items: np.ndarray) -> np.ndarray:
        limits, size = self.limits, len(items)
        out = []
        if limits.neighbours(size) and size > 1:
            each = mix(items + np.uint64(1))
            whole = each.sum(dtype=np.uint64)
            out.append(mix(np.append(whole - each, whole)))
        if limits.segmented(size):
            for which in limits.bands(size):
                if which not in self.m:
                    self.m[which] = np.uint64(limits.segments(which))
                segment = items % self.m[which]
                order = np.argsort(segment, kind="stable")
                segment = segment[order]
                starts = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
                subset = mix(np.add.reduceat(mix(items[order] + np.uint64(2 + which)), starts))
                shingles = np.diff(np.append(starts, size))
                first = np.lexsort((subset, -shingles))[:limits.prefix(size)]
                out.append(subset[first])
        return np.concatenate(out) if out else np.empty(0, np.uint64)


def _parity(items: np.ndarray, bits: int) -> np.ndarray:
    return np.packbits((np.bincount((items & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8))


def wide_sketch(items: np.ndarray) -> bytes:
    """As sketch, with at least a bit for each shingle; nothing for sets that the short sketch serves."""
    return _parity(items, 1 << (len(items) - 1).bit_length()).tobytes() if len(items) > SKETCH else b""


def differing(a: bytes, b: bytes) -> int:
    """Shingles that differ at the least, from two wide sketches, the longer folded to the length of the shorter."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) != len(y):
        x, y = (x, y) if len(x) > len(y) else (y, x)
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def sketch(items: np.ndarray) -> np.ndarray:
    """Parity of the number of shingles in each of SKETCH classes, as 64-bit words."""
    return _parity(items, SKETCH).view("<i8")


def _read(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))


_S = [f"s{k}" for k in range(SKETCH // 64)]


def document_sets(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """id, mark (hash of the text), n, node (hash of the set), and the sketch s0, s1, ... of each document."""
    kind = docs.schema[id_col].dataType.simpleString()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            rows = len(batch)
            n, nodes = np.zeros(rows, np.int64), np.zeros(rows, np.uint64)
            marks, wide = np.zeros((rows, len(_S)), np.int64), []
            for k, items in enumerate(shingle_sets(texts_of(batch), hashes, size)):
                n[k] = len(items)
                nodes[k] = node_of(items)
                marks[k] = sketch(items)
                wide.append(wide_sketch(items))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("mark"), pa.array(n), pa.array(nodes.view(np.int64)),
                                              *[pa.array(marks[:, k].copy()) for k in range(len(_S))], pa.array(wide, pa.binary())],
                                             names=["id", "mark", "n", "node", *_S, "wide"])
    read = _read(docs, id_col, text_col).withColumn("mark", F.xxhash64("text"))
    return read.mapInArrow(tidied(measure), f"id {kind}, mark long, n long, node long, " + ", ".join(f"{s} long" for s in _S) + ", wide binary")


def set_signatures(docs: DataFrame, id_col: str, text_col: str, size: int, limits: Limits) -> DataFrame:
    """sig, node: the signatures of every set that another one can resemble."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, signatures = WordHashes(), _Signatures(limits)

        def batch_of(sigs: list, nodes: list) -> pa.RecordBatch:
            counts = [len(s) for s in sigs]
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs).view(np.int64)),
                                               pa.array(np.repeat(np.array(nodes, np.uint64), counts).view(np.int64))], names=["sig", "node"])
        for batch in batches:
            sigs, nodes, held = [], [], 0
            for items in shingle_sets(texts_of(batch), hashes, size):
                got = signatures.of(items)
                if len(got):
                    sigs.append(got)
                    nodes.append(node_of(items))
                    held += len(got)
                if held > 200_000:
                    yield batch_of(sigs, nodes)
                    sigs, nodes, held = [], [], 0
            if sigs:
                yield batch_of(sigs, nodes)
    return _read(docs, id_col, text_col).select("text").mapInArrow(tidied(sign), "sig long, node long")


_MET = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("sig", pa.int64()), ("shared", pa.int64())])


def _met(sig: np.ndarray, node: np.ndarray, hot: bool) -> Iterator[pa.RecordBatch]:
    """Pairs of the nodes of each run of equal signatures, or the rows themselves where the runs are long."""
    if not len(sig):
        return
    starts = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
    counts = np.diff(np.append(starts, len(sig)))
    for g in np.unique(counts) if not hot else [0]:
        if hot or g > _FEW:
            rows = np.arange(len(sig)) if hot else (starts[counts == g][:, None] + np.arange(g)).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(node[rows]), pa.nulls(len(rows), pa.int64()), pa.array(sig[rows]),
                                              pa.nulls(len(rows), pa.int64())], schema=_MET)
        elif g > 1:
            runs = node[starts[counts == g][:, None] + np.arange(g)]
            i, j = np.triu_indices(g, 1)
            pairs, times = np.unique(np.stack([runs[:, i].ravel(), runs[:, j].ravel()]), axis=1, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1]), pa.nulls(pairs.shape[1], pa.int64()),
                                              pa.array(times)], schema=_MET)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams rows sorted by signature and node; holds no more than one batch and _FEW rows."""
    sig, node, hot = np.empty(0, np.int64), np.empty(0, np.int64), False
    for batch in batches:
        if not len(batch):
            continue
        sig = np.append(sig, batch.column("sig").to_numpy(zero_copy_only=False))
        node = np.append(node, batch.column("node").to_numpy(zero_copy_only=False))
        new = np.append(True, (sig[1:] != sig[:-1]) | (node[1:] != node[:-1]))
        sig, node = sig[new], node[new]
        last = int(np.searchsorted(sig, sig[-1]))
        if hot:  # the first run goes on a run whose beginning has left already
            end = int(np.searchsorted(sig, sig[0], "right"))
            yield from _met(sig[1:end], node[1:end], True)
            if end == len(sig):
                sig, node = sig[-1:], node[-1:]
                continue
            sig, node, last, hot = sig[end:], node[end:], last - end, False
        yield from _met(sig[:last], node[:last], False)
        sig, node = sig[last:], node[last:]
        if len(sig) > _FEW:
            yield from _met(sig, node, True)
            sig, node, hot = sig[-1:], node[-1:], True
    if not hot:
        yield from _met(sig, node, False)


def runs_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[list[pa.RecordBatch]]:
    """Consecutive rows with equal keys, as slices of batches; one run is held at a time."""
    held, last = [], None
    for batch in batches:
        values = list(zip(*[batch.column(k).to_pylist() for k in keys]))
        start = 0
        for k in range(1, len(values) + 1):
            if k == len(values) or values[k] != values[start]:
                if held and values[start] != last:
                    yield held
                    held = []
                held.append(batch.slice(start, k - start))
                last, start = values[start], k
    if held:
        yield held


def _join(labels: np.ndarray, x: int, y: int) -> None:
    labels[labels == labels[y]] = labels[x]


def _compare_sketches(limits: Limits):
    """Links of each block pair that the sketches leave possible and that join something new."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs_of(batches, ["sig", "i", "j"]):
            rows = pa.Table.from_batches(run)
            node, n, own = (rows.column(c).to_numpy() for c in ("node", "n", "own"))
            marks = np.stack([rows.column(s).to_numpy() for s in _S], axis=1).view(np.uint64)
            wide = rows.column("wide").to_pylist()
            across = rows.column("i")[0].as_py() != rows.column("j")[0].as_py()
            labels, a, b = np.arange(len(node)), [], []
            for x in range(len(node) - 1):
                y = np.arange(x + 1, len(node))
                y = y[(labels[y] != labels[x]) & ((own[y] != own[x]) if across else True)]
                total = n[y] + n[x]
                y = y[(np.minimum(n[y], n[x]) * limits.den >= np.maximum(n[y], n[x]) * limits.num)
                      & (np.bitwise_count(marks[y] ^ marks[x]).sum(axis=1) <= total * (limits.den - limits.num) // (limits.den + limits.num))]
                for z in y:
                    if labels[z] == labels[x] or wide[x] and wide[z] and differing(wide[x], wide[z]) > limits.differ(int(n[x] + n[z])):
                        continue
                    _join(labels, x, z)
                    a.append(node[x])
                    b.append(node[z])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return compare


def _blocks(rows: DataFrame, key: str, shares: str) -> DataFrame:
    """Each row once for every block pair of its key that holds it: columns own, i, j."""
    own = rows.withColumn("own", F.expr(f"pmod(xxhash64(node), {shares})"))
    other = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col(shares) - 1)))
    return other.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).repartition(key, "i", "j").sortWithinPartitions(key, "i", "j", "node")


def _tiny(limits: Limits) -> list[int]:
    return [k for k in range(1, 65) if limits.neighbours(k)]


def _by_size(column: str, small, large) -> Column:
    """A number that follows from a set's size: looked up for sizes to 64, where its parts still bend, else a formula."""
    table = F.array(*[F.lit(small(k)) for k in range(1, 65)])
    return F.when(F.col(column) <= 64, F.element_at(table, F.least(F.col(column), F.lit(64)).cast("int"))).otherwise(large(column))


def _prefix(limits: Limits):
    return lambda c: F.expr(f"({c} + {c} * {limits.den} div {limits.num}) * {limits.den - limits.num} div {limits.den + limits.num} + 3 + {c} div 16")


def candidate_links(signatures: DataFrame, nodes: DataFrame, limits: Limits) -> DataFrame:
    """a, b: links that may hold, enough of them to connect whatever similar sets connect."""
    met = stage_table(signatures.repartition("sig").sortWithinPartitions("sig", "node").mapInArrow(tidied(_meet), "a long, b long, sig long, shared long"))
    hot = met.filter("sig IS NOT NULL").select("sig", F.col("a").alias("node"))
    often = hot.groupBy("sig").agg(F.count("*").alias("g"))
    hots = hot.groupBy("node").agg(F.count("*").alias("h"))
    near = nodes.select("node", "n", *_S).join(hots, "node", "left").withColumn("h", F.coalesce("h", F.lit(0)))
    left, right = near.toDF(*[f"{c}_a" for c in near.columns]), near.toDF(*[f"{c}_b" for c in near.columns])
    # a similar pair shares as many signatures as its shorter list has above the most that can be spoiled, hot ones included
    pairs = met.filter("sig IS NULL").groupBy("a", "b").agg(F.sum("shared").alias("shared"))
    pairs = pairs.join(left, F.col("a") == F.col("node_a")).join(right, F.col("b") == F.col("node_b"))
    lists = F.least(_by_size("n_a", limits.prefix, _prefix(limits)), _by_size("n_b", limits.prefix, _prefix(limits)))
    differ = F.expr(f"(n_a + n_b) * {limits.den - limits.num} div {limits.den + limits.num}")
    tiny = F.col("n_a").isin(_tiny(limits)) | F.col("n_b").isin(_tiny(limits))
    enough = tiny | (F.col("shared") + F.least("h_a", "h_b") >= lists - differ)
    bits = " + ".join(f"bit_count({s}_a ^ {s}_b)" for s in _S)
    pairs = pairs.filter(enough & (F.expr(bits) <= differ) & F.expr(f"least(n_a, n_b) * {limits.den} >= greatest(n_a, n_b) * {limits.num}")).select("a", "b")

    spare = F.when(F.col("n").isin(_tiny(limits)), 0).otherwise(
        _by_size("n", limits.spare, lambda c: F.expr(f"2 + ceil({c} * {limits.num} / {limits.den}) div 16")))
    dearest = Window.partitionBy("node").orderBy(F.col("g").desc(), F.col("sig"))
    forced = (hot.join(often, "sig").join(near.select("node", "n"), "node")
              .withColumn("_rank", F.row_number().over(dearest)).filter(F.col("_rank") > spare).select("sig", "node"))
    forced = stage_table(forced)
    shares = forced.groupBy("sig").agg(F.ceil(F.count("*") / _BLOCK).alias("shares"))
    dealt = _blocks(forced.join(shares, "sig").join(nodes.select("node", "n", *_S, "wide"), "node"), "sig", "shares")
    links = dealt.select("sig", "i", "j", "own", "node", "n", *_S, "wide").mapInArrow(tidied(_compare_sketches(limits)), "a long, b long")
    return pairs.union(links)


def _verify(limits: Limits, size: int):
    """Links of each block pair of a component that hold on the whole sets and that join something new."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for run in runs_of(batches, ["root", "i", "j"]):
            rows = pa.Table.from_batches(run)
            node, own = rows.column("node").to_numpy(), rows.column("own").to_numpy()
            across = rows.column("i")[0].as_py() != rows.column("j")[0].as_py()
            sets = list(shingle_sets(rows.column("text").to_pylist(), hashes, size))
            # an id may stand on several texts: the one meant is known by the hash of its set, and is needed once
            here = {v: k for k, v in enumerate(node) if node_of(sets[k]).view(np.int64) == v}
            node, own, sets = np.array(list(here), np.int64), own[list(here.values())], [sets[k] for k in here.values()]
            if len(node) < 2:
                continue
            n = np.array([len(s) for s in sets])
            marks = np.stack([sketch(s) for s in sets]).view(np.uint64)
            labels, a, b = np.arange(len(node)), [], []
            for x in range(len(node) - 1):
                y = np.arange(x + 1, len(node))
                y = y[(labels[y] != labels[x]) & ((own[y] != own[x]) if across else True)]
                total = n[y] + n[x]
                y = y[(np.minimum(n[y], n[x]) * limits.den >= np.maximum(n[y], n[x]) * limits.num)
                      & (np.bitwise_count(marks[y] ^ marks[x]).sum(axis=1) <= total * (limits.den - limits.num) // (limits.den + limits.num))]
                for z in y:
                    if labels[z] == labels[x]:
                        continue
                    both = len(np.intersect1d(sets[x], sets[z], assume_unique=True))
                    if both * limits.den >= (n[x] + n[z] - both) * limits.num:
                        _join(labels, x, z)
                        a.append(node[x])
                        b.append(node[z])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return verify


def classed_documents(docs: DataFrame, id_col: str, text_col: str, size: int, num: int, den: int) -> DataFrame:
    """id, mark (hash of the text), n, class of every row; rows are of one class if links connect them, blank ones of none."""
    limits = Limits(num, den)
    sets = stage_table(document_sets(docs, id_col, text_col, size))
    nodes = stage_table(sets.filter("n > 0").dropDuplicates(["node"]))
    links = candidate_links(set_signatures(docs, id_col, text_col, size, limits), nodes, limits)
    maybe = stage_table(components(links))

    # one text per node that has a possible partner, that of a row with an id if there is one
    sizes = maybe.join(nodes.select("node", "n"), "node").groupBy("root").agg(F.count("*").alias("c"), F.sum("n").alias("w"))
    sizes = sizes.select("root", F.greatest(F.ceil(F.col("c") / _BLOCK), F.ceil(F.col("w") / _BLOCK_SHINGLES)).alias("shares"))
    picks = sets.groupBy("node").agg(F.min(F.struct(F.col("id").isNull().alias("lost"), "id", "mark")).alias("pick"))
    wanted = stage_table(maybe.join(sizes, "root").join(picks, "node").select("root", "node", "shares", "pick.*"))
    few = F.broadcast(wanted) if wanted.count() <= _BROADCAST else wanted
    read = _read(docs, id_col, text_col).withColumn("mark", F.xxhash64("text"))
    texts = read.join(few.filter("NOT lost").drop("lost"), ["id", "mark"]).select("root", "shares", "node", "text")
    if not wanted.filter("lost").isEmpty():
        # rows without an id are told apart by their texts alone, and copies of one come once
        lost = read.filter("id IS NULL").drop("id").join(few.filter("lost").drop("id", "lost"), "mark")
        texts = texts.unionByName(lost.select("root", "shares", "node", "text").dropDuplicates(["node"]))
    dealt = _blocks(texts, "root", "shares").select("root", "i", "j", "own", "node", "text")
    found = components(dealt.mapInArrow(tidied(_verify(limits, size)), "a long, b long"))
    return sets.join(found, "node", "left").select("id", "mark", "n", F.when(F.col("n") > 0, F.coalesce("root", "node")).alias("class"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, num: int = 75, den: int = 100) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_shingles, component_id (smallest id reachable by links, its own included).

    Texts are lowered in A-Z and split at ASCII white space. Sets link at similarity ``num / den`` or more. A null, empty or
    blank text has no shingles and links with nothing, not even its like; fewer words than a shingle are one shingle. Rows
    without an id link like any other, and others through them; a group of such rows alone has a null component. Repeated
    rows share a component. Other columns are not read. Sets are compared through 64-bit hashes of their shingles, nodes are
    64-bit hashes of sets.
    """
    classed = classed_documents(docs, id_col, text_col, size, num, den)
    least = classed.filter("class IS NOT NULL").groupBy("class").agg(F.min("id").alias("least"))
    return classed.join(least, "class", "left").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                                                       F.coalesce("least", "id").alias("component_id"))


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, num: int = 75, den: int = 100) -> DataFrame:
    """One row of ``docs`` for every component, all columns unchanged; rows without words all stay.

    It is the row with the smallest id, one without an id only where no other has one; of several texts with that id the one with
    the smallest hash, of repeated rows any one. An id that stands on texts of different components stays once for each.
    """
    classed = stage_table(classed_documents(docs, id_col, text_col, size, num, den).filter("class IS NOT NULL"))
    first = F.struct(F.col("id").isNull().alias("lost"), "id", "mark")
    best = classed.groupBy("class").agg(F.min(first).alias("best"), F.count("*").alias("rows")).filter("rows > 1")
    dropped = classed.join(best, "class").select("id", "mark", (first == F.col("best")).alias("stays"))
    key, mark = fresh("id"), fresh("mark")
    both = F.col(id_col).eqNullSafe(F.col(key)) & (F.xxhash64(F.col(text_col)) == F.col(mark))
    gone = stage_table(dropped.filter("NOT stays").select(F.col("id").alias(key), F.col("mark").alias(mark)).distinct())
    gone = F.broadcast(gone) if gone.count() <= _BROADCAST else gone
    stays = docs.join(gone, both, "left_anti")
    twice = stage_table(dropped.filter("stays").groupBy(F.col("id").alias(key), F.col("mark").alias(mark)).count().filter("count > 1").drop("count"))
    if twice.isEmpty():
        return stays
    # a whole row repeated, id included: one of its copies stays
    return stays.join(twice, both, "left_anti").unionByName(stays.join(twice, both, "left_semi").dropDuplicates([id_col, text_col]))
