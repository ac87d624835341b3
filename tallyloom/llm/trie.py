"""A trie of conversations by time-forward processing.

Turns are numbered by distributed sorting, so no conversation is gathered. A prefix is named by 128 bits: the exclusive or of
hashes of its turns, each hashed with its place, which sums over blocks of a conversation in any order. Members, and the turns
below a node, are counts by prefix. A node with more than ``shard_rows`` turns below it is a *top* node; the first node of a path with no
more is a shard root, and all below it is its shard. Totals of subtrees go from children to parents: nodes are sorted
by reverse level order (Spark's external sort), a node takes the messages that wait for it from a priority queue that spills
sorted runs, adds its own numbers and sends the total on to its parent. First all shards are processed in parallel; what shard
roots send is summed by parent, and the top nodes are processed the same way.
"""

from __future__ import annotations

import hashlib
import heapq
import tempfile
from collections.abc import Iterator
from struct import calcsize, iter_unpack, pack

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_batches, stage_table, tidied
from .mixing import word_count

_HEAD = 32        # characters of a text or role in a splitter
_BLOCK = 4096     # turns of a conversation whose prefixes one window sums
_CHUNK = 1 << 16  # characters of joined ids that travel as one row
_WAITING = 200_000  # messages a queue holds in memory


# ---------------------------------------------------------------- turns and prefixes

def numbered_turns(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv, pos (from 1), h1, h2 (hashes of role and text), words; one row per row with a conversation."""
    text, role = (F.coalesce(F.col(c), F.lit("")) for c in (text_col, role_col))
    own = rows.filter(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
                                                          role.alias("role"), text.alias("text"))
    by = [F.col("conv"), F.col("turn").asc_nulls_first()]
    dealt = own.repartitionByRange(*by, F.substring("role", 1, _HEAD), F.substring("text", 1, _HEAD)).sortWithinPartitions(*by, "role", "text")
    # sorted rows in order: their number tells the place inside a partition, and a count per partition the rest
    held = stage_table(dealt.select("conv", F.xxhash64("role", "text").alias("h1"), F.xxhash64("text", F.lit(1), "role").alias("h2"),
                                    word_count(F.col("text")).alias("words"), F.spark_partition_id().alias("part"),
                                    F.monotonically_increasing_id().alias("row")))
    segments = held.groupBy("conv", "part").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = segments.select("conv", "part", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first") + 1).alias("shift"))
    return held.join(offsets, ["conv", "part"]).select("conv", (F.col("row") + F.col("shift")).alias("pos"), "h1", "h2", "words")


def share_heads(turns: DataFrame, heads: Column, family: int) -> tuple[DataFrame, DataFrame]:
    """Conversations c rebuilt: the first ``heads`` turns of conversation c - c % family, then those of c after its own first ``heads``.

    Gives the turns and, for every conversation, conv and length.
    """
    convs = turns.groupBy("conv").agg(F.max("pos").alias("n"))
    convs = convs.select("conv", "n", heads.cast("long").alias("h"), (F.col("conv") - F.col("conv") % family).alias("base"))
    sizes = convs.select(F.col("conv").alias("b"), F.col("n").alias("base_n"))
    convs = convs.join(sizes, F.col("base") == F.col("b"), "left").drop("b")
    head = F.least("h", F.coalesce("base_n", F.lit(0)))
    convs = stage_table(convs.select("conv", "base", "h", head.alias("head"), (head + F.greatest(F.lit(0), F.col("n") - F.col("h"))).alias("length")))
    first = turns.join(convs.select(F.col("conv").alias("to"), "base", "head"), F.col("conv") == F.col("base")).filter("pos <= head")
    rest = turns.join(convs.select(F.col("conv").alias("c"), "h", "head"), F.col("conv") == F.col("c")).filter("pos > h")
    out = first.select(F.col("to").alias("conv"), "pos", "h1", "h2", "words").union(
        rest.select("conv", (F.col("head") + F.col("pos") - F.col("h")).alias("pos"), "h1", "h2", "words"))
    return out, convs.select("conv", "length")


def prefixes(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """conv, pos, length, words, p1, p2 (the prefix that ends here), up1, up2 (the one before) for every turn."""
    own = turns.join(lengths, "conv").select(
        "conv", "pos", "length", "words", F.xxhash64("pos", "h1", "h2").alias("e1"), F.xxhash64("h2", "pos", "h1", F.lit(1)).alias("e2"),
        F.expr(f"(pos - 1) div {_BLOCK}").alias("block"))
    inside = Window.partitionBy("conv", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    own = stage_table(own.withColumns({"p1": F.bit_xor("e1").over(inside), "p2": F.bit_xor("e2").over(inside)}))
    # only conversations longer than a block have anything to carry
    blocks = own.filter(f"length > {_BLOCK}").groupBy("conv", "block").agg(F.bit_xor("e1").alias("x1"), F.bit_xor("e2").alias("x2"))
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select("conv", "block", *[F.bit_xor(x).over(earlier).alias(x) for x in ("x1", "x2")])
    own = own.join(carried, ["conv", "block"], "left")
    full = {p: F.col(p).bitwiseXOR(F.coalesce(x, F.lit(0))) for p, x in (("p1", "x1"), ("p2", "x2"))}
    own = own.withColumns(full)
    return own.select("conv", "pos", "length", "words", "p1", "p2", F.col("p1").bitwiseXOR(F.col("e1")).alias("up1"),
                      F.col("p2").bitwiseXOR(F.col("e2")).alias("up2"))


# ---------------------------------------------------------------- time-forward processing

class SpillingQueue:
    """A priority queue of messages (three numbers of a key, two totals) in bounded memory.

    What exceeds ``most`` messages goes to a sorted run in a file of the task, which the system removes with the task; runs
    are merged as they are read. Keys only grow: nothing is put before what was taken.
    """

    _ROW = "<5q"

    def __init__(self, most: int = _WAITING):
        self.most, self.heap, self.runs, self.spilled = most, [], [], 0

    def put(self, message: tuple[int, ...]) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) >= self.most:
            file = tempfile.TemporaryFile()
            file.writelines(pack(self._ROW, *m) for m in sorted(self.heap))
            file.seek(0)
            run = self._read(file)
            heapq.heappush(self.runs, (next(run), self.spilled, run))
            self.heap, self.spilled = [], self.spilled + 1

    def _read(self, file) -> Iterator[tuple[int, ...]]:
        with file:
            while block := file.read(calcsize(self._ROW) * 1024):
                yield from iter_unpack(self._ROW, block)

    def take(self, key: tuple[int, ...]) -> Iterator[tuple[int, ...]]:
        """Removes and gives all messages with this key."""
        width = len(key)
        while self.heap and self.heap[0][:width] == key:
            yield heapq.heappop(self.heap)
        while self.runs and self.runs[0][0][:width] == key:
            message, number, run = self.runs[0]
            following = next(run, None)
            if following is None:
                heapq.heappop(self.runs)
            else:
                heapq.heapreplace(self.runs, (following, number, run))
            yield message


_TOTALS = pa.schema([("depth", pa.int64()), ("p1", pa.int64()), ("p2", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
                     ("saved_tokens", pa.int64())])
_TOTALS_SQL = "depth long, p1 long, p2 long, n_children long, n_leaves long, saved_tokens long"


def _time_forward(most: int):
    """Totals of the subtrees of nodes that come in reverse level order (depth falling, then prefix).

    A node has depth, p1, p2, its parent's up1, up2, own tokens, what came from elsewhere (children, leaves, saved), and ``out``:
    its parent is not among these nodes.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = SpillingQueue(most)

        def rows():
            for batch in batches:
                columns = [batch.column(c).to_pylist() for c in ("depth", "p1", "p2", "up1", "up2", "own", "children", "leaves", "saved", "out")]
                for depth, p1, p2, up1, up2, own, children, leaves, saved, out in zip(*columns):
                    saved += own
                    for *_, more_leaves, more_saved in waiting.take((-depth, p1, p2)):
                        children, leaves, saved = children + 1, leaves + more_leaves, saved + more_saved
                    leaves = leaves if children else 1
                    if not out:
                        waiting.put((1 - depth, up1, up2, leaves, saved))
                    yield depth, p1, p2, children, leaves, saved
        yield from arrow_batches(rows(), _TOTALS)
    return run


def _reverse_level(nodes: DataFrame) -> DataFrame:
    return nodes.select("depth", "p1", "p2", "up1", "up2", "own", "children", "leaves", "saved", "out")


def subtree_totals(nodes: DataFrame, paths: DataFrame, shard_rows: int, waiting: int = _WAITING) -> DataFrame:
    """depth, p1, p2, n_children, n_leaves, saved_tokens for ``nodes`` (depth, p1, p2, up1, up2, conv, below, own).

    ``below`` counts the turns at and under a node, ``conv`` is a member, and ``paths`` gives conv, pos, p1, p2 of all turns.
    """
    key = ["depth", "p1", "p2"]
    top = stage_table(nodes.filter(F.col("below") > shard_rows))
    # the deepest top node on each path; the next one is the root of the shard that holds the rest of the path
    met = paths.join(top.select(F.col("depth").alias("pos"), "p1", "p2"), ["pos", "p1", "p2"])
    deepest = stage_table(met.groupBy("conv").agg(F.max("pos").alias("over")))
    over = F.coalesce("over", F.lit(0) if not top.filter("depth = 0").isEmpty() else F.lit(-1))
    roots = paths.join(deepest, "conv", "left").filter(F.col("pos") == over + 1).select("conv", F.col("p1").alias("s1"), F.col("p2").alias("s2"), "pos")
    low = nodes.filter(F.col("below") <= shard_rows).join(roots.select("conv", "s1", "s2", F.col("pos").alias("root")), "conv", "left")
    blank = {c: F.lit(0).cast("long") for c in ("children", "leaves", "saved")}
    # without top nodes the whole trie is one shard, and its root the only node without a parent
    root = F.coalesce("root", F.lit(0))
    shards = low.withColumns(blank).withColumn("out", F.col("depth") == root).repartition("root", "s1", "s2")
    order = [F.col("depth").desc(), "p1", "p2"]
    inner = stage_table(_reverse_level(shards.sortWithinPartitions(*order)).mapInArrow(tidied(_time_forward(waiting)), _TOTALS_SQL))
    tops = low.filter(F.col("depth") == root).select(*key, "up1", "up2").filter("depth > 0").join(inner, key)
    sent = tops.groupBy((F.col("depth") - 1).alias("depth"), F.col("up1").alias("p1"), F.col("up2").alias("p2")).agg(
        F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    high = top.join(sent, key, "left").withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in blank}).withColumn("out", F.col("depth") == 0)
    outer = _reverse_level(high.repartition(1).sortWithinPartitions(*order)).mapInArrow(tidied(_time_forward(waiting)), _TOTALS_SQL)
    return inner.unionByName(outer)


# ---------------------------------------------------------------- the ends of conversations

_ENDS = pa.schema([("depth", pa.int64()), ("p1", pa.int64()), ("p2", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of (depth, p1, p2, conv) as rows with the ids of a node joined, some 64K characters each."""
    def rows():
        key, first, held, size = None, None, [], 0
        for batch in batches:
            for *now, conv in zip(*(batch.column(c).to_pylist() for c in ("depth", "p1", "p2", "conv"))):
                if held and (now != key or size >= _CHUNK):
                    yield *key, first, ",".join(held)
                    held, size = [], 0
                if not held:
                    key, first = now, conv
                held.append(str(conv))
                size += len(held[-1]) + 1
        if held:
            yield *key, first, ",".join(held)
    yield from arrow_batches(rows(), _ENDS, weight=lambda r: len(r[4]))


_SHA = pa.schema([("depth", pa.int64()), ("p1", pa.int64()), ("p2", pa.int64()), ("ends_sha256", pa.string())])


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        key = digest = None
        for batch in batches:
            for *now, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "p1", "p2", "ids"))):
                if now != key:
                    if digest:
                        yield *key, digest.hexdigest()
                    key, digest = now, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
        if digest:
            yield *key, digest.hexdigest()
    yield from arrow_batches(rows(), _SHA)


def ends_digests(ends: DataFrame) -> DataFrame:
    """depth, p1, p2, ends_sha256 for the nodes at which conversations (depth, p1, p2, conv) end."""
    order = ["depth", "p1", "p2", "conv"]
    dealt = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    chunks = dealt.mapInArrow(tidied(_joined), "depth long, p1 long, p2 long, first long, ids string")
    together = chunks.repartition("depth", "p1", "p2").sortWithinPartitions("depth", "p1", "p2", "first")
    return together.mapInArrow(tidied(_digested), "depth long, p1 long, p2 long, ends_sha256 string")


# ---------------------------------------------------------------- the trie

def prefix_trie(turns: DataFrame, lengths: DataFrame, shard_rows: int | None = None, waiting: int = _WAITING) -> DataFrame:
    """One row per node of the trie of conversations: conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    ``turns`` has conv, pos (from 1), h1, h2, words, and ``lengths`` conv and length, also of conversations without turns, which
    end at the root. saved_tokens sums, over a subtree, the words of a node's last turn times the members beyond the first.
    ``shard_rows`` bounds the turns of a shard; left out, it is a 4096th of all turns, 1000 at least. A single conversation
    longer than that is a path of top nodes, which one task streams. An empty table gives no rows.
    """
    paths = stage_table(prefixes(turns, lengths))
    if shard_rows is None:
        shard_rows = max(1000, paths.count() // 4096)
    key = ["depth", "p1", "p2"]
    nodes = paths.groupBy(F.col("pos").alias("depth"), "p1", "p2").agg(
        F.min("up1").alias("up1"), F.min("up2").alias("up2"), F.min("conv").alias("conv"), F.count("*").alias("n_convs"),
        F.sum(F.col("length") - F.col("pos") + 1).alias("below"), F.max("words").alias("words"))
    root = lengths.agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.sum("length").alias("below")).filter("n_convs > 0")
    zero = F.lit(0).cast("long")
    root = root.select(zero.alias("depth"), zero.alias("p1"), zero.alias("p2"), zero.alias("up1"), zero.alias("up2"), "conv", "n_convs",
                       F.coalesce("below", zero).alias("below"), zero.alias("words"))
    nodes = stage_table(nodes.select(root.columns).unionByName(root).withColumn("own", (F.col("n_convs") - 1) * F.col("words")))

    totals = subtree_totals(nodes, paths.select("conv", "pos", "p1", "p2"), shard_rows, waiting)
    ends = paths.filter("pos = length").select(F.col("pos").alias("depth"), "p1", "p2", "conv").unionByName(
        lengths.filter("length = 0").select(zero.alias("depth"), zero.alias("p1"), zero.alias("p2"), "conv"))
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("up1"), F.col("p2").alias("up2"), F.col("conv").alias("parent_conv_id"))
    out = nodes.join(totals, key).join(ends_digests(ends), key, "left")
    out = out.join(above, ["depth", "up1", "up2"], "left")
    return out.select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs",
        "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def conversation_trie(rows: DataFrame, heads: Column | None = None, family: int = 20, conv_col: str = "conv_id", turn_col: str = "turn",
                      role_col: str = "role", text_col: str = "text", shard_rows: int | None = None, waiting: int = _WAITING) -> DataFrame:
    """The prefix trie (see prefix_trie) of a table of turns; a conversation id is a whole number.

    Turns are ordered by ``turn_col``, nulls first, then role and text; a null role or text is empty, repeated rows are turns of
    their own. Rows without a conversation id belong to no conversation. With ``heads`` (a column over ``conv``) conversations
    are rebuilt first, see share_heads. Other columns are not read. An empty table gives no rows.
    """
    turns = stage_table(numbered_turns(rows, conv_col, turn_col, role_col, text_col))
    if heads is None:
        lengths = turns.groupBy("conv").agg(F.max("pos").alias("length"))
    else:
        turns, lengths = share_heads(turns, heads, family)
    return prefix_trie(turns, stage_table(lengths), shard_rows, waiting)
