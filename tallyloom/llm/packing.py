"""Vector best-fit packing of token pieces into sequences.

A piece asks for a vector: its tokens, one document, and attention cost (the square of its tokens). All three follow from its
length, so pieces of one length are the same item, and the whole packing is decided on the histogram of lengths: at most
``max_tokens`` rows, whatever the corpus holds. The planner takes lengths from the longest; among open bins that hold the piece
under *every* capacity it takes the one with the smallest weighted norm of what would remain, or the largest weighted dot product
of demand and residual. Bins with equal residuals are a range of numbers and move together. A range that a length has filled
keeps less than half its residual, so a length causes few steps: the plan is bounded by ``max_tokens * log2(max_tokens)`` rows.
Spark then numbers pieces inside each length and looks each number up in the plan.
"""

from __future__ import annotations

import os
import re
import struct
import sys
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain
from types import ModuleType

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_batches, stage_table, texts_of, tidied

END = 1            # id after each document
_CACHE = 480_000   # words a worker remembers
_BUCKET = 50_000   # pieces of one length that one task numbers

PLAN = "length int, first long, last long, bin long, copies long, place long"


# The pre-tokenizer always parts ASCII punctuation, but for apostrophes, from one of a few sure letters before it: so may a space where
# a word ends in it, and a word with and without a full stop is one word to look up.
_MARK = b"[" + re.escape(bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum() and b != 0x27)) + b"]"
_TAIL = re.compile(_MARK + rb"(?:(?<=[a-z].)|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf].)|(?<=\xc4[\x80-\xaf\xb1-\xbf].)|(?<=[\xc5-\xc9][\x80-\xbf].))"
                   + _MARK + rb"*(?=\s|\Z)")


# A word of letters alone whose lower case and normal form are one character each.
_LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")


# All bytes but those that begin a character from U+0300 on.
_PLAIN = bytes(range(0xCC))


class _WordIds:
    """Token ids of words as little-endian unsigned 32-bit bytes.

    The pre-tokenizer never joins characters across white space, so a text's ids are those of its words in order. Letters are
    lowered after they are composed: A-Z may be lowered first, which makes fewer words, where nothing can compose with them, and that
    is in words without combining marks or anything else from U+0300 on. The first text of a worker is checked against
    its whole encoding; with another kind of tokenizer file all texts are encoded whole. Added tokens are found before
    letters are lowered, so a text that holds one, in whatever case, is encoded whole; so is every text if an added token is
    looked for in normal forms.
    """

    @classmethod
    def of_worker(cls, path: str) -> "_WordIds":
        """The one of this worker process, which tasks share one after another; a worker runs one task at a time."""
        kept = sys.modules.setdefault("_words_of_worker", ModuleType("_words_of_worker")).__dict__
        if path not in kept:
            kept[path] = cls(path)
        # the words learned are plain data and live on; the code is that of this task
        kept[path].__class__ = cls
        return kept[path]

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer, self.known, self.old, self.checked, self.apart = Tokenizer.from_file(path), {}, {}, False, True
        self.added = [b"" if t.normalized else t.content.encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        suffix, vocabulary = getattr(self.tokenizer.model, "end_of_word_suffix", None), self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values(), default=0) + 1, bool)  # ids that end a word
        if suffix:
            self.last[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def split(self, text: str) -> list[bytes] | None:
        """The words of a text, lowered where that changes nothing; None if it is to be encoded whole."""
        raw = text.encode()
        lowered = raw.lower()
        if not self.apart or any(token in lowered for token in self.added):
            return None
        if not raw.translate(None, _PLAIN):
            return _TAIL.sub(rb" \g<0>", lowered).split()
        return [w if w.translate(None, _PLAIN) else w.lower() for w in _TAIL.sub(rb" \g<0>", raw).split()]

    def encoded(self, texts: list[str]) -> list[bytes]:
        return [_bytes(got.ids) for got in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def spelled(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of letters alone, encoded as one text and parted where a token ends a word."""
        ids = np.frombuffer(self.encoded([b" ".join(words).decode()])[0], "<u4")
        ends = ((np.flatnonzero(self.last[ids]) + 1) * 4).tolist()
        if len(ends) != len(words) or ends[-1:] != [4 * len(ids)]:
            return self.encoded([w.decode() for w in words])
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        """The ids of each of ``words``, among others; two generations of half the cache each, as in Remembered."""
        new = words.difference(self.known)
        if len(self.known) + len(new) > _CACHE // 2:
            self.old, self.known = self.known, {}
            new = words
        known, old = self.known, self.old
        unseen = new.difference(old)
        again = new - unseen
        known.update(zip(again, map(old.__getitem__, again)))
        plain, other = [], []
        for w in unseen:
            (plain if w.isalpha() or _LETTERS.fullmatch(w) else other).append(w)
        for part_of, ids_of in ((plain, self.spelled), (other, lambda part: self.encoded([w.decode() for w in part]))):
            for start in range(0, len(part_of), 8192):
                part = part_of[start:start + 8192]
                known.update(zip(part, ids_of(part)))
        return known

    def ids(self, text: str, words: list[bytes] | None, known: dict[bytes, bytes]) -> bytes:
        if words is None or not self.apart:
            return _bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)
        out = b"".join(map(known.__getitem__, words))
        if not self.checked and words:
            self.checked = True
            if _bytes(self.tokenizer.encode(text, add_special_tokens=False).ids) != out:
                self.apart = False
                return self.ids(text, None, known)
        return out


def _bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _groups(documents: Iterable[tuple], most: int = 4 << 20) -> Iterator[list[tuple]]:
    """(id, text) pairs in lists of some four million characters, whose words are looked up together."""
    held, size = [], 0
    for key, text in documents:
        held.append((key, text))
        size += len(text)
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def token_pieces(docs: DataFrame, tokenizer_path: str, max_tokens: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, piece, start, length, ids (little-endian unsigned 32-bit) of every document, cut where it is longer.

    A null text is empty and has the end id alone. Repeated rows are pieces of their own. Other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        schema = pa.schema([("id", first.schema.field("id").type), ("piece", pa.int32()), ("start", pa.int64()),
                            ("length", pa.int64()), ("ids", pa.binary())])
        words_ids = _WordIds.of_worker(tokenizer_path)
        end, step = np.array([END], "<u4").tobytes(), 4 * max_tokens
        documents = ((key, text) for batch in chain([first], batches) for key, text in zip(batch.column("id").to_pylist(), texts_of(batch)))

        def rows():
            for group in _groups(documents):
                split = [words_ids.split(text) for _, text in group]
                known = words_ids.learn(set().union(*filter(None, split)))
                for (key, text), words in zip(group, split):
                    ids = words_ids.ids(text, words, known) + end
                    for k, at in enumerate(range(0, len(ids), step)):
                        part = ids[at:at + step]
                        yield key, k, at // 4, len(part) // 4, part
        yield from arrow_batches(rows(), schema, weight=lambda r: len(r[4]))

    read = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return read.mapInArrow(tidied(cut), f"id {kind}, piece int, start long, length long, ids binary").withColumnRenamed("id", id_col)


def plan_bins(histogram: list[tuple[int, int]], max_tokens: int = 4096, max_documents: int = 4096, max_attention: int = 4096 * 4096,
              weights: tuple[float, float, float] = (1.0, 0.001, 0.001), rule: str = "norm") -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first, last, bin, copies, place): pieces of a length numbered first to last-1 go ``copies`` to a bin, in
    bins counted from ``bin``, the first of each at token ``place``.

    ``histogram`` holds (length, count). A length that no empty bin can hold is an error.
    """
    capacity = np.array([max_tokens, max_documents, max_attention], float)
    weight = np.array(weights) / np.array([1.0, 1.0, 1.0])
    left = np.empty((0, 3))                      # residual of each range of open bins
    bins = np.empty((0, 2), dtype=np.int64)      # its first bin, and how many
    plan, opened = [], 0
    for length, count in sorted(histogram, reverse=True):
        if count <= 0:
            continue
        need = np.array([length, 1, length * length], float)
        if (need > capacity).any() or length < 1:
            raise ValueError(f"no sequence holds a piece of {length} tokens")
        open_ = left.min(axis=1) > 0 if len(left) else np.zeros(0, bool)
        left, bins = left[open_], bins[open_]
        first = 0
        while first < count:
            rest = count - first
            fits = np.flatnonzero((left >= need).all(axis=1)) if len(left) else []
            if len(fits):
                if rule == "norm":
                    score = ((((left[fits] - need) / capacity) ** 2) * weight).sum(axis=1)
                else:
                    score = -((left[fits] / capacity) * (need / capacity) * weight).sum(axis=1)
                at = int(fits[np.argmin(score)])
                room, (start, many) = left[at].copy(), bins[at]
            else:
                at, room, start, many = None, capacity.copy(), opened, rest
            copies = int(min(room // need))
            if copies <= rest:
                used = int(min(many, rest // copies))
            else:
                copies, used = rest, 1
            plan.append((length, first, first + used * copies, int(start), copies, int(max_tokens - room[0])))
            first += used * copies
            if at is None:
                opened += used
            elif used < many:
                bins[at] = start + used, many - used
            else:
                left, bins = np.delete(left, at, 0), np.delete(bins, at, 0)
            left = np.vstack([left, room - copies * need])
            bins = np.vstack([bins, np.array([[start, used]], dtype=np.int64)])
    return plan


def place_pieces(pieces: DataFrame, max_tokens: int = 4096, max_documents: int = 4096, max_attention: int = 4096 * 4096,
                 weights: tuple[float, float, float] = (1.0, 0.001, 0.001), rule: str = "norm", id_col: str = "doc_id") -> DataFrame:
    """``pieces`` (a staged table with ``id_col``, piece, length) with sequence_id and offset.

    Every piece gets a place, repeated rows too; an empty table stays empty. Lengths lie in 1 to ``max_tokens``.
    """
    spark: SparkSession = pieces.sparkSession
    counts = pieces.groupBy("length").count().collect()  # at most max_tokens rows
    plan = plan_bins([(r["length"], r["count"]) for r in counts], max_tokens, max_documents, max_attention, weights, rule)
    shares = spark.createDataFrame([(r["length"], -(-r["count"] // _BUCKET)) for r in counts], "length long, _shares long")
    columns = pieces.columns
    dealt = pieces.join(F.broadcast(shares), "length").withColumn("_share", F.pmod(F.xxhash64(id_col, "piece"), "_shares"))
    sizes = dealt.groupBy("length", "_share").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_share").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "_share", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_share").orderBy(id_col, "piece")
    ranked = dealt.withColumn("_number", F.row_number().over(inside)).join(offsets, ["length", "_share"])
    ranked = ranked.withColumn("_number", F.col("_number") + F.col("_before") - 1)
    table = spark.createDataFrame(pd.DataFrame(plan, columns=["_len", "_first", "_last", "_bin", "_copies", "_place"], dtype="int64"),
                                  "_len long, _first long, _last long, _bin long, _copies long, _place long")
    found = ranked.join(F.broadcast(table), F.expr("length = _len AND _number >= _first AND _number < _last"))
    return found.select(*columns, F.expr("_bin + (_number - _first) div _copies").alias("sequence_id"),
                        F.expr("_place + (_number - _first) % _copies * length").alias("offset"))


def packed_sequences(pieces: DataFrame, placed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """sequence_id, ids: the packed sequences themselves, from token_pieces and the placement of its rows.

    ``placed`` holds one row per ``id_col`` and piece. A sequence holds at most ``max_tokens`` ids, so its group is bounded.
    """
    with_ids = placed.select(id_col, "piece", "sequence_id", "offset").join(pieces.select(id_col, "piece", "ids"), [id_col, "piece"])
    parts = with_ids.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("h")))).alias("p"))
    return parts.select("sequence_id", F.unhex(F.array_join(F.col("p.h"), "")).alias("ids"))


def pack_documents(docs: DataFrame, tokenizer_path: str, max_tokens: int = 4096, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """Per piece: ``id_col``, piece, start, length, ids_crc32, sequence_id, offset. See token_pieces and place_pieces."""
    pieces = token_pieces(docs, tokenizer_path, max_tokens, id_col, text_col)
    # the ids themselves are not staged: their checksum, computed as they leave the tokenizer, is
    narrow = stage_table(pieces.select(id_col, "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))
    return place_pieces(narrow, max_tokens, id_col=id_col, **limits)


def crc32(ids: Iterable[int]) -> int:
    """Checksum of ids as pack_documents gives it."""
    return zlib.crc32(np.array(list(ids), "<u4").tobytes())
