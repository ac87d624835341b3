"""Mixing sources to target weights, by DataFrame operations alone.

Each document gets a hash-random key. Per source, documents are ordered by that key; distributed prefix sums of sizes (range
partitions by sampled splitters, one total per partition and source, a window over those totals) find the partition in which
a source's budget ends, and only those partitions are summed row by row. The outcome is one *cut* per source: whole epochs, and
the key up to which one more epoch goes. Whether and how often a document is taken then follows from its own key and the cut
of its source, so documents are never ranked against each other again and a hot source is spread over all partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, prefix_sums, stage_table

_KEY = ("_k", "_id")


def word_count(text: Column) -> Column:
    """Number of words of a text; none in a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix_key(doc_id: Column, seed: str) -> Column:
    """Hash-random key of a document, the same in every run."""
    return F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 16)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """source, source_size, target for a table of ``_source`` and ``_size``.

    Sources in code point order, null last, weigh ``weights`` in turn and share ``share`` of all sizes; no target exceeds
    ``most`` times its source. That is a water level: sources in order of ``most * size / weight`` are full as long as the
    level that the rest would have reaches that ratio, and the level of the first one above is the level of all others.
    """
    per = sizes.groupBy("_source").agg(F.sum("_size").alias("source_size"))
    ranked = prefix_sums(per, [F.col("_source").asc_nulls_last()], {"_rank": F.lit(1)})
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    cut = ranked.withColumn("_w", turn).withColumn("_cap", most * F.col("source_size"))
    order = [F.col("_cap") / F.col("_w"), F.col("_source").asc_nulls_last()]
    filled = prefix_sums(cut, order, {"_caps": F.col("_cap"), "_ws": F.col("_w")})
    whole = cut.agg(F.sum("source_size").alias("size"), F.sum("_w").alias("w")).first()
    level = (F.lit(share * (whole["size"] or 0)) - F.col("_caps")) / (F.lit(whole["w"] or 0) - F.col("_ws"))
    levels = stage_table(filled.withColumn("_level", level))
    full = F.col("_cap") / F.col("_w") <= F.col("_level")
    rest = levels.filter(~full).agg(F.max("_level").alias("rest")).first()["rest"]
    return levels.select("_source", "source_size", F.when(full, F.col("_cap").cast("double")).otherwise(
        F.col("_w") * F.lit(rest).cast("double")).alias("target"))


def mix_cuts(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: source_size, target, epochs (whole passes), and _cut_k, _cut_id, _cut_words: the document of one more pass
    at which the budget ends and the words taken of it (null where whole passes meet the budget)."""
    budget = (targets.withColumn("_epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
              .withColumn("_left", (F.floor("target") - F.col("_epochs") * F.col("source_size")).cast("long")))
    dealt = stage_table(sizes.repartitionByRange(F.col("_source").asc_nulls_last(), *_KEY).withColumn("_part", F.spark_partition_id()))
    parts = dealt.groupBy("_source", "_part").agg(F.sum("_size").alias("_sum"))
    before = Window.partitionBy("_source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_offset", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    ends = (parts.join(budget.select(F.col("_source").alias("_s"), "_left"), F.col("_source").eqNullSafe(F.col("_s")))
            .filter("_left > 0 AND _offset < _left AND _left <= _offset + _sum").select("_s", F.col("_part").alias("_p"), "_offset", "_left"))
    # equal keys are in one partition: rows repeated with one id are one unit
    inside = dealt.join(ends, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_part") == F.col("_p")))
    units = inside.groupBy("_s", "_part", "_offset", "_left", *_KEY).agg(F.sum("_size").alias("_unit"), F.count("*").alias("_rows"))
    running = Window.partitionBy("_s", "_part").orderBy(*_KEY).rowsBetween(Window.unboundedPreceding, -1)
    at = units.withColumn("_taken", F.col("_offset") + F.coalesce(F.sum("_unit").over(running), F.lit(0)))
    at = at.filter("_taken < _left AND _left <= _taken + _unit").select(
        "_s", F.col("_k").alias("_cut_k"), F.col("_id").alias("_cut_id"), F.expr("(_left - _taken) div _rows").alias("_cut_words"))
    return budget.join(at, F.col("_source").eqNullSafe(F.col("_s")), "left").drop("_s", "_left")


def _words_taken(size: Column) -> Column:
    """Words of the extra pass: all before the cut, some at it."""
    key, own = F.col("_k"), F.col("_id")
    cut_id = F.col("_cut_id")
    before = (key < F.col("_cut_k")) | ((key == F.col("_cut_k")) & F.coalesce(own < cut_id, own.isNull() & cut_id.isNotNull()))
    at = (key == F.col("_cut_k")) & own.eqNullSafe(cut_id)
    return F.when(F.col("_cut_k").isNull(), F.lit(0)).when(before, size).when(at, F.least(size, F.col("_cut_words"))).otherwise(0).cast("long")


def _measured(docs: DataFrame, id_col: str, source_col: str, text_col: str, seed: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), word_count(F.col(text_col)).alias("_size"),
                       mix_key(F.col(id_col), seed).alias("_k"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2, seed: str = "mix") -> DataFrame:
    """One row per document: ``id_col``, size, source_size, target (of its source), taken (words, repeats counted).

    A null text has no words; null is a source of its own, the last; a null id sorts before any other of its key. The taken
    words of a source add up to its target rounded down, except that rows with one and the same id share the cut evenly.
    Other columns are not read. An empty table gives no rows.
    """
    sizes = stage_table(_measured(docs, id_col, source_col, text_col, seed))
    cuts = stage_table(mix_cuts(sizes, source_targets(sizes, weights, share, most))).withColumnRenamed("_source", "_s")
    joined = sizes.join(cuts, F.col("_source").eqNullSafe(F.col("_s")))
    taken = F.col("_epochs") * F.col("_size") + _words_taken(F.col("_size"))
    return joined.select(F.col("_id").alias(id_col), F.col("_size").alias("size"), "source_size", "target", taken.cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                    weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2, seed: str = "mix",
                    chars_col: str | None = None) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as they are taken, all columns kept.

    The document at a source's cut comes once more with its text ended after the words still due, white space before the
    next word included (and its length in ``chars_col``, where given). Documents without words are taken in whole passes alone.
    """
    columns = docs.columns
    sizes = stage_table(_measured(docs, id_col, source_col, text_col, seed))
    cuts = stage_table(mix_cuts(sizes, source_targets(sizes, weights, share, most))).withColumnRenamed("_source", "_s")
    own = docs.select(F.struct(*columns).alias("_row"), F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), F.col(text_col).alias("_text"),
                      mix_key(F.col(id_col), seed).alias("_k"), word_count(F.col(text_col)).alias("_size"))
    own = own.join(cuts, F.col("_source").eqNullSafe(F.col("_s"))).withColumn("_extra", _words_taken(F.col("_size")))
    once_more = F.when(F.col("_extra") > 0, F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>"))
    own = own.withColumn("_last", F.explode(F.concat(F.array_repeat(F.lit(False), F.col("_epochs").cast("int")), once_more)))
    parts = F.split("_text", r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    lead = F.col("_text").rlike(r"\A[\x20\x09-\x0D]").cast("int")
    ended = F.array_join(F.slice(parts, 1, F.col("_extra").cast("int") + lead), "")
    cut = F.col("_last") & (F.col("_extra") < F.col("_size"))
    own = own.withColumn("_text", F.when(cut, ended).otherwise(F.col("_text")))
    out = {text_col: F.col("_text")}
    if chars_col:
        out[chars_col] = F.when(cut, F.length("_text")).otherwise(F.col("_row")[chars_col]).cast(docs.schema[chars_col].dataType)
    return own.select(*[out.get(c, F.col("_row")[c]).alias(c) for c in columns])
