"""Response behaviour, disposition, response wave and removal of double responses."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import any_of, filter_out, join_null_safe
from .ordered import number_rows
from .ranking import earliest, slice_best

# Disposition codes that field work decides and answers that carry no substance.
FIELDWORK_FINAL = ["late", "deceased", "incapble", "language", "wrongrsp", "unreach"]
NON_SUBSTANTIAL = ["dkn", "invalid"]
FULL, PARTIAL = 0.8, 0.3


@dataclass(frozen=True)
class Question:
    """A question with its share of the questionnaire and the question after it."""

    concept_id: str
    pct: float
    following: str | None


def question_progress(variables: DataFrame, questions: DataFrame, by: Sequence[str] = (), pos: str = "pos") -> DataFrame:
    """Per question: the share of the questionnaire done after it, and the next question.

    Variables without module and free-text fields do not count.
    """
    joined = join_null_safe(variables, questions.select("concept_id", "question_module"), ["concept_id"])
    kept = filter_out(filter_out(joined, F.col("question_module").isNull()), F.col("concept_id").rlike("_text$"))
    ranked = number_rows(kept.select(*by, pos, "concept_id"), pos, by, "__rank", "__n", {"resp_drop": "concept_id"})
    pct = F.bround(F.col("__rank").cast("double") / F.col("__n").cast("double"), 3)
    return ranked.select(*by, "concept_id", pct.alias("resp_pct"), "resp_drop")


def question_list(progress: DataFrame) -> list[Question]:
    """The questionnaire of one edition, for building expressions (one entry per data column)."""
    rows = progress.select("concept_id", "resp_pct", "resp_drop").collect()
    return sorted((Question(r[0], r[1], r[2]) for r in rows), key=lambda q: q.pct)


def behaviour(column: Column) -> Column:
    """no respons, nonsubstantial or respons."""
    text = F.coalesce(column.cast("string"), F.lit(""))
    return F.when(text == "", "no respons").when(text.isin(NON_SUBSTANTIAL), "nonsubstantial").otherwise("respons")


def answer_behaviour(df: DataFrame, row_key: str, questions: Sequence[str]) -> DataFrame:
    """Long form: one row per response and question with its behaviour."""
    wide = df.select(row_key, *[behaviour(F.col(q)).alias(q) for q in questions])
    return wide.unpivot([row_key], list(questions), "concept_id", "behavior")


def response_rates(long: DataFrame, row_key: str, demographics: Sequence[str]) -> DataFrame:
    """From the long form: all demographic questions answered, and the share of substantive answers."""
    given = F.col("behavior") == "respons"
    return long.groupBy(row_key).agg(
        reduce(and_, [F.bool_or((F.col("concept_id") == d) & given) for d in demographics]).alias("resp_demo"),
        (F.count_if(given) / F.count(F.lit(1))).alias("resp_share"))


def drop_out(long: DataFrame, progress: DataFrame, row_key: str) -> DataFrame:
    """From the long form: how far a response came and the next question (ties on the share are kept)."""
    seen = long.where(F.col("behavior").isin("respons", "nonsubstantial"))
    return slice_best(join_null_safe(seen, progress, ["concept_id"]), [row_key], [F.col("resp_pct")]).select(
        row_key, "resp_pct", "resp_drop")


def response_profile(df: DataFrame, questions: Sequence[Question], demographics: Sequence[str]) -> DataFrame:
    """The same three results as expressions over the columns of one row: no unpivot, no shuffle.

    Adds ``resp_demo``, ``resp_share`` (both NULL without any answer), ``resp_pct`` and ``resp_drop``.
    Questionnaires so long that rounding gives two questions one share yield one row per tie.
    """
    kind = {q.concept_id: behaviour(F.col(q.concept_id)) for q in questions}
    # flags in a projection of their own, so that a behaviour is computed once and not inside every rule
    flags = {f"__seen_{q}": k != "no respons" for q, k in kind.items()} | {f"__given_{q}": k == "respons" for q, k in kind.items()}
    seen, given = ({q: F.col(f"`__{name}_{q}`") for q in kind} for name in ("seen", "given"))
    any_seen = any_of(seen.values())
    share = reduce(add, [g.cast("int") for g in given.values()]).cast("double") / F.lit(float(len(questions)))
    demo = reduce(and_, [given.get(d, F.lit(False)) for d in demographics])
    shares = [q.pct for q in questions]
    last, following = F, F
    for q in reversed(questions):
        last = last.when(seen[q.concept_id], F.lit(q.pct))
        following = following.when(seen[q.concept_id], F.lit(q.following).cast("string"))
    out = df.withColumns(flags).withColumns({
        "resp_demo": F.when(any_seen, demo),
        "resp_share": F.when(any_seen, share),
        "resp_pct": last,
    })
    if len(set(shares)) == len(shares):
        return out.withColumn("resp_drop", following).drop(*flags)
    ties = F.array_compact(F.array(*[
        F.when(seen[q.concept_id] & (F.col("resp_pct") == q.pct), F.struct(F.lit(q.following).cast("string").alias("v")))
        for q in questions]))
    return out.withColumn("__tie", F.explode_outer(ties)).withColumn("resp_drop", F.col("__tie.v")).drop("__tie", *flags)


def disposition(df: DataFrame) -> DataFrame:
    """Final disposition: field work decides first, then completeness; adds ``resp_disp``."""
    pct = F.coalesce(F.col("resp_pct"), F.lit(0.0))
    code = (F.when(F.col("resp_fwdisp").isin(FIELDWORK_FINAL), F.col("resp_fwdisp"))
            .when(F.col("resp_demo") & (F.col("resp_share") >= FULL), "full")
            .when(F.col("resp_demo") & (F.col("resp_share") >= PARTIAL), "partial")
            .when(~F.col("resp_demo") & (pct > 0), "wrongrsp")
            .when(pct > 0, "breakoff")
            .when(pct == 0, "refusal"))
    return df.withColumns({"resp_pct": pct, "resp_disp": code})


def status(df: DataFrame) -> DataFrame:
    """resp for full and partial answers, nonresp for everything else, also unknown."""
    return df.withColumn("resp_stat", F.when(F.col("resp_disp").isin("full", "partial"), "resp").otherwise("nonresp"))


def response_wave(df: DataFrame) -> DataFrame:
    """The contact after which an answer came; paper always counts as the last one."""
    online, date = F.col("resp_mode") == "online", F.col("resp_date")
    first, second, third = F.col("invitation"), F.col("reminder_1"), F.col("reminder_2")
    return df.withColumn("resp_time",
                         F.when(online & (first <= date) & (date <= second), "inv1")
                         .when(online & (second < date) & (date <= third), "rem1")
                         .when(online & (third < date), "rem2")
                         .when(F.col("resp_mode") == "paper", "rem2"))


def dedupe_responses(df: DataFrame, person: str = "pseudo_id", row_key: str | None = None) -> DataFrame:
    """Best response per person: status, then share done, then earliest date (NULL last).

    Ties are kept, as later checks count on it. With ``row_key`` a last comparison on that key
    leaves exactly one response.
    """
    order = [(F.col("resp_stat") == "resp").cast("int"), F.col("resp_pct"), earliest(F.col("resp_date"))]
    if row_key is not None:
        order.append(-F.col(row_key))
    return slice_best(df, [person], order)


def dedupe_with_history(df: DataFrame, person: str, row_key: str) -> DataFrame:
    """Older form: one response per person, with the number of responses and all modes joined.

    Modes are listed online first, then paper, then others; an unknown mode makes the list NULL.
    Responses are counted per person and mode before anything is gathered, so that at most one
    element per mode meets in a group, however many responses a person has.
    """
    mode_order = F.when(F.col("resp_mode") == "online", 1).when(F.col("resp_mode") == "paper", 2).otherwise(3)
    runs = df.groupBy(person, mode_order.alias("__order"), "resp_mode").agg(F.count(F.lit(1)).alias("__n"))
    part = F.concat(F.col("resp_mode"), F.repeat(F.concat(F.lit(" + "), F.col("resp_mode")), F.col("__n").cast("int") - 1))
    history = runs.groupBy(person).agg(
        F.sum("__n").alias("resp_n"),
        F.bool_or(F.col("resp_mode").isNull()).alias("__unknown"),
        F.array_sort(F.collect_list(F.struct(F.col("__order").alias("o"), part.alias("m")))).alias("__parts"))
    joined = F.array_join(F.transform("__parts", lambda p: p["m"]), " + ")
    history = history.select(person, "resp_n", F.when(~F.col("__unknown"), joined).alias("resp_type"))
    best = slice_best(df, [person], [
        (F.col("resp_stat") == "resp").cast("int"), F.col("resp_pct"), F.unix_date("resp_date"), -F.col(row_key)])
    return join_null_safe(best, history, [person])


def module_shares(long: DataFrame, parts: DataFrame, row_key: str) -> DataFrame:
    """Older form: share answered in demographic and in other questions separately.

    ``parts``: (concept_id, part) with part ``socdem`` or ``other``. Demographic answers without
    substance still count as answered.
    """
    joined = join_null_safe(long, parts, ["concept_id"])
    demo, other = F.col("part") == "socdem", F.col("part") == "other"
    seen, given = F.col("behavior") != "no respons", F.col("behavior") == "respons"
    ratio = lambda hit, base: F.try_divide(F.count_if(hit & base), F.count_if(base))
    return joined.groupBy(row_key).agg(ratio(seen, demo).alias("p_socdem"), ratio(given, other).alias("p_other"))

