"""Raking: weights under which the sample has the margins of the population.

The weight of a cell of covariates is the product of one factor per category, cut at a cap (Deming and Stephan, 1940;
Deville and Sarndal, 1992, for the bounded form). The logarithms of the factors minimise a convex function, so they are found by
Newton's method: a step is one aggregate of the cells to the pairs of categories, which holds the margins and how they
react to every factor, and a linear system as large as the code lists. Six to ten such jobs replace hundreds of sweeps.
Only where no factors meet the margins (the cap allows none, or margins contradict each other) are they approached by
proportional fitting in sweeps, cutting at the cap and rescaling in turn, as in survey practice (DeBell and Krosnick, 2009).
Cells are never shuffled again, and factors are looked up by category number in arrays as long as the code lists.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.nulls import join_null_safe
from ..session import cut_lineage

SLACK = 1e-9
_DEPTH = 6  # cuts between two checkpoints of the cells
_STEPS, _HALVINGS, _FAR = 40, 8, 60.0  # Newton steps, halvings of one, and the factor (its logarithm) that means there is no solution


class RakingError(ValueError):
    """Targets the sample cannot meet, or weights that do not settle."""


def usable_covariates(rows: DataFrame, targets: DataFrame, covariates: Sequence[str]) -> list[str]:
    """Those of ``covariates`` that both tables have; an error where none is left."""
    known = {r[0] for r in targets.select("covariate").distinct().collect()}
    used = [c for c in covariates if c in known and c in rows.columns]
    if not used:
        raise RakingError(f"no targets for any of: {', '.join(covariates)}")
    return used


def _numbered(cells: DataFrame, goals: dict[str, dict], covariates: Sequence[str]) -> DataFrame:
    """Adds the number of each category in its target list, or NULL."""
    spark = cells.sparkSession
    for i, name in enumerate(covariates):
        kind = cells.schema[name].dataType.simpleString()
        codes = spark.createDataFrame([(k, j) for j, k in enumerate(goals[name])], f"__k string, __c{i} int")
        cells = cells.join(codes.withColumn("__k", F.col("__k").cast(kind)), F.col(f"`{name}`") == F.col("__k"), "left").drop("__k")
    return cells


def _weight(base: str, factors: Sequence[Sequence[float]]) -> str:
    """The weight of a cell: its base times the factor of each of its categories."""
    parts = [f"element_at(array({', '.join(repr(float(x)) + 'D' for x in own)}), __c{i} + 1)" for i, own in enumerate(factors)]
    return " * ".join([base, *parts])


def _cap_scale(cells: DataFrame, weight: str, cap: float, total: float) -> float:
    """The scale at which cutting at the cap leaves a mean of one; 1 where nothing exceeds it.

    Aggregates find it; the set of cells above the cap only grows, so they are few.
    """
    scale = 1.0
    while True:
        row = cells.selectExpr("__n", f"{weight} AS w").selectExpr(
            f"sum(CASE WHEN w * {scale!r}D >= {cap!r}D THEN __n ELSE 0 END) AS over",
            f"sum(CASE WHEN w * {scale!r}D >= {cap!r}D THEN 0D ELSE __n * w END) AS under").first()
        if not row["over"] or row["under"] <= 0:
            return scale
        updated = (total - cap * float(row["over"])) / row["under"]
        if updated <= scale * (1 + 1e-15):
            return scale
        scale = updated


def _pair_sums(cells: DataFrame, weight: str, cap: float) -> dict[tuple[int, int, int | None, int | None], tuple[float, float, float, float]]:
    """For each pair of covariates and of their categories: rows, weight cut at the cap, weight of cells below it, and the convex
    function's share. One aggregate over the cells, as long as the code lists squared."""
    names = [c for c in cells.columns if c.startswith("__c")]
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(a).alias("a"), F.col(b).alias("b"))
                      for i, a in enumerate(names) for j, b in enumerate(names) if i <= j])
    own = cells.select("__n", F.expr(weight).alias("__w"), F.inline(pairs))
    low = F.col("__w") < cap
    cost = F.when(low, F.col("__w")).otherwise(cap * (1 + F.log("__w") - float(np.log(cap))))
    got = own.groupBy("i", "j", "a", "b").agg(
        F.sum("__n"), F.sum(F.col("__n") * F.least("__w", F.lit(cap))), F.sum(F.when(low, F.col("__n") * F.col("__w")).otherwise(0.0)),
        F.sum(F.col("__n") * cost)).collect()
    return {(r[0], r[1], r[2], r[3]): (float(r[4]), r[5], r[6], r[7]) for r in got}


class _Dual:
    """The convex function whose minimum are the logarithms of the factors, at one point."""

    def __init__(self, cells: DataFrame, goals: list[list[float]], logs: np.ndarray, cap: float, sums: dict | None = None):
        self.goals, self.logs = np.concatenate(goals), logs
        starts = np.cumsum([0] + [len(g) for g in goals])
        factors = [np.exp(logs[a:b]).tolist() for a, b in zip(starts, starts[1:])]
        self.weight = _weight("1.0D", factors)
        sums = sums or _pair_sums(cells, self.weight, cap)
        k = len(self.goals)
        self.margins, self.curve = np.zeros(k), np.zeros((k, k))
        self.value = -float(self.goals @ logs)
        for (i, j, a, b), (_, cut, low, cost) in sums.items():
            if a is None or b is None:
                continue
            x, y = starts[i] + a, starts[j] + b
            self.curve[x, y] = self.curve[y, x] = low
            if i == j:
                self.margins[x] += cut
                self.value += cost if i == 0 else 0.0

    def off(self) -> float:
        """Largest difference to a margin, as a share of it."""
        return float(np.max(np.abs(self.margins - self.goals) / self.goals))

    def step(self) -> np.ndarray:
        own = np.diagonal(self.curve)
        # where most of a margin that is too large is cut at the cap it hardly reacts: then it is as if it reacted a little
        flat = (own < 0.2 * self.margins) & (self.margins > self.goals)
        curve = self.curve + np.diag(np.where(flat, 0.25 * self.margins, 0.0))
        # one factor per covariate is free, so the system is solved in the least-squares sense
        return np.linalg.lstsq(curve, self.goals - self.margins, rcond=1e-12)[0]


def _newton(cells: DataFrame, goals: list[list[float]], cap: float, tol: float, first: _Dual) -> str | None:
    """The weight of a cell that meets all margins, or None where there seems to be none.

    Near the minimum a step squares the distance, so it goes on to rounding; ``tol`` is what counts as met where steps stay slow,
    as with weights that must vanish.
    """
    totals = [sum(g) for g in goals]
    if max(totals) - min(totals) > SLACK * max(totals):
        return None
    at, idle = first, 0
    for _ in range(_STEPS):
        if at.off() <= SLACK or idle == 3:
            break
        step = at.step()
        size = float(np.max(np.abs(step)))
        if not np.isfinite(size) or size < 1e-14 or float(np.max(np.abs(at.logs))) > _FAR:
            break
        ahead = _shorter(cells, goals, cap, at, step, min(1.0, 4.0 / size))
        if ahead is None:
            break
        idle = idle + 1 if ahead.off() > 0.99 * at.off() and ahead.value > at.value - SLACK * abs(at.value) else 0
        at = ahead
    return f"least({cap!r}D, {at.weight})" if at.off() <= tol else None


def _shorter(cells: DataFrame, goals: list[list[float]], cap: float, at: _Dual, step: np.ndarray, share: float) -> _Dual | None:
    """The first of a step, half of it and so on that makes things better."""
    for _ in range(_HALVINGS):
        ahead = _Dual(cells, goals, at.logs + share * step, cap)
        if ahead.value <= at.value or ahead.off() < at.off():
            return ahead
        share /= 2
    return None


def rake_cells(rows: DataFrame, targets: DataFrame, covariates: Sequence[str], cap: float = 5.0,
               tol: float = 1e-6, max_sweeps: int = 500) -> DataFrame:
    """One row per covariate cell: number of rows ``n`` and weight ``psweight`` (mean one).

    Covariates that only one of the tables has are left out. Margins are met to a share of ``tol``. Where the cap or the
    margins themselves do not let them be met, sweeps go as near as they come and stop when one changes no weight by more than
    ``tol``. A category of the sample without a target, a target without a row, and weights that have not settled after
    ``max_sweeps`` are errors.
    """
    if cap <= 1:
        raise RakingError("a cap of one or less leaves no room for weights with mean one")
    used = usable_covariates(rows, targets, covariates)
    wanted: dict[str, dict] = {c: {} for c in used}  # as long as the code lists
    for r in targets.where(F.col("covariate").isin(used) & (F.col("p") > 0)).select("covariate", "category", "p").collect():
        wanted[r["covariate"]][r["category"]] = r["p"]
    cells = rows.groupBy(*covariates).agg(F.count(F.lit(1)).alias("__n"))
    cells = cut_lineage(_numbered(cells, wanted, used).withColumn("__base", F.lit(1.0)))
    result = [*covariates, F.col("__n").alias("n")]
    first = _pair_sums(cells, "1.0D", cap)
    total = sum(rows_in for (i, j, _, _), (rows_in, *_) in first.items() if i == j == 0)
    if not total:
        return cells.select(*result, F.col("__base").alias("psweight"))
    met = {(i, a) for i, j, a, _ in first if i == j}
    strange = [f"{c}={r[0]}" for i, c in enumerate(used) if (i, None) in met
               for r in cells.where(f"__c{i} IS NULL").select(c).distinct().sort(c).collect()]
    if strange:
        raise RakingError(f"categories of the sample without a target: {', '.join(strange)}")
    absent = [f"{c}={k}" for i, c in enumerate(used) for k in sorted(k for j, k in enumerate(wanted[c]) if (i, j) not in met)]
    if absent:
        raise RakingError("targets without a row in the sample: " + ", ".join(absent))
    goals = [[p * total for p in wanted[c].values()] for c in used]
    start = _Dual(cells, goals, np.zeros(sum(map(len, goals))), cap, first)
    weight = _newton(cells, goals, cap, tol, start)
    if weight is not None:
        return cells.select(*result, F.expr(weight).alias("psweight"))
    return _swept(cells, goals, cap, tol, max_sweeps, result)


def _swept(cells: DataFrame, goals: list[list[float]], cap: float, tol: float, max_sweeps: int, result: list) -> DataFrame:
    """Proportional fitting with cuts at the cap, until a sweep changes no weight by more than ``tol``."""
    total = sum(goals[0])
    factors = [[1.0] * len(g) for g in goals]

    def sums(i: int, weight: str, before: str | None = None) -> tuple[list[float], float, float]:
        """Weight of each category, the largest weight, and the largest difference to the weight ``before``."""
        moved = f"max(abs({weight} - ({before})))" if before else "0D"
        got = cells.groupBy(f"__c{i}").agg(F.expr(f"sum(__n * {weight})"), F.expr(f"max({weight})"), F.expr(moved)).collect()
        own = {r[0]: r[1] for r in got}
        return [own[j] for j in range(len(goals[i]))], max(r[2] for r in got), max(r[3] for r in got)

    base, depth, cutting, weight = "__base", 0, False, _weight("__base", factors)
    here, _, _ = sums(0, weight)
    for _ in range(max_sweeps):
        before = weight
        for i in range(len(goals)):
            if i:
                here, _, _ = sums(i, _weight(base, factors))
            factors[i] = [f * g / h if h > 0 else 0.0 for f, g, h in zip(factors[i], goals[i], here)]
        weight = _weight(base, factors)
        if not cutting:  # once the cap cuts it goes on doing so
            here, largest, moved = sums(0, weight, before)
            cutting = largest > cap * (1 + SLACK)
        if cutting:
            scale = _cap_scale(cells, weight, cap, total)
            base, depth, factors = f"least({cap!r}D, ({weight}) * {scale!r}D)", depth + 1, [[1.0] * len(g) for g in goals]
            weight = base
            here, _, moved = sums(0, weight, before)
        if moved <= tol:
            return cells.select(*result, F.expr(weight).alias("psweight"))
        if depth == _DEPTH:  # weights are expressions over the cells until these grow long
            cells = cut_lineage(cells.withColumn("__base", F.expr(weight)))
            base, depth, factors, weight = "__base", 0, [[1.0] * len(g) for g in goals], "__base"
    raise RakingError(f"weights still change by {moved:.2g} after {max_sweeps} sweeps")


def rake_weights(rows: DataFrame, targets: DataFrame, covariates: Sequence[str], row_key: str, cap: float = 5.0,
                 tol: float = 1e-6, max_sweeps: int = 500) -> DataFrame:
    """(row key, psweight) for every row of the raking frame."""
    cells = rake_cells(rows, targets, covariates, cap, tol, max_sweeps)
    return attach_cell_weights(rows, cells, covariates).select(row_key, "psweight")


def attach_weights(df: DataFrame, weights: DataFrame, row_key: str) -> DataFrame:
    """Add the weight; rows outside the raking frame get NULL."""
    return join_null_safe(df, weights.select(row_key, "psweight"), [row_key])


def attach_cell_weights(df: DataFrame, cells: DataFrame, covariates: Sequence[str],
                        used: Column | None = None) -> DataFrame:
    """Add the weight of its cell to every row for which ``used`` holds; other rows get NULL.

    Equal to attaching weights by row key, but the persons are joined to the few cells and so need
    no shuffle where Spark finds them few. A row with an unknown covariate belongs to no cell.
    """
    lookup = cells.select(*[F.col(c).alias(f"__cell_{c}") for c in covariates], F.col("psweight").alias("__psweight"))
    same = reduce(and_, [df[c] == lookup[f"__cell_{c}"] for c in covariates])
    joined = df.join(lookup, same, "left")
    weight = F.col("__psweight") if used is None else F.when(used, F.col("__psweight"))
    return joined.select(*df.columns, weight.alias("psweight"))


def weighted_margins(df: DataFrame, covariates: Sequence[str], weight: str = "psweight") -> DataFrame:
    """Weighted share of each category, for checking weights against their targets."""
    cells = df.where(F.col(weight).isNotNull()).groupBy(*covariates).agg(F.sum(weight).alias("__w"))
    long = cells.unpivot(["__w"], list(covariates), "covariate", "category")
    sums = long.groupBy("covariate", "category").agg(F.sum("__w").alias("w"))
    return sums.select("covariate", "category", (F.col("w") / F.sum("w").over(Window.partitionBy("covariate"))).alias("p"))

