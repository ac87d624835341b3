"""SQL texts of rules that several oracles share."""

from __future__ import annotations

from collections.abc import Sequence


def any_is(columns: Sequence[str], value: str) -> str:
    return "(" + " OR ".join(f"{c} = '{value}'" for c in columns) + ")"


def battery(options: Sequence[str], dk: str, none: str | None = None) -> dict[str, str]:
    """Output column -> expression."""
    ticked = any_is(options, "yes")
    with_none = f" WHEN {none} = 'yes' THEN 'no'" if none else ""
    out = {c: f"CASE WHEN {c} = 'yes' THEN 'yes' WHEN {dk} = 'yes' THEN 'dkn'{with_none} WHEN {ticked} THEN 'no' END"
           for c in options}
    out[dk] = f"CASE WHEN {dk} = 'yes' THEN 'yes' WHEN {ticked} THEN 'no'{with_none} END"
    if none:
        out[none] = f"CASE WHEN {ticked} THEN 'no' WHEN {dk} = 'yes' THEN 'dkn' WHEN {none} = 'yes' THEN 'yes' END"
    return out


def filtered(column: str, condition: str, na: str = "na") -> str:
    return f"CASE WHEN {condition} THEN {column} WHEN NOT ({condition}) THEN '{na}' END"


def select(exprs: dict[str, str], keep: Sequence[str] = ()) -> str:
    return ", ".join([*keep, *[f"{e} AS {c}" for c, e in exprs.items()]])


def behaviour(column: str) -> str:
    return (f"CASE WHEN COALESCE({column}, '') = '' THEN 'no respons' WHEN {column} IN ('dkn', 'invalid') "
            "THEN 'nonsubstantial' ELSE 'respons' END")


def profile(questions: Sequence[str], demographics: Sequence[str], source: str, keep: Sequence[str]) -> str:
    """Share and drop-out point of each row of ``source``."""
    n = len(questions)
    seen = [f"COALESCE({q}, '') <> ''" for q in questions]
    given = [f"(COALESCE({q}, '') NOT IN ('', 'dkn', 'invalid'))" for q in questions]
    pct = [f"{round((i + 1) / n, 3)}" for i in range(n)]
    nxt = [f"'{questions[i + 1]}'" if i + 1 < n else "NULL" for i in range(n)]
    chain = lambda vals: "CASE " + " ".join(f"WHEN {seen[i]} THEN {vals[i]}" for i in reversed(range(n))) + " END"
    some = "(" + " OR ".join(seen) + ")"
    demo = " AND ".join(given[list(questions).index(d)] for d in demographics)
    share = " + ".join(f"CAST({g} AS INT)" for g in given)
    return (f"SELECT {', '.join(keep)}, CASE WHEN {some} THEN {demo} END AS resp_demo, "
            f"CASE WHEN {some} THEN CAST({share} AS DOUBLE) / {n} END AS resp_share, "
            f"CAST({chain(pct)} AS DOUBLE) AS resp_pct, {chain(nxt)} AS resp_drop FROM {source}")


DISPOSITION = """CASE WHEN resp_fwdisp IN ('late', 'deceased', 'incapble', 'language', 'wrongrsp', 'unreach') THEN resp_fwdisp
  WHEN resp_demo AND resp_share >= 0.8 THEN 'full' WHEN resp_demo AND resp_share >= 0.3 THEN 'partial'
  WHEN NOT resp_demo AND COALESCE(resp_pct, 0) > 0 THEN 'wrongrsp' WHEN COALESCE(resp_pct, 0) > 0 THEN 'breakoff'
  WHEN COALESCE(resp_pct, 0) = 0 THEN 'refusal' END"""
STATUS = "CASE WHEN resp_disp IN ('full', 'partial') THEN 'resp' ELSE 'nonresp' END"
WAVE = """CASE WHEN resp_mode = 'online' AND invitation <= resp_date AND resp_date <= reminder_1 THEN 'inv1'
  WHEN resp_mode = 'online' AND reminder_1 < resp_date AND resp_date <= reminder_2 THEN 'rem1'
  WHEN resp_mode = 'online' AND reminder_2 < resp_date THEN 'rem2' WHEN resp_mode = 'paper' THEN 'rem2' END"""
BEST = "RANK() OVER (PARTITION BY pseudo_id ORDER BY CASE WHEN resp_stat = 'resp' THEN 1 ELSE 0 END DESC, resp_pct DESC, resp_date ASC NULLS LAST)"
AGE7 = """CASE WHEN {0} < 18 THEN NULL WHEN {0} < 25 THEN 'a18_24' WHEN {0} < 35 THEN 'a25_34' WHEN {0} < 45 THEN 'a35_44'
  WHEN {0} < 55 THEN 'a45_54' WHEN {0} < 65 THEN 'a55_64' WHEN {0} < 75 THEN 'a65_74' WHEN {0} >= 75 THEN 'a75plus' END"""
AGE4 = """CASE WHEN {0} < 18 THEN NULL WHEN {0} < 35 THEN 'a18_34' WHEN {0} < 50 THEN 'a35_49' WHEN {0} < 65 THEN 'a50_64' WHEN {0} >= 65 THEN 'a65plus' END"""


def ids(table: str, keys: Sequence[str], surv_id: str, salt: str, names: dict[str, str]) -> dict[str, str]:
    """Output column -> expression for pseudonymous ids."""
    parts = ", '|', ".join(f"COALESCE(CONCAT(LENGTH(CAST({k} AS VARCHAR)), ':') || CAST({k} AS VARCHAR), '-')" for k in keys)
    return {name: f"PRINTF('{surv_id}-{infix}%04d', ROW_NUMBER() OVER (ORDER BY SHA256(CONCAT('{salt}:{surv_id}:{name}', '|', {parts}))))"
            for name, infix in names.items()}


def rake(frame: str, key: str, targets: str, covariates: Sequence[str], cap: float, sweeps: int) -> str:
    """CTEs that rake the rows of ``frame`` to ``targets`` (covariate, category, p), ending in ``raked``.

    A sweep meets each margin in turn; then the weights are cut at the cap and the others scaled so
    that the mean is one, where the set above the cap is found on cells sorted by weight.
    """
    cov = ", ".join(covariates)
    goals = " ".join(f"JOIN {targets} g{i} ON g{i}.covariate = '{c}' AND g{i}.category = {c}" for i, c in enumerate(covariates))
    goal_cols = ", ".join(f"g{i}.p AS p{i}" for i in range(len(covariates)))
    carry = ", ".join(f"p{i}" for i in range(len(covariates)))
    ctes = [f"cells AS (SELECT {cov}, COUNT(*) AS n FROM {frame} GROUP BY {cov})",
            f"s0 AS MATERIALIZED (SELECT {cov}, cells.n, {goal_cols}, CAST(1 AS DOUBLE) AS w FROM cells {goals})",
            f"tot AS (SELECT CAST(COUNT(*) AS DOUBLE) AS total FROM {frame})"]
    for s in range(1, sweeps + 1):
        prev = f"s{s - 1}"
        for i, c in enumerate(covariates):
            ctes.append(f"m{s}_{i} AS MATERIALIZED (SELECT {cov}, n, {carry}, w * p{i} * total / SUM(n * w) OVER (PARTITION BY {c}) AS w FROM {prev}, tot)")
            prev = f"m{s}_{i}"
        before = "OVER (ORDER BY w DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        ctes.append(f"k{s} AS (SELECT w, (total - {cap} * COALESCE(SUM(n) {before}, 0)) / (total - COALESCE(SUM(n * w) {before}, 0)) AS k FROM {prev}, tot)")
        ctes.append(f"c{s} AS (SELECT CASE WHEN (SELECT MAX(w) FROM {prev}) > {cap} THEN MAX(k) FILTER (WHERE k * w <= {cap}) ELSE 1.0 END AS k FROM k{s})")
        ctes.append(f"s{s} AS MATERIALIZED (SELECT {cov}, n, {carry}, LEAST(CAST({cap} AS DOUBLE), w * k) AS w FROM {prev}, c{s})")
    join = " AND ".join(f"f.{c} = s{sweeps}.{c}" for c in covariates)
    ctes.append(f"raked AS (SELECT f.{key}, w AS psweight FROM {frame} f JOIN s{sweeps} ON {join})")
    return ",\n".join(ctes)
