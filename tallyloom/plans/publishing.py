"""Publishing a version with its checks inside the pass that writes it.

The rules of the DSD are metrics observed while the rows pass on their way to the files, so checking costs no scan of its own. The
files are no version yet: only if no metric speaks against them is the commit row written. A refused version leaves the last one
readable. Where an executor is lost its rows may pass twice and count twice, so a metric decides by being zero or not, and rows are
counted in the files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import validation
from ..operators.validation import Concept, ValidationError
from ..sources import versions


def listed_rules(df: DataFrame, concepts: Sequence[Concept], codelists: DataFrame) -> list[tuple[str, str, Column]]:
    """(concept, "codelist", broken) for concepts with a code list, as ``unlisted_values`` compares them; NULL breaks none.

    A list becomes a set in the expression, looked up in one step per cell; plans are as long as the lists, which are metadata.
    """
    listed = [c for c in concepts if c.kind == "codelist" and c.codelist is not None]
    if not listed:
        return []
    kinds = {f.name: f.dataType for f in df.schema.fields}
    numeric = {c.concept_id for c in listed if isinstance(kinds[c.concept_id], T.NumericType)}
    if numeric and "valuen" not in codelists.columns:
        raise ValidationError(f"numeric columns but no valuen in the code lists: {', '.join(sorted(numeric))}")
    number = F.col("valuen").cast("double") if "valuen" in codelists.columns else F.lit(None).cast("double")
    values: dict[str, tuple[set, set]] = {}
    own = codelists.where(F.col("codelist").isin(sorted({c.codelist for c in listed})))
    for r in own.select("codelist", "value", number.alias("valuen")).distinct().collect():
        texts, numbers = values.setdefault(r["codelist"], (set(), set()))
        texts.add(r["value"])
        numbers.add(r["valuen"])
    rules = []
    for c in listed:
        cell, is_number = F.col(f"`{c.concept_id}`"), c.concept_id in numeric
        known = sorted(v for v in values.get(c.codelist, (set(), set()))[is_number] if v is not None)
        rules.append((c.concept_id, "codelist", cell.isNotNull() & ~(cell.cast("double") if is_number else cell).isin(known)))
    return rules


class Checked:
    """A table whose rules are counted in whatever pass comes to read it: ``df`` is what to write, ``broken()`` what was found."""

    def __init__(self, df: DataFrame, rules: Sequence[tuple[str, str, Column]]):
        self.rules, self._seen = list(rules), Observation()
        metrics = [F.count(F.when(broken, 1)).alias(f"m{i}") for i, (_, _, broken) in enumerate(self.rules)]
        self.df = df.observe(self._seen, F.count(F.lit(1)).alias("rows"), *metrics)

    def broken(self) -> dict[tuple[str, str], int]:
        """Cells per (concept, rule) with any, after the pass."""
        seen = self._seen.get
        return {(c, rule): n for i, (c, rule, _) in enumerate(self.rules) if (n := seen.get(f"m{i}", 0))}


def publish_checked(df: DataFrame, dsd: DataFrame, codelists: DataFrame, path: str, keys: Sequence[str] = (), n_rows: int | None = None) -> int:
    """Publish ``df``, conformed to the DSD, as the next version of the table at ``path``; gives its number.

    Columns without concept, concepts without column and types are checked on the schema, before anything is read. The rules on
    cells and code lists are counted in the pass that writes. ``n_rows`` is the number of rows there must be, if that is known. A
    failure commits nothing; ``error.found`` has the cells per (concept, rule) and ``error.offenders`` the complete lazy table.
    """
    spark = df.sparkSession
    concepts = validation.concepts_for(dsd, df.columns)
    wrong = validation.wrong_types(df, concepts)
    shape = [f"{r['concept_id']}: {r['problem']}" for r in validation.schema_diff(df, dsd).collect()] + [f"{c}: class {kind}" for c, kind in wrong.items()]
    if shape:
        raise ValidationError("\n" + "\n".join(sorted(shape)), validation.problems(df, dsd, codelists))
    order = df.columns
    if "pos" in dsd.columns:
        order = [r["concept_id"] for r in dsd.where(F.col("concept_id").isin(df.columns)).select("pos", "concept_id").sort("pos", "concept_id").collect()]
    checked = Checked(df, validation.cell_rules(df, concepts) + listed_rules(df, concepts, codelists))
    known = versions.latest(spark, path)
    made = versions.write_data(validation.conform(checked.df, concepts, codelists, order), path, keys)
    found = checked.broken()
    if found:
        error = ValidationError("\n" + "\n".join(sorted(f"{c}: {rule} ({n} cells)" for (c, rule), n in found.items())),
                                validation.violations(df, concepts, codelists))
        error.found = found
        raise error
    if n_rows is not None and made["n_rows"] != n_rows:
        raise ValidationError(f"{path}: {made['n_rows']} rows, {n_rows} expected")
    return versions.commit(spark, path, made, known)
