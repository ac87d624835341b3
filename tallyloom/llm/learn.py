"""Small models for tasks: logistic regression by Newton steps, and samples of labelled rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """The fifth of rows that never teach: crc32 of the id as text, mod 5, is 0. A row without an id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def teaching_rows(labels: DataFrame, id_col: str, label_col: str, each: int) -> DataFrame:
    """_id, label (0 or 1), half (0 or 1): at most ``each`` labelled rows of either label, those with the smallest hash.

    Rows held out, without an id, or with another label are left out; an id labelled twice counts by its largest label.
    """
    rows = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label"))
            .filter("_id IS NOT NULL AND label IN (0, 1)").filter(~held_out(F.col("_id"))).groupBy("_id").agg(F.max("label").alias("label")))
    order = F.xxhash64("_id")
    picked = [rows.filter(f"label = {v}").orderBy(order, "_id").limit(each) for v in (0, 1)]
    return picked[0].union(picked[1]).withColumn("half", F.pmod(F.xxhash64(F.lit("half"), "_id"), F.lit(2)).cast("int"))


class Logistic:
    """Regularised logistic regression on standardised features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, penalty: float = 0.01, steps: int = 40):
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        z = self._scaled(x)
        self.w = np.zeros(z.shape[1])
        pull = penalty * np.eye(z.shape[1])
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(z @ self.w, -35, 35)))
            grad = z.T @ (p - y) + pull @ self.w
            step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + pull, grad)
            self.w -= step
            if np.abs(step).max() < 1e-8:
                break

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([(x - self.mean) / self.scale, np.ones((len(x), 1))])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._scaled(x) @ self.w, -35, 35)))
