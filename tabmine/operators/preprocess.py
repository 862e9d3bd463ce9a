"""D3: an ordered preprocessing chain with a step log and reset.

Steps run in the reference order outliers -> missing values -> normalisation
(or any order the caller chains). Each step is lazy except for the small
aggregates it needs; lineage makes ``reset`` free.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from . import impute as M
from . import outliers as O
from . import scale as N


class Preprocessor:
    def __init__(self, df: DataFrame):
        self.original = df
        self.df = df
        self.steps: list[str] = []

    def remove_outliers(self, cols: Sequence[str], mode: str = "sequential") -> "Preprocessor":
        self.df = O.remove_outliers_iqr(self.df, cols, mode)
        self.steps.append(f"outliers_iqr_{mode}")
        return self

    def impute(self, strategy: str, per_column: dict | None = None, order_by: Sequence[str] | None = None,
               target: str | None = None) -> "Preprocessor":
        self.df = M.impute(self.df, strategy, per_column, order_by, target)
        self.steps.append(f"impute_{strategy}")
        return self

    def normalise(self, strategy: str, cols: Sequence[str] | None = None, target: str | None = None) -> "Preprocessor":
        self.df = N.normalise(self.df, strategy, cols, target)
        self.steps.append(f"normalise_{strategy}")
        return self

    def bin(self, col: str, n: int = 5, method: str = "equal_width") -> "Preprocessor":
        self.df = N.bin_equal_width(self.df, col, n) if method == "equal_width" else N.bin_equal_freq(self.df, col, n)
        self.steps.append(f"bin_{method}_{col}")
        return self

    def reset(self) -> "Preprocessor":
        self.df = self.original
        self.steps = []
        return self

    def summary(self) -> dict:
        return {"steps": list(self.steps), "columns": self.df.columns}
