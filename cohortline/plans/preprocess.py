"""Fit once, apply anywhere: the cleaning steps as one fitted object."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from cohortline import defaults as D
from cohortline.operators import encode as en
from cohortline.operators.chained import IterativeImputer
from cohortline.operators.impute import DropSparse, Imputer, MissingIndicators, null_ratios
from cohortline.operators.knn import KnnImputer
from cohortline.operators.outliers import Outliers
from cohortline.operators.scale import QuantileNormal, Scaler
from cohortline.plans.features import FeatureSet
from cohortline.session import durable, kept

_ENCODERS = {
    "onehot": lambda df, columns, label, limit: en.OneHot.fit(df, columns, limit),
    "label": lambda df, columns, label, limit: en.fit_label(df, columns),
    "frequency": lambda df, columns, label, limit: en.fit_frequency(df, columns),
    "target": lambda df, columns, label, limit: en.fit_target(df, columns, label),
}


@dataclass
class Preprocessor:
    """Drop sparse columns, flag and impute gaps, treat outliers, encode, scale.

    ``features`` places derived features between outliers and encoding, where
    they see values in their own units; ``reference_order`` derives them last,
    from encoded and scaled columns. ``strategy`` is mean, median, mode, knn or
    iterative; categories always take their mode. ``outlier_options`` go to the
    method (``factor``, ``threshold`` or ``limits``); with
    ``sequential_outliers`` removal by one column shows in the next one's bounds.
    """

    numeric: Sequence[str] = D.NUMERIC
    categorical: Sequence[str] = D.CATEGORICAL
    label: str = D.LABEL
    strategy: str = "median"
    max_missing_ratio: float = 0.8
    indicator_features: bool = True
    outlier_method: str = "iqr"
    outlier_action: str = "clip"
    outlier_options: Mapping[str, object] = field(default_factory=dict)
    sequential_outliers: bool = False
    neighbors: int = 5
    rounds: int = 10
    encoding: str = "target"
    max_categories: int = 20
    scaling: str = "standard"
    features: FeatureSet | None = None
    reference_order: bool = False
    steps: list = field(default_factory=list, init=False)
    fitted: bool = field(default=False, init=False)

    def fit(self, df: DataFrame) -> Preprocessor:
        """Learn each step on the output of the steps before it.

        Null shares are counted on the whole input; the fitted columns alone
        are kept while the other steps learn from them. Derived features learn
        nothing and are not computed here.
        """
        self.steps, self.fitted = [], False
        ratios = null_ratios(df)
        self.steps.append(DropSparse.fit(df, self.max_missing_ratio, ratios))
        left = self.steps[0].transform(df).columns
        needed = [c for c in dict.fromkeys((*self.numeric, *self.categorical, self.label)) if c in left]
        with kept(df.select(*needed)) as now:
            for make in self._plan(ratios):
                step = make(now)
                if isinstance(step, FeatureSet):
                    self.steps.append(step)
                elif step is not None:
                    self.steps.append(step)
                    now = step.transform(now)
        self.fitted = True
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        if not self.fitted:
            raise RuntimeError("no steps yet: call fit first, transform applies what it learned")
        for step in self.steps:
            df = step.transform(df)
        return df

    def fit_transform(self, df: DataFrame) -> DataFrame:
        if self.strategy == "knn":
            df = durable(df)  # it is read at both and, for rows with gaps and without, twice at the second
        return self.fit(df).transform(df)

    def _plan(self, ratios: dict[str, float]):
        def numeric(df):
            return [c for c in self.numeric if c in df.columns]

        def categorical(df):
            return [c for c in self.categorical if c in df.columns]

        def flags(df):
            if self.indicator_features:
                return MissingIndicators.fit(df, (*numeric(df), *categorical(df)), ratios)
            return None

        def impute(df):
            if self.strategy in ("knn", "iterative"):
                return Imputer.fit(df, (), categorical(df))
            return Imputer.fit(df, numeric(df), categorical(df), self.strategy)

        def model(df):
            if self.strategy == "knn":
                return KnnImputer.fit(df, numeric(df), self.neighbors)
            return IterativeImputer.fit(df, numeric(df), self.rounds) if self.strategy == "iterative" else None

        def outliers(df):
            if not self.outlier_method:
                return None
            return Outliers.fit(
                df, numeric(df), self.outlier_method, self.outlier_action, self.sequential_outliers, **self.outlier_options)

        def encode(df):
            return _ENCODERS[self.encoding](df, categorical(df), self.label, self.max_categories)

        def scale(df):
            if self.scaling == "quantile":
                return QuantileNormal.fit(df, numeric(df))
            return Scaler.fit(df, numeric(df), self.scaling) if self.scaling else None

        def derive(df):
            return self.features

        tail = (encode, scale, derive) if self.reference_order else (derive, encode, scale)
        return (flags, impute, model, outliers, *tail)
