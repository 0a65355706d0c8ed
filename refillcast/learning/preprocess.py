"""Preprocessing: indexing, one-hot encoding, assembling, scaling, selection."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Estimator, Pipeline, Transformer
from pyspark.ml.feature import (
    MaxAbsScaler,
    MinMaxScaler,
    Normalizer,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    UnivariateFeatureSelector,
    VectorAssembler,
)

SCALERS: dict[str, Callable[..., Estimator | Transformer]] = {
    "minmax": MinMaxScaler,
    "standard": StandardScaler,
    "maxabs": MaxAbsScaler,
    "normalizer": Normalizer,
}


def index_categories(cols: Sequence[str]) -> StringIndexer:
    """All categories indexed by falling frequency in one pass; unseen and NULL get the last index."""
    return StringIndexer(
        inputCols=list(cols),
        outputCols=[f"{c}__index" for c in cols],
        handleInvalid="keep",
        stringOrderType="frequencyDesc",
    )


def one_hot(cols: Sequence[str]) -> OneHotEncoder:
    """One slot per known category; unseen and NULL give all zeros."""
    return OneHotEncoder(
        inputCols=[f"{c}__index" for c in cols], outputCols=[f"{c}__encoded" for c in cols], dropLast=True
    )


def assemble(cols: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol="features")


def scaler(name: str) -> Estimator | Transformer:
    if name not in SCALERS:
        raise ValueError(f"unknown scaler {name!r}; use one of {sorted(SCALERS)}")
    return SCALERS[name](inputCol="features", outputCol="scaled_features")


def select_top(k: int, label: str) -> UnivariateFeatureSelector:
    """The k features with the best F-regression score; all where there are fewer."""
    selector = UnivariateFeatureSelector(
        selectionMode="numTopFeatures",
        labelCol=label,
        featuresCol="scaled_features",
        outputCol="selected_features",
    )
    return selector.setFeatureType("continuous").setLabelType("continuous").setSelectionThreshold(k)


def preprocess(
    cat_features: Sequence[str],
    num_features: Sequence[str],
    label: str,
    scaler_name: str,
    top_features: int,
    indexed: bool = False,
) -> Pipeline:
    """The whole preprocessing; ``num_features`` are the column names to assemble.

    ``indexed``: the rows have their categories' numbers already (``categories.index_rows``), so that no
    label is held by the driver or the model.
    """
    return Pipeline(
        stages=[
            *([] if indexed else [index_categories(cat_features)]),
            one_hot(cat_features),
            assemble([*[f"{c}__encoded" for c in cat_features], *num_features]),
            scaler(scaler_name),
            select_top(top_features, label),
        ]
    )
