from refillcast.learning.categories import category_sizes, index_rows, number_categories
from refillcast.learning.elastic_net import (
    ElasticNetSpec,
    FittedModel,
    cross_validate,
    elastic_net,
    evaluate,
    fit_replenishment_model,
    fold_of,
    grid,
    predict,
)
from refillcast.learning.features import CAT_FEATURES, NUM_FEATURES, candidate_num_features, select_features
from refillcast.learning.preprocess import SCALERS, assemble, index_categories, one_hot, preprocess, scaler, select_top
from refillcast.learning.report import (
    category_frequencies,
    coefficient_report,
    feature_dictionary,
    selected_coefficients,
    slot_ranges,
)

__all__ = [
    "CAT_FEATURES",
    "ElasticNetSpec",
    "FittedModel",
    "NUM_FEATURES",
    "SCALERS",
    "assemble",
    "candidate_num_features",
    "category_frequencies",
    "category_sizes",
    "coefficient_report",
    "cross_validate",
    "elastic_net",
    "evaluate",
    "feature_dictionary",
    "fit_replenishment_model",
    "fold_of",
    "grid",
    "index_categories",
    "index_rows",
    "number_categories",
    "one_hot",
    "predict",
    "preprocess",
    "scaler",
    "select_features",
    "select_top",
    "selected_coefficients",
    "slot_ranges",
]
