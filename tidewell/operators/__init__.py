from tidewell.operators.aggregates import (
    global_mean, group_count, group_mean, mean_between, non_null_count, row_count,
)
from tidewell.operators.features import (
    add_family, add_title, assemble, feature_stages, fill_by_group, fill_mode, modes,
    frequency_index, hash_split, impute_group_mean, index_strings, random_split,
    remap_from_table, remap_values,
    value_counts,
)
from tidewell.operators.joins import sized_for_broadcast
from tidewell.operators.models import (
    CLASSIFIERS, accuracy, compare_classifiers, majority_accuracy, score, with_label,
)
from tidewell.operators.profile import (
    column_summary, exact_summary, null_profile, text_summary,
)
from tidewell.operators.rows import top_rows

__all__ = [
    "CLASSIFIERS", "accuracy", "add_family", "add_title", "assemble", "column_summary",
    "compare_classifiers", "exact_summary", "feature_stages", "fill_by_group", "fill_mode", "modes", "frequency_index",
    "global_mean", "group_count", "group_mean", "hash_split", "impute_group_mean", "index_strings",
    "majority_accuracy", "mean_between", "non_null_count", "null_profile", "random_split",
    "remap_from_table", "remap_values", "row_count", "score", "sized_for_broadcast", "text_summary",
    "top_rows",
    "value_counts", "with_label",
]
