"""DataFrame -> DataFrame operators (batch and streaming alike where Spark
allows it)."""

from livetable.operators.aggregate import (count_by, filtered_stats, lowest_by,
                                           rmse, rmse_vs_group_mean, top_n,
                                           top_n_with_attr)
from livetable.operators.ranking import lowest_items_per_key, top_items_per_key
from livetable.operators.joins import attach
from livetable.operators.integrity import missing_id_xor, missing_ids
from livetable.operators.registry import latest_per_key
from livetable.operators.split import hash_bucket, hash_split

__all__ = ["count_by", "filtered_stats", "lowest_by", "rmse",
           "rmse_vs_group_mean", "top_n", "top_n_with_attr",
           "lowest_items_per_key", "top_items_per_key", "attach",
           "missing_id_xor", "missing_ids", "latest_per_key", "hash_bucket",
           "hash_split"]
