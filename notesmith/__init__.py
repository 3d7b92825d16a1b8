"""notesmith — Spark-native article enrichment and topic maps.

DataFrame -> DataFrame operators for turning raw article tables into scored,
summarised, rendered notes and topic-map pages. See README.md for the layout.
"""

from notesmith.session import get_spark, load_table, checkpoint_dir

__all__ = ["get_spark", "load_table", "checkpoint_dir"]
