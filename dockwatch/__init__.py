"""dockwatch: leak-free station-risk features, labels, reports, metrics and
triage as Spark DataFrame plans."""

from dockwatch.settings import DATASET_COLUMNS, FEATURE_COLUMNS, Settings

__all__ = ["Settings", "FEATURE_COLUMNS", "DATASET_COLUMNS"]
