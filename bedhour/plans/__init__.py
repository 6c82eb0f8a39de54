from .dataset import MODES, Mode, engineer_features, final_dataset, hourly_table
from .stages import Outliers, align_events, clean_events, extract_events, restrict_cohort, select_events

__all__ = [
    "MODES",
    "Mode",
    "Outliers",
    "align_events",
    "clean_events",
    "engineer_features",
    "extract_events",
    "final_dataset",
    "hourly_table",
    "restrict_cohort",
    "select_events",
]
