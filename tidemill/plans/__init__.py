"""Whole jobs put together from the operators."""

from tidemill.plans.features import feature_table, write_feature_table
from tidemill.plans.windows import WINDOWS, read_windows, run_window_job

__all__ = ["WINDOWS", "feature_table", "read_windows", "run_window_job", "write_feature_table"]
