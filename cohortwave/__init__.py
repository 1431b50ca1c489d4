"""Behavioural-session analytics on Spark: `DataFrame -> DataFrame` operators."""

from cohortwave.session import build_session, keep, work_dir

__all__ = ["build_session", "keep", "work_dir"]
