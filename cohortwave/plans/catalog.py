"""All registered plans."""

from cohortwave.plans import event_plans, io_plans, labelling_plans, stimulus_plans, stream_plans, trial_plans  # noqa: F401
from cohortwave.plans.registry import PLANS

__all__ = ["PLANS"]
