"""Whole datasets and jobs."""

from loomset.plans.datasets import (
    PreparedData,
    ReadOptions,
    load_dpo_dataset,
    load_sft_dataset,
    load_text_corpus,
)
from loomset.plans.job import JobError, PrepJob, run_prep_job

__all__ = [
    "JobError",
    "PrepJob",
    "PreparedData",
    "ReadOptions",
    "load_dpo_dataset",
    "load_sft_dataset",
    "load_text_corpus",
    "run_prep_job",
]
