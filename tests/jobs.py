"""Jobs that a piece of code runs."""

import uuid
from contextlib import contextmanager


@contextmanager
def no_jobs(spark):
    """Fails if the block runs a job. The group is its own and ends with the block."""
    context, group = spark.sparkContext, f"building-{uuid.uuid4().hex}"
    context.setJobGroup(group, group)
    try:
        yield
        assert not context.statusTracker().getJobIdsForGroup(group)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        context.setLocalProperty("spark.job.description", None)
