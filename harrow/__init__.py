"""Harrow: crop-pixel, time-series and model-run analytics as Spark jobs."""

import sys

from pyspark import cloudpickle

from harrow.session import build_session, scratch_dir

# Arrow helpers travel to the executors with the job, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "scratch_dir"]
