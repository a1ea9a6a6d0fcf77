"""Timed-text analytics as Spark jobs: cues, words, speech, links and review records."""

import sys

from pyspark import cloudpickle

from cuelake.session import checkpoint_dir, get_session

# Executors need not have this package: its few Python functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["checkpoint_dir", "get_session"]
