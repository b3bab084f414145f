"""shelfwise: prompt-based recommendation data preparation on Spark.

Every public operator takes DataFrames and returns a DataFrame. Nothing is
collected to the driver except bounded configuration (templates, per-partition
counts). See README.md for the operator map.
"""

import sys

from pyspark import cloudpickle as _cloudpickle

# Python workers receive our scorer/tokenizer callables by value, so the
# package need not be installed on executors (``--py-files`` also works).
_cloudpickle.register_pickle_by_value(sys.modules[__name__])

from shelfwise.session import build_session, checkpoint_dir  # noqa: E402

__all__ = ["build_session", "checkpoint_dir"]
