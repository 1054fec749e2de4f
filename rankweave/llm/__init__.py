"""Operators for preparing training data. Nothing else in the library imports this subpackage.

Functions sent to tasks are pickled by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

from rankweave.llm.queries import QUERIES, SQL  # noqa: E402

__all__ = ["QUERIES", "SQL"]
