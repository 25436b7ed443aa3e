"""starling: warehouse loading and tabular experiments on Spark DataFrames."""

import sys

from pyspark import cloudpickle

from starling.session import get_session, stage

# task functions travel with their code, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["get_session", "stage"]
