"""cinerank: rating analytics and recommendations as Spark DataFrame operators.

Every public operator takes DataFrames (plus parameters) and returns a DataFrame.
Nothing is collected to the driver; the work is planned by Catalyst and executed
by Spark, with Arrow-batched numpy only inside the blocked all-pairs kernels.
"""

import sys

from pyspark import cloudpickle

# task code travels by value: executors need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from cinerank.session import get_session, scratch_path, shared_dir  # noqa: E402

__all__ = ["get_session", "scratch_path", "shared_dir"]
__version__ = "0.1.0"
