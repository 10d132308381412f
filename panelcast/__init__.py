"""panelcast: daily sales-panel features, forecasts, backtests and scores on Spark.

Every operator takes and returns Spark DataFrames; nothing is collected to
the driver except model fits and tiny parameter tables.
"""

import sys

from pyspark import cloudpickle

from panelcast.config import ForecastConfig, FIXTURE_CONFIG, KEYS

__all__ = ["ForecastConfig", "FIXTURE_CONFIG", "KEYS"]

# Functions of this package travel to executors by value, so they need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
