"""hoodcast: area x day risk analytics expressed as lazy Spark DataFrame plans.

Subpackages
-----------
sources    readers, sinks, the incremental merge and the driver-table adapter
functions  column-expression helpers (casts, maps, flags, calendar)
operators  DataFrame -> DataFrame operators (geo, panel, windows, features,
           surge, evaluation, quality gates, models, reports)
plans      end-to-end jobs and the query catalogue used by ``__spark_entry__``
llm        training-data operators (optional; nothing else imports it)
"""

from hoodcast.config import Settings, DEFAULTS  # noqa: F401

__all__ = ["Settings", "DEFAULTS"]
