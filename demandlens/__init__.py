"""demandlens: daily demand-forecast monitoring as Spark DataFrame jobs.

``plans.jobs`` holds the six report jobs and the snapshot gate, ``plans.run.run`` the batch,
``sources.roles`` the typed role tables, and ``sinks.report`` the per-section report sink.
"""

from demandlens.params import Params

__all__ = ["Params"]
