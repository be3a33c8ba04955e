"""metricbook: KPI modules, repository, performance report and time-series alerts on Spark."""

__version__ = "0.1.0"
