"""Ebbline: liquidity-coverage analytics expressed as Spark DataFrame plans.

Every public operator takes DataFrames and returns a DataFrame.  Nothing is
executed until the caller asks for it.
"""

from ebbline.plans.jobs import Book, forecast_job, run_forecast, run_what_if, what_if_job

__all__ = ["Book", "forecast_job", "run_forecast", "run_what_if", "what_if_job"]
