"""seasonlab: season-level scoring, ranking and forecasting as Spark DataFrame operators.

Every operator takes and returns a lazy ``DataFrame``; column names are
arguments. Only model coefficients and metric rows (groups x features^2
numbers) ever reach the driver.
"""

__version__ = "0.1.0"
