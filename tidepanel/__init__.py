"""tidepanel: panel and event analytics as Spark DataFrame work.

Every operator is a plain function ``DataFrame -> DataFrame`` (use it via
``df.transform``); entity, time, metric and value column names are
parameters.  Only coefficient-sized matrices ever reach the driver.
"""

LONG_COLS = ("entity", "date", "metric", "value")
