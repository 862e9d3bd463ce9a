"""tabmine: tabular data mining expressed as Spark DataFrame jobs.

Every operator takes and returns DataFrames keyed by an explicit id column.
Rows stay distributed; only small model state (centres, trees, per-class
moments) is brought to the driver.
"""

__version__ = "0.1.0"
