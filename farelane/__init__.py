"""farelane: city trip warehouse models built on Spark DataFrames.

Staging, fact, mart, report and data-quality models for yellow, green and
for-hire trip records, plus incremental ingest.  Every model is a function
from DataFrames to a DataFrame; nothing executes until an action runs.
"""

__version__ = "0.1.0"
