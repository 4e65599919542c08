"""tidepool: keyed event analytics as Spark DataFrame operators.

Every operator takes and returns DataFrames; batch operators are declared with
the DataFrame API so Catalyst plans them, streaming ones run on Structured
Streaming.  See README.md for the operator map.
"""

__version__ = "0.1.0"
