"""tablewright: clean, profile, relate and merge wide metadata tables on Spark.

Every operator takes and returns DataFrames. What an operator must know about
the data before it can build its plan (which columns are sparse, which one is
a key, how two columns relate) comes from an aggregate whose result has one row
per column or per pair of columns; data rows never reach the driver.
"""

from tablewright.session import build_session, clear_stages, materialize

__all__ = ["build_session", "clear_stages", "materialize"]
