"""Text and table analytics as plain PySpark jobs.

Every public function takes and returns DataFrames (or Columns); the session is
always the caller's.
"""
