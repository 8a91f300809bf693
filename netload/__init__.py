"""Mobile-network telemetry analytics on PySpark.

Every public function takes and returns DataFrames (or Columns) and is lazy
unless its docstring says otherwise. The caller owns the session: nothing here
builds, stops or reconfigures one.
"""
