"""Commerce behaviour analytics as PySpark DataFrame and Structured Streaming jobs.

Every public function takes DataFrames plus plain arguments and returns a lazy
DataFrame; nothing here collects rows to the driver or runs Python per row.
"""
