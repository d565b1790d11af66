"""Chat-event analytics as plain Spark DataFrame functions.

Every operator takes DataFrames (batch or streaming) and returns a DataFrame.
Clocks, run ids and thresholds are parameters, so results can be reproduced.
"""
