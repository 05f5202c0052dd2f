"""Set-wise analytics over a data estate that moves between storage accounts.

Every operator takes DataFrames plus keyword parameters and returns a DataFrame.
None reads the clock (``as_of`` is a parameter); the driver sees counts and one-row verdicts, never rows of data.
"""
