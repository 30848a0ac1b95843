"""Batch reporting, event validation and data quality on Spark DataFrames.

Every operation takes DataFrames and parameters and returns a DataFrame. No
module starts a session, reads the clock inside a transform without letting the
caller pass the value, or pulls rows to the driver.
"""
