"""matchledger: game-telemetry facts and return on ad spend as Spark DataFrames.

Sources feed plain DataFrame functions; each plan takes DataFrames and returns
one, so Catalyst sees the whole query. Only the refresh operators run jobs of
their own, because they write tables.
"""
