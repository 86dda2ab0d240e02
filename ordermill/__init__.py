"""Order and marketplace analytics on Spark DataFrames.

Layers: ``sources`` (typed reads, writes, state), ``operators`` (DataFrame to
DataFrame), ``streaming`` (incremental jobs), ``plans`` (jobs and the query
catalog), ``functions`` (column expressions shared by all of them).
"""
