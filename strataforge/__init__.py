"""strataforge: wide-table features, scoring and ensembling as Spark jobs.

Every operator takes DataFrames and returns a DataFrame (or, for profiling
steps, a short list of column names).  Nothing here keeps a hidden session.
"""
