"""Usage reports.  Each takes archive DataFrames, keeps the current rows and returns a DataFrame.

``asof`` stands for the clock, so that a report can be repeated.
"""
