"""Meter-reading analytics on Spark DataFrames.

Every operator takes DataFrames and returns a DataFrame; nothing is collected to the driver and
no module keeps state.  ``plans`` composes the operators into the extracts, ``jobs`` is the
command line around them.
"""
