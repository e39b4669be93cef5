"""Writers.

Rows are clustered for the writer by ranges, never by one task per month: a month may hold
most of the data.
"""
