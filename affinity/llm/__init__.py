"""Training-data operators: archives, filters, near-duplicates, mixing, token output.

Nothing else in the library imports this subpackage.  Every operator selects the
columns it needs by name first, so further columns of the input, whatever their
names, neither clash with its own nor reach its result.
"""
