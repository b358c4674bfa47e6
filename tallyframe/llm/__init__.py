"""Operators for building training data out of large text tables.

Nothing outside this folder imports it; the folder can be removed and the rest of the library keeps working.
"""
