"""Operators of a training-data pipeline: tokens, packing, duplicates, filters and scans.

Every operator takes a DataFrame of documents and reads only the id and text columns it is told
of, so further columns, whatever their names, change nothing. A null text counts as empty.
"""
