"""prflow: code-collaboration data as Spark DataFrames.

Landed API pages in, typed document tables and list tables out; see README.md.
"""
