"""Stand-off document annotation on PySpark.

Documents go in as ``(doc_id, text)`` rows, annotation layers come out as long
tables of half-open spans counted in code points.
"""
