"""sitelens: data-quality assessment of multi-site clinical data as Spark jobs.

Everything is composed from DataFrame operations. A check is described by rows of a
specification; rows that read the same table are evaluated together in one scan.
"""
