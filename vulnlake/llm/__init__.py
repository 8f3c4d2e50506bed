"""Training-data operators: ten corpus-scale operators and the queries that bind them to the test tables.

Nothing outside this package imports it. Every operator takes and returns DataFrames; what must outlive a
lost executor is written to the shared folder of ``spark.checkpoint.dir`` and read back.
"""
