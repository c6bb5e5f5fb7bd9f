"""skerry: gridded and station observations on Spark.

Everything is a ``DataFrame -> DataFrame`` function; sub-packages group them by
what they do.  ``skerry.llm`` is optional: nothing here imports it.
"""
