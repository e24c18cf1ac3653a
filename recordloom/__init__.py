"""recordloom: typed career records out of decoded, form-like documents, on Spark.

Every operator is a ``DataFrame -> DataFrame`` function (or a column expression)
with column-name parameters; nothing here runs Python per row or per document.
"""

__version__ = "0.1.0"
