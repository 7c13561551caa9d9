"""kiln: feature preparation, data validation and model scoring as Spark jobs.

Sub-packages:

* ``sources``   – readers and writers (CSV, typed parse, labelled files, splits, schema, models)
* ``operators`` – DataFrame operators: position index, splits, profiles, schema, validation,
                  analyzers, metrics, model fits
* ``functions`` – column-expression builders (string parsing, text encodings, vectors)
* ``plans``     – end-to-end flows composed from the operators, and the fixture tables they use
* ``streaming`` – Structured Streaming twins of the incremental operators
"""

from kiln.session import get_spark, scratch_dir

__all__ = ["get_spark", "scratch_dir"]
