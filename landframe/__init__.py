"""landframe: public-sector data preparation as Spark DataFrame operators.

Modules
-------
``landframe.functions``   column -> column text, number, date and geodesy functions
``landframe.operators``   DataFrame operators: columns, filters, joins, aggregate,
                          window-like, reshape, set operations, spatial, quality checks
``landframe.sources``     readers/writers (delimited, XML, tables), release gate, page
                          and text extraction, fixed input layouts
``landframe.streaming``   incremental ingest on Structured Streaming
``landframe.plans``       end-to-end jobs (``pipelines``) and the registered queries
``landframe.session``     session settings and the shared checkpoint folder

Every operator takes and returns lazy DataFrames built from native Spark expressions.
"""

__version__ = "0.1.0"
