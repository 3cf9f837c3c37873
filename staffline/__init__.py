"""staffline: monthly workforce-returns analytics on Spark.

Modules: ``functions`` (column semantics), ``operators`` (DataFrame building
blocks), ``sources``/``streaming`` (inputs, ingest, sinks), ``plans`` (the
measures, the dashboard dataset and the whole monthly run), ``cli`` (run on
landed files), ``catalog``/``oracles`` (registered queries and their SQL).
"""

__version__ = "0.1.0"
