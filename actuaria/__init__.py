"""actuaria — property-and-casualty portfolio analytics as Spark DataFrame jobs.

Layers (each a plain function ``DataFrame -> DataFrame``):

* ``sources``   raw tables (from the driver's parquet tables), loaders, CSV readers, writers
* ``functions`` actuarial Column functions: ratios, bands, flags, rounding, formatting
* ``operators`` staging, intermediate and mart models, accidents, dashboard, quality checks
* ``plans``     the whole pipeline, the query registry and the SQL oracle text
* ``streaming`` incremental file ingestion into the staging layer
"""

__version__ = "0.1.0"
