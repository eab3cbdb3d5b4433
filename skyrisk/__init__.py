"""skyrisk: weather-risk analytics expressed as Spark DataFrame, Structured
Streaming and MLlib jobs.

Every operator is a ``DataFrame -> DataFrame`` function.  Modules:

* ``sources``   – table, topic, file and generator sources
* ``sinks``     – topic, CSV, JSON, JDBC and model sinks
* ``functions`` – column expressions (risk rules, time parsing, hashing)
* ``operators`` – parse, clean, window statistics, serving queries, ML
* ``streaming`` – streaming jobs, watermark emission, change push, progress
* ``plans``     – the named query catalogue used by ``__spark_entry__``
"""

__version__ = "0.1.0"
