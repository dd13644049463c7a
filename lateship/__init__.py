"""Late-delivery analytics as composable Spark DataFrame functions.

Subpackages:

* ``sources``   -- file, stream and model readers
* ``sinks``     -- file, JDBC and document writers
* ``functions`` -- column expressions (distance, clamp, slug, date parsing)
* ``operators`` -- DataFrame -> DataFrame operators (profiling, cleaning,
  geo enrichment, statistics, features, evaluation)
* ``ml``        -- MLlib pipeline construction, training and scoring
* ``plans``     -- composed jobs, the query catalogue and its SQL oracle
* ``streaming`` -- the Structured Streaming scoring job
"""

__version__ = "0.1.0"
