"""loglens: web-server and application log analytics on PySpark.

Batch and Structured Streaming share one set of ``DataFrame -> DataFrame``
operators:

* ``loglens.sources``   Kafka / envelope-file / text-log readers, plus the
                        deterministic log-line recipe over the ``events`` table.
* ``loglens.functions`` column-expression builders (log parsing, user-agent
                        rules, event-time parsing) - all JVM-side built-ins.
* ``loglens.operators`` parse, metrics, alerts and dashboard operators.
* ``loglens.streaming`` sinks, the availableNow runner and the long-running jobs.
* ``loglens.plans``     the registered query set and its DuckDB oracle twins.
"""

__version__ = "0.1.0"
