"""terrace — multi-tenant layered (bronze / silver / gold) batch processing on Spark.

Plain DataFrame operators (``terrace.operators``), readers
(``terrace.sources``), column builders (``terrace.functions``), the layered
pipelines (``terrace.plans``) and a streaming ingest (``terrace.streaming``).
"""

__version__ = "0.1.0"
