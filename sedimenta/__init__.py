"""Spark-native building blocks for layered lakehouse pipelines and star schemas.

Every public function takes DataFrames (or paths and a session, in ``sources``)
and returns a lazy DataFrame. Only ``sources.sinks`` and ``plans.runs`` write.
"""

__version__ = "0.1.0"
