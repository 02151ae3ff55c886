"""gleaner: declarative data collection and warehouse analytics on Spark.

A collector spec names a source, a closed schema and a write strategy.  One
run expands the spec into a request plan (a DataFrame), fetches the responses
on executors, lands them, projects records into typed columns and writes them
into a versioned warehouse table.  Tables are queried with Spark SQL.
"""

from gleaner.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
