"""titlecorpus: a PySpark engine for paper corpora and abstract-to-title work.

Every operator is a ``DataFrame -> DataFrame`` function (chain with
``DataFrame.transform``) built from Spark SQL expressions, joins,
aggregations and windows, so Catalyst plans and runs the whole flow on
executors.
"""

from titlecorpus.session import get_session, shared_dir, work_path

__all__ = ["get_session", "shared_dir", "work_path"]
