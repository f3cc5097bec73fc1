"""marginalia: commerce & marketing analytics as Spark DataFrame operators.

Every operator is a function ``DataFrame(s) -> DataFrame`` built from Spark's
own expressions, windows and joins, so Catalyst plans it end to end and the
work stays on the executors.  Packages:

* ``functions``  column helpers shared by all operators (safe ratios, week and
  month arithmetic, rounding casts, URL/UTM parsing ...)
* ``sources``    readers for landed files, flatteners, merge/replace sinks and
  the mapping of the bench tables onto the roles the operators consume
* ``operators``  the analytics: commerce, finance, marketing, seo, n-grams,
  serving patterns, run log and data-quality checks
* ``plans``      named queries (operator + inputs) and their SQL oracle text
* ``streaming``  incremental ingestion with Structured Streaming
"""

from marginalia.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
