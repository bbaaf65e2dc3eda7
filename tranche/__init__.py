"""tranche: loan-portfolio credit-risk analytics as lazy Spark plans.

Every public operator takes and returns a DataFrame (or a small fitted
object whose ``transform`` is a DataFrame -> DataFrame), so a whole run is
one Catalyst plan per stage output and scales with the cluster.
"""

__version__ = "0.1.0"
