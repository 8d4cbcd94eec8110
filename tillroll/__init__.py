"""tillroll: retail customer analytics as Spark DataFrame jobs.

Every public function takes DataFrames (plus an explicit reference time
``as_of`` where time matters) and returns a lazy DataFrame.  Nothing is
collected to the driver; the physical plan is left to Catalyst/AQE.
"""

from tillroll.config import AS_OF

__all__ = ["AS_OF"]
