"""featurejudge: outcome-feature assembly and model evaluation as Spark jobs.

Every public function takes DataFrames (or Columns) and returns DataFrames
(or Columns).  Nothing row-sized is collected to the driver; the only values
that cross to the driver are bounded ones (vocabularies, per-column
statistics, class lists, quantile split points, model objects).
"""

__all__ = ["session"]
