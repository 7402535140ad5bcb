"""Streaming.

The surveyed workflow reads every input once as a file; it has no stream,
watermark, window or stateful operator, so none is built here.  The Column
and DataFrame functions of this package that are stateless projections
(keyword flags, one-hot with a given vocabulary, thresholds, interactions,
lookups against a static table) apply unchanged to a DataFrame from
``spark.readStream``; ``tests/test_streaming.py`` checks that.
"""
