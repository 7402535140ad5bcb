"""Operators of a training-data pipeline.

One module per operator.  ``queries`` registers the ``opN_*`` queries; nothing
outside this subpackage (and the registration in ``__spark_entry__``) imports
it.
"""
