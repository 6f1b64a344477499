"""Training-data operators: each module holds one operator, built by its named method.

Nothing outside this package imports it. ``queries.py`` registers the queries
``opN_<name>`` and the corpus pipeline.
"""
