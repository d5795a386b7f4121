"""Training-data operators: each module is one operator of the corpus pipeline.

Nothing else in the library imports this subpackage.
"""
