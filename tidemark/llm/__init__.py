"""Training-data operators: dedup, mixing, scoring, filtering, language ID.

Nothing outside this package imports it; ``__spark_entry__`` registers its
queries only if it can be imported.
"""
