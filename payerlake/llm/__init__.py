"""Training-data operators: filters, tokenizers, deduplication and scoring over text tables.

Nothing else in the library imports this subpackage; ``__spark_entry__`` adds its queries
when it is present.
"""
