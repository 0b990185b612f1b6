"""Training-data operators: sharding, filters, dedup, packing, archives, codecs.

Nothing else in the package imports this subpackage; ``__spark_entry__`` adds
its queries when it is present.
"""
