"""Training-data operators: near-duplicates, scans, filters, packing, search.

One module per operator; ``queries`` registers them. Nothing outside this
subpackage (but ``__spark_entry__`` and ``corpus_pipeline``) imports it."""
