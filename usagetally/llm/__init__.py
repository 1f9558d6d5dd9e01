"""Training-data operators: language, near duplicates, licences, fingerprints,
token counts, pieces, chat rendering, source mixing, quality, toxicity.

Nothing outside this subpackage imports it (but for ``corpus_pipeline.py`` and
the guarded registration in ``__spark_entry__.py``).
"""
