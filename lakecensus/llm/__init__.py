"""Training-data operators: ten dealt methods, one module each, plus their queries and SQL.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
