"""Operators of a training-data pipeline over documents, vectors and conversations.

Nothing else in the library imports this package. Its queries are in
``queries.py`` (with their SQL where SQL can state them) and the pipeline is
``corpus_pipeline.py`` at the top of the repository.
"""
