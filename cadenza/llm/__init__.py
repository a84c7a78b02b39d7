"""Training-data pipeline operators over a table of documents.

Nothing else in the library imports this subpackage. ``queries`` registers
one ``opN_<name>`` query per operator; ``corpus_pipeline.py`` at the
repository top chains five of them.
"""
