"""Spark-native knowledge-graph analytics: ingestion, graph construction, graph
algorithms, retrieval and evaluation as DataFrame-to-DataFrame operators."""
