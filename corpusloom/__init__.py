"""Spark-native text-corpus analytics: cleaning, deduplication, ingestion, transcripts and language-model preparation."""
