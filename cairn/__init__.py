"""Spark-native catalog quality, entity resolution and sync-ledger engine."""
