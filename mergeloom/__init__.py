"""Spark-native corpus, byte-pair tokenizer, token-shard and run-log analytics."""
