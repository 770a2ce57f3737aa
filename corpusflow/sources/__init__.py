"""Readers and writers: domain corpora, metric logs, packed sequences."""
