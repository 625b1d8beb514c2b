"""Readers and writers: topics, partitioned tables, and views over the supplied tables."""
