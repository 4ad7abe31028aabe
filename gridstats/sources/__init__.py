"""Readers and writers: wide CSV, JSON documents, topics, tables."""
