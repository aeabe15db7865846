"""Readers and writers: page text, delimited documents, wiki dumps, index tables."""
