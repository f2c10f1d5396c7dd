"""Readers and writers: form definitions, submissions, lookups, editions."""
