"""Readers and writers: quarterly archives, manifests, partition replacement."""
