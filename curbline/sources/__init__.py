"""Readers, sinks and the views that map generic event tables onto the data model."""
