"""Readers, writers, feed and page flatteners, provider mappings, contracts."""
