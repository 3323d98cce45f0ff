"""Readers: file trees, nested documents, templated staging, snapshots."""
