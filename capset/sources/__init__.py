"""Readers: manifests, annotation tables, file trees, tar shards and TFRecord files."""
