"""Registered queries over the driver tables, each with its DuckDB oracle SQL where one exists."""

from capset.plans.registry import ORACLES, QUERIES, load  # noqa: F401
from capset.plans import formats, manifest, labels, files, scoring, selection, vocab, shards, streams, records, images, outputs  # noqa: F401,E402
