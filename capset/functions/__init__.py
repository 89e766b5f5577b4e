"""Column expressions."""

from capset.functions import geometry, hashing, ids, text, vectors  # noqa: F401
