"""capset: Spark-native operators for building captioned-image datasets.

Everything is DataFrame in / DataFrame out.  Sub-packages:

* ``capset.sources``   – readers (manifests, file trees, tar shards, TFRecord)
* ``capset.functions`` – Column expressions (caption clean-up, ids, geometry, vectors)
* ``capset.operators`` – relational operators (resume, pairing, labels, dedup, scoring, vocabulary)
* ``capset.plans``     – the registered queries over the driver tables and their SQL oracles
* ``capset.streaming`` – incremental ingestion with Structured Streaming
"""

__version__ = "0.1.0"
