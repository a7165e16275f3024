"""ledgerlink: a Spark-native company registry.

Two noisy company lists go in; one keyed, versioned registry comes out.
Every step is a DataFrame -> DataFrame operator that Catalyst plans:

* ``sources``    CSV / parquet readers, the TPC-H-derived fixtures, the versioned registry store
* ``functions``  Column expressions (name cleaning, address normalisation, token-sort ratio)
* ``operators``  quality rules, entity linkage, harmonisation, upsert, reports, features, ML
* ``plans``      end-to-end jobs built from the operators
* ``streaming``  the same upsert driven by Structured Streaming micro-batches
"""

__version__ = "0.1.0"
