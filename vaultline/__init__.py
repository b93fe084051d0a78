"""vaultline: metadata-driven ETL, Data Vault 2.0 loads, data-quality rules,
incremental loads and column lineage, all as Spark DataFrame jobs.

Layout:
  functions/  Column builders (hash keys, rule predicates, protection)
  operators/  DataFrame -> DataFrame transforms (mapping, joins, vault, DQ, ...)
  sources/    readers and writers
  plans/      metadata -> typed specs -> jobs; the registered queries
  streaming/  Structured Streaming variants of the loads
"""

__version__ = "0.1.0"
