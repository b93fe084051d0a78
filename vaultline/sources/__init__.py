"""Readers and writers."""

from vaultline.sources.readers import as_view, register_sources, scan_csv, scan_glob, scan_table
from vaultline.sources.writers import (store_failures, write_append, write_checked, write_overwrite,
                                       write_partitioned, write_versioned)

__all__ = ["as_view", "register_sources", "scan_csv", "scan_glob", "scan_table", "store_failures",
           "write_append", "write_checked", "write_overwrite", "write_partitioned", "write_versioned"]
