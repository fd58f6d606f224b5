"""Sources: raw shapes, file scans, load ledger and ingestion."""
