"""Row operators: changes and merge, schema evolution, selection, reconciliation."""
