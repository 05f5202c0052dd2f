"""DataFrame operators: inventory, report, lineage, access, governance, files, verification, state."""
