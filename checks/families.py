"""Importing this module registers every query."""

from checks import access, files, governance, inventory, lineage, migration, report, rollback, urls, verify  # noqa: F401
