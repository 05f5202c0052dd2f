"""Identifiers, literals, timestamps and small text rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# The JSON keys that name a credential's type, first present key wins.
CREDENTIAL_KEYS = [
    "azure_managed_identity",
    "azure_service_principal",
    "azure_access_connector",
    "aws_iam_role",
    "gcp_service_account_key",
]


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def quote_ident(name: Column | str) -> Column:
    return F.concat(F.lit("`"), F.replace(_column(name), F.lit("`"), F.lit("``")), F.lit("`"))


def quote_name(*parts: Column | str) -> Column:
    """Back-quoted parts joined by dots; null when a part is null."""
    quoted = [quote_ident(p) for p in parts]
    dotted = [quoted[0]]
    for part in quoted[1:]:
        dotted += [F.lit("."), part]
    return F.concat(*dotted)


def dotted_name(*parts: Column | str) -> Column:
    return F.concat_ws(".", *[_column(p) for p in parts])


def quote_literal(text: Column) -> Column:
    """A SQL string literal: backslashes are escape characters there, so they are doubled like quotes."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.concat(F.lit("'"), F.replace(doubled, F.lit("'"), F.lit("''")), F.lit("'"))


def list_cell(cell: Column, kind: T.DataType | None = None) -> Column:
    """Comma text, or a list if ``kind`` says so, to a list: trimmed, blanks dropped, null gives an empty list."""
    given = cell.cast("array<string>") if isinstance(kind, T.ArrayType) else F.split(cell, ",")
    parts = F.transform(given, lambda p: F.trim(p))
    return F.coalesce(F.filter(parts, lambda p: p != ""), F.array().cast("array<string>"))


def to_utc(ts: Column, zone: Column) -> Column:
    """Local time in ``zone`` to UTC; a row without a zone is UTC already."""
    return F.coalesce(F.to_utc_timestamp(ts, zone), ts.cast("timestamp"))


def credential_type(body: Column) -> Column:
    """Type of a credential from which of the known keys its JSON holds."""
    known = F.array(*[F.lit(k) for k in CREDENTIAL_KEYS])
    return F.coalesce(F.get(F.array_intersect(known, F.json_object_keys(body)), F.lit(0)), F.lit("unknown"))
