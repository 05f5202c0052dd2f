"""Storage-URL column expressions: parse, classify, rewrite.

``old`` and ``new`` are driver-side literals. A name without ``/`` is a bare account or bucket;
with ``/`` it is a prefix (``bucket/path`` or ``account/container/path``).

Catalyst copies an expression into every filter that uses its result, so each expression here
names its URL as few times as it can: the two forms exclude each other and a pattern that does not
match gives '', so the parts of both are concatenated instead of chosen by a condition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The two URL formats.
ABFSS = r"(?i)^abfss://([^@]+)@([^.]+)\.dfs\.core\.windows\.net(?:/(.*))?$"
S3 = r"(?i)^s3[an]?://([a-z0-9][a-z0-9.-]{1,61}[a-z0-9])(?:/(.*))?$"
URL_START = r"^(?:abfss|s3|s3a|s3n)://"


def _abfss(url: Column, group: int) -> Column:
    return F.regexp_extract(url, ABFSS, group)


def _s3(url: Column, group: int) -> Column:
    return F.regexp_extract(url, S3, group)


def _strip_slashes(text: Column) -> Column:
    return F.rtrim(text, F.lit("/"))


def account_text(url: Column) -> Column:
    """Account or bucket in lower case, '' when the URL is neither form, null for null."""
    return F.lower(F.concat(_abfss(url, 2), _s3(url, 1)))


def storage_account(url: Column) -> Column:
    """Account or bucket, the unit that moves; null when the URL is neither form."""
    return F.nullif(account_text(url), F.lit(""))


def _parts(scheme: Column, account: Column, container: Column, path: Column) -> Column:
    parts = F.struct(scheme.alias("scheme"), account.alias("account"), container.alias("container"), path.alias("path"))
    return F.when(account != "", parts)


def parse_abfss_url(url: Column) -> Column:
    return _parts(F.lit("abfss"), F.lower(_abfss(url, 2)), _abfss(url, 1), _abfss(url, 3))


def parse_s3_url(url: Column) -> Column:
    return _parts(F.lit("s3"), F.lower(_s3(url, 1)), F.lit(""), _s3(url, 2))


def parse_storage_url(url: Column) -> Column:
    """Struct ``(scheme, account, container, path)`` of either form, else null."""
    scheme = F.when(F.lower(F.substring(url, 1, 1)) == "a", "abfss").otherwise("s3")
    return _parts(scheme, account_text(url), _abfss(url, 1), F.concat(_abfss(url, 3), _s3(url, 2)))


def account_class(account: Column, *, old: str, new: str) -> Column:
    """``old``, ``new``, ``other``, or ``unknown`` for null; ``old`` wins when both are the same."""
    known = {new.lower(): "new", old.lower(): "old"}
    return F.when(account.isNull(), "unknown").otherwise(_looked_up(F.lower(account), known, "other"))


def _looked_up(text: Column, table: dict[str, str], default: str) -> Column:
    pairs = F.create_map(*[F.lit(cell) for pair in table.items() for cell in pair])
    return F.coalesce(F.try_element_at(pairs, text), F.lit(default))


def is_prefix_mode(old: str, new: str) -> bool:
    return "/" in old or "/" in new


def location_text(url: Column) -> Column:
    """``account/container/path`` or ``bucket/path`` without trailing slashes; the tail keeps its case."""
    folder = F.regexp_replace(F.concat(_abfss(url, 1), F.lit("/")), "^/$", "")
    return _strip_slashes(F.concat(storage_account(url), F.lit("/"), folder, _abfss(url, 3), _s3(url, 2)))


def _under(text: Column, prefix: str) -> Column:
    root = prefix.lower().rstrip("/")
    return F.concat(text, F.lit("/")).startswith(root + "/")


def url_class(url: Column, *, old: str, new: str) -> Column:
    """Class of a URL: by account, or by path prefix when ``old`` or ``new`` is a prefix."""
    if not is_prefix_mode(old, new):
        known = {"": "unknown", new.lower(): "new", old.lower(): "old"}
        return _looked_up(F.coalesce(account_text(url), F.lit("")), known, "other")
    text = F.lower(location_text(url))
    return (
        F.when(_under(text, old), "old").when(_under(text, new), "new").when(text.isNull(), "unknown").otherwise("other")
    )


def is_on_account(url: Column, expected: str) -> Column:
    """True when the URL lies on the expected account or prefix; never null."""
    found = _under(F.lower(location_text(url)), expected) if "/" in expected else account_text(url) == expected.lower()
    return F.coalesce(found, F.lit(False))


def moved_url(parsed: Column, *, new: str, old: str | None = None) -> Column:
    """Struct ``(url, error)``: a parsed URL moved to ``new``, or why it could not be moved.

    S3 schemes become ``s3://``. With a prefix as ``new``, ``old`` must be a prefix too; it is
    stripped from the front, ignoring case, while the rest keeps its case.
    """
    in_abfss, path = parsed["scheme"] == "abfss", parsed["path"]
    if "/" not in new:
        root = F.when(
            in_abfss, F.concat(F.lit("abfss://"), parsed["container"], F.lit(f"@{new}.dfs.core.windows.net"))
        ).otherwise(F.lit(f"s3://{new}"))
        url = F.concat(root, F.when(path == "", "").otherwise(F.concat(F.lit("/"), path)))
        fault = F.lit(None).cast("string")
    elif old is None or "/" not in old:
        url, fault = F.lit(None).cast("string"), F.lit("prefix rewrite needs an old prefix")
    else:
        prefix, target = old.lower().rstrip("/"), new.rstrip("/")
        text = _strip_slashes(F.concat_ws("/", parsed["account"], path))
        tail = F.substring(text, F.lit(len(prefix) + 1), F.length(text))
        fits = ~in_abfss & _under(F.lower(text), old)
        url = F.when(fits, F.concat(F.lit(f"s3://{target}"), tail))
        fault = F.when(in_abfss, "abfss urls have no prefix rewrite").when(~fits, "not under the old prefix")
    known = parsed.isNotNull()
    return F.struct(
        F.when(known, url).alias("url"), F.when(known, fault).otherwise(F.lit("not a storage url")).alias("error")
    )


def attach_moved_url(rows: DataFrame, path: str, *, new: str, old: str | None = None, into: str = "moved") -> DataFrame:
    """Adds ``moved_url`` of a URL column; the URL is parsed once, in a projection of its own."""
    parsed = rows.withColumn("_parsed", parse_storage_url(F.col(path)))
    return parsed.withColumn(into, moved_url(F.col("_parsed"), new=new, old=old)).drop("_parsed")


def first_url_cell(*cells: Column) -> Column:
    """The first cell, in column order, that starts like a storage URL."""
    return F.coalesce(*[F.when(c.rlike(URL_START), c) for c in cells])
