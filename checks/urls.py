"""Column expressions over storage URLs and names."""

from pyspark.sql import functions as F

from checks.registry import ABFSS_RE, S3_RE, account, class_by_account, part, path_text, query, quoted, under
from estate.functions import text, urls
from estate.sources import listings

PREFIX_OLD, PREFIX_NEW = "Shared/Old", "shared/new/"


def _parsed(inputs, parse):
    return inputs("urls").select("k", parse(F.col("url")).alias("u")).select("k", "u.scheme", "u.account", "u.container", "u.path")


_ABFSS = f"{part('url', ABFSS_RE, 2)} <> ''"
_S3 = f"{part('url', S3_RE, 1)} <> ''"


@query(
    "parse_abfss_url",
    f"""SELECT k, CASE WHEN {_ABFSS} THEN 'abfss' END AS scheme, CASE WHEN {_ABFSS} THEN lower({part('url', ABFSS_RE, 2)}) END AS account,
  CASE WHEN {_ABFSS} THEN {part('url', ABFSS_RE, 1)} END AS container, CASE WHEN {_ABFSS} THEN {part('url', ABFSS_RE, 4)} END AS path FROM {{urls}}""",
)
def _(inputs):
    return _parsed(inputs, urls.parse_abfss_url)


@query(
    "parse_s3_url",
    f"""SELECT k, CASE WHEN {_S3} THEN 's3' END AS scheme, CASE WHEN {_S3} THEN lower({part('url', S3_RE, 1)}) END AS account,
  CASE WHEN {_S3} THEN '' END AS container, CASE WHEN {_S3} THEN {part('url', S3_RE, 3)} END AS path FROM {{urls}}""",
)
def _(inputs):
    return _parsed(inputs, urls.parse_s3_url)


@query(
    "parse_storage_url",
    f"""SELECT k, CASE WHEN {_ABFSS} THEN 'abfss' WHEN {_S3} THEN 's3' END AS scheme, {account('url')} AS account,
  CASE WHEN {_ABFSS} THEN {part('url', ABFSS_RE, 1)} WHEN {_S3} THEN '' END AS container,
  CASE WHEN {_ABFSS} THEN {part('url', ABFSS_RE, 4)} WHEN {_S3} THEN {part('url', S3_RE, 3)} END AS path FROM {{urls}}""",
)
def _(inputs):
    return _parsed(inputs, urls.parse_storage_url)


@query(
    "classify_account",
    """SELECT o_orderkey AS k, CASE o_orderkey % 5 WHEN 0 THEN 'unknown' WHEN 1 THEN 'old' WHEN 2 THEN 'new' WHEN 3 THEN 'old' ELSE 'other' END AS account_class FROM {orders}""",
)
def _(inputs):
    named = F.element_at(F.array(*[F.lit(n) for n in (None, "OldAcct", "newacct", "oldacct", "third")]), (F.col("o_orderkey") % 5 + 1).cast("int"))
    return inputs("orders").select(
        F.col("o_orderkey").alias("k"), urls.account_class(named, old="OLDACCT", new="newacct").alias("account_class")
    )


@query(
    "classify_url",
    f"""SELECT k, {class_by_account('url')} AS by_account,
  CASE WHEN {account('url')} IS NULL THEN 'unknown' WHEN {under(f"lower({path_text('url')})", 'shared/old')} THEN 'old'
       WHEN {under(f"lower({path_text('url')})", 'shared/new')} THEN 'new' ELSE 'other' END AS by_prefix FROM {{urls}}""",
)
def _(inputs):
    return inputs("urls").select(
        "k",
        urls.url_class(F.col("url"), old="OldAcct", new="newacct").alias("by_account"),
        urls.url_class(F.col("url"), old=PREFIX_OLD, new=PREFIX_NEW).alias("by_prefix"),
    )


@query(
    "is_on_account",
    f"""SELECT k, coalesce({account('url')} = 'newacct', FALSE) AS on_account,
  coalesce({under(f"lower({path_text('url')})", 'shared/new')}, FALSE) AS on_prefix FROM {{urls}}""",
)
def _(inputs):
    return inputs("urls").select(
        "k", urls.is_on_account(F.col("url"), "NewAcct").alias("on_account"), urls.is_on_account(F.col("url"), PREFIX_NEW).alias("on_prefix")
    )


_TEXT = path_text("url")
_TAIL = lambda path: f"CASE WHEN {path} = '' THEN '' ELSE '/' || {path} END"


@query(
    "rewrite_account_in_path",
    f"""SELECT k,
  CASE WHEN {_ABFSS} THEN 'abfss://' || {part('url', ABFSS_RE, 1)} || '@target.dfs.core.windows.net' || {_TAIL(part('url', ABFSS_RE, 4))}
       WHEN {_S3} THEN 's3://target' || {_TAIL(part('url', S3_RE, 3))} END AS moved,
  {account('url')} IS NULL AS failed,
  CASE WHEN NOT coalesce({_S3}, FALSE) THEN NULL WHEN lower({_TEXT}) = 'shared/old' THEN 's3://shared/new'
       WHEN starts_with(lower({_TEXT}), 'shared/old/') THEN 's3://shared/new/' || substr({_TEXT}, 12) END AS moved_prefix,
  NOT coalesce({_S3} AND {under(f'lower({_TEXT})', 'shared/old')}, FALSE) AS failed_prefix FROM {{urls}}""",
)
def _(inputs):
    rows = urls.attach_moved_url(inputs("urls"), "url", new="target", into="plain")
    rows = urls.attach_moved_url(rows, "url", new=PREFIX_NEW, old=PREFIX_OLD, into="prefix")
    return rows.select(
        "k",
        F.col("plain.url").alias("moved"),
        F.col("plain.error").isNotNull().alias("failed"),
        F.col("prefix.url").alias("moved_prefix"),
        F.col("prefix.error").isNotNull().alias("failed_prefix"),
    )


@query(
    "hosts_in_paths",
    f"SELECT DISTINCT schema, {account('storage_path')} AS account FROM {{objects}} WHERE {account('storage_path')} IS NOT NULL",
)
def _(inputs):
    return listings.hosts_in_paths(inputs("objects"), "storage_path", by=["schema"])


@query(
    "first_url_cell",
    """SELECT k, CASE WHEN regexp_matches(url, '^(abfss|s3|s3a|s3n)://') THEN url ELSE storage_path END AS url
FROM (SELECT u.k, u.url, o.storage_path FROM {urls} u JOIN {objects} o ON o.k = u.k)
WHERE regexp_matches(url, '^(abfss|s3|s3a|s3n)://') OR regexp_matches(storage_path, '^(abfss|s3|s3a|s3n)://')""",
)
def _(inputs):
    paths = inputs("objects").select("k", "storage_path")
    rows = inputs("urls").withColumnRenamed("url", "first").join(paths, "k")
    return listings.url_cells(rows, ["first", "storage_path"]).select("k", "url")


@query(
    "quote_identifiers",
    """SELECT k, '`' || replace(odd, '`', '``') || '`' AS quoted, """ + quoted("catalog", "schema", "odd") + """ AS full_name
FROM (SELECT k, catalog, schema, CASE WHEN k % 3 = 0 THEN 'we`ird``' || k ELSE name END AS odd FROM {objects})""",
)
def _(inputs):
    odd = F.when(F.col("k") % 3 == 0, F.concat(F.lit("we`ird``"), F.col("k"))).otherwise(F.col("name"))
    return inputs("objects").select(
        "k", text.quote_ident(odd).alias("quoted"), text.quote_name("catalog", "schema", odd).alias("full_name")
    )


_LOCATIONS = """SELECT catalog, schema, name, object_type, arg_min(trim(data_type), pos) AS location FROM {described}
WHERE col_name = 'Location' AND trim(data_type) <> '' AND pos > 4 GROUP BY ALL"""


@query("described_location", _LOCATIONS)
def _(inputs):
    return listings.described_locations(inputs("described"))


@query(
    "resolve_storage_path",
    f"""SELECT o.k, coalesce(nullif(o.storage_path, ''), d.location) AS storage_path
FROM {{objects}} o LEFT JOIN ({_LOCATIONS}) d ON o.catalog = d.catalog AND o.schema = d.schema AND o.name = d.name AND o.object_type = d.object_type""",
)
def _(inputs):
    return listings.resolve_storage_paths(inputs("objects"), inputs("described")).select("k", "storage_path")


@query(
    "utc_timestamps",
    """SELECT event_id, CASE event_id % 3 WHEN 1 THEN ts - INTERVAL 2 HOUR WHEN 2 THEN ts + INTERVAL 330 MINUTE ELSE ts END AS utc FROM {events}""",
)
def _(inputs):
    zone = F.when(F.col("event_id") % 3 == 1, "+02:00").when(F.col("event_id") % 3 == 2, "-05:30")
    return inputs("events").select("event_id", text.to_utc(F.col("ts"), zone).cast("timestamp_ntz").alias("utc"))


@query(
    "credential_type",
    """SELECT s_suppkey, CASE s_suppkey % 7 WHEN 0 THEN 'azure_managed_identity' WHEN 1 THEN 'aws_iam_role' WHEN 2 THEN 'azure_service_principal'
  WHEN 3 THEN 'azure_access_connector' WHEN 4 THEN 'gcp_service_account_key' WHEN 5 THEN 'azure_managed_identity' ELSE 'unknown' END AS credential_type FROM {supplier}""",
)
def _(inputs):
    bodies = [
        '{"azure_managed_identity": {"id": 1}}',
        '{"name": "x", "aws_iam_role": {"arn": "y"}}',
        '{"azure_service_principal": null}',
        '{"aws_iam_role": {}, "azure_access_connector": {}}',
        '{"gcp_service_account_key": "k"}',
        '{"aws_iam_role": 1, "azure_managed_identity": 2}',
        '{"name": "azure_managed_identity"}',
    ]
    body = F.element_at(F.array(*[F.lit(b) for b in bodies]), (F.col("s_suppkey") % 7 + 1).cast("int"))
    return inputs("supplier").select("s_suppkey", text.credential_type(body).alias("credential_type"))
