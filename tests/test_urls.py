import pytest
from pyspark.sql import functions as F

from estate.functions import text, urls


def parsed(values, parse, inputs):
    return [None if u is None else (u.account, u.container, u.path) for u in values(parse, inputs)]


def test_abfss(values):
    assert parsed(
        values,
        urls.parse_abfss_url,
        ["abfss://c@MyAcct.dfs.core.windows.net/a/B", "ABFSS://C@acct.DFS.core.windows.net", "s3://bucket/x", "", None, "abfss://@a.dfs.core.windows.net/"],
    ) == [("myacct", "c", "a/B"), ("acct", "C", ""), None, None, None, None]


def test_s3(values):
    assert parsed(
        values, urls.parse_s3_url, ["s3://MyBucket/Key", "s3a://abc/", "s3n://abc", "s3://ab/x", "s3://a_b/x", "s3x://abc/x", None]
    ) == [("mybucket", "", "Key"), ("abc", "", ""), ("abc", "", ""), None, None, None, None]


def test_either_form(values):
    got = values(urls.parse_storage_url, ["abfss://c@a.dfs.core.windows.net/p", "S3A://abc/p", "file:/x", ""])
    assert [u and (u.scheme, u.account, u.container, u.path) for u in got] == [("abfss", "a", "c", "p"), ("s3", "abc", "", "p"), None, None]


def test_account_class(values):
    assert values(lambda c: urls.account_class(c, old="OldAcct", new="newacct"), ["oldacct", "NEWACCT", "x", None]) == ["old", "new", "other", "unknown"]
    assert values(lambda c: urls.account_class(c, old="same", new="same"), ["same"]) == ["old"]


def test_url_class_by_prefix(values):
    cls = lambda c: urls.url_class(c, old="Bkt/Old/", new="bkt/new")
    assert values(cls, ["s3://bkt/old", "s3a://BKT/OLD/t", "s3://bkt/older/t", "s3://bkt/new/", "s3://bkt", "file:/x", "", None]) == [
        "old", "old", "other", "new", "other", "unknown", "unknown", "unknown"]
    abfss = lambda c: urls.url_class(c, old="acct/box/old", new="acct/box/new")
    assert values(abfss, ["abfss://Box@acct.dfs.core.windows.net/old/t", "abfss://box@acct.dfs.core.windows.net/New", "abfss://box@acct.dfs.core.windows.net"]) == ["old", "new", "other"]


def test_prefix_old_is_tested_first(values):
    cls = lambda c: urls.url_class(c, old="bkt/a", new="bkt/a/b")
    assert values(cls, ["s3://bkt/a/b/t"]) == ["old"]


def test_on_account(values):
    assert values(lambda c: urls.is_on_account(c, "NewAcct"), ["s3://newacct/t", "abfss://c@newacct.dfs.core.windows.net", "s3://old/t", "", None]) == [True, True, False, False, False]
    assert values(lambda c: urls.is_on_account(c, "bkt/new"), ["s3://bkt/new/t", "s3://bkt/newer", None]) == [True, False, False]


@pytest.mark.parametrize(
    "path, new, old, url, fails",
    [
        ("abfss://c@old.dfs.core.windows.net/a/B", "new", None, "abfss://c@new.dfs.core.windows.net/a/B", False),
        ("abfss://c@old.dfs.core.windows.net", "new", None, "abfss://c@new.dfs.core.windows.net", False),
        ("s3a://old/T/", "new", None, "s3://new/T/", False),
        ("s3://old", "new", None, "s3://new", False),
        ("https://x/y", "new", None, None, True),
        (None, "new", None, None, True),
        ("s3://bkt/old/Tail/", "bkt/new/", "Bkt/Old", "s3://bkt/new/Tail", False),
        ("s3://bkt/OLD", "bkt/new", "bkt/old", "s3://bkt/new", False),
        ("s3://bkt/older", "bkt/new", "bkt/old", None, True),
        ("s3://bkt/old/t", "bkt/new", None, None, True),
        ("s3://bkt/old/t", "bkt/new", "bkt", None, True),
        ("abfss://c@old.dfs.core.windows.net/a", "bkt/new", "bkt/old", None, True),
    ],
)
def test_rewrite(spark, path, new, old, url, fails):
    row = urls.attach_moved_url(spark.createDataFrame([(path,)], "p string"), "p", new=new, old=old).first()
    assert (row.moved.url, row.moved.error is not None) == (url, fails)


def test_first_url_cell(spark):
    rows = spark.createDataFrame([("x", "s3://abc/1", "s3://abc/2"), (None, "S3://abc", "y")], "a string, b string, c string")
    assert [r[0] for r in rows.select(urls.first_url_cell(F.col("a"), F.col("b"), F.col("c"))).collect()] == ["s3://abc/1", None]


def test_quotes(spark):
    row = spark.createDataFrame([("c", "s`x", "t")], "a string, b string, n string").select(text.quote_name("a", "b", "n").alias("q")).first()
    assert row.q == "`c`.`s``x`.`t`"


def test_list_cell(values):
    assert values(text.list_cell, [" a, b ,,c ", "", None]) == [["a", "b", "c"], [], []]


def test_credential_type(values):
    assert values(text.credential_type, ['{"aws_iam_role": null}', '{"gcp_service_account_key": 1, "azure_managed_identity": 2}', "{}"]) == [
        "aws_iam_role", "azure_managed_identity", "unknown"]
