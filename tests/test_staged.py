import pytest

from estate.plans import migration


def test_the_layout_survives(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS st_live")
    spark.sql(
        f"""CREATE TABLE st_live (a INT COMMENT 'the a', b STRING, p INT) USING orc PARTITIONED BY (p) COMMENT "it's"
        TBLPROPERTIES ('team' = "x'y") LOCATION '{tmp_path}/live'"""
    )
    spark.sql("INSERT INTO st_live VALUES (1, 'x', 1), (2, NULL, 2)")
    try:
        row = migration.staged_rewrite(spark, "st_live", shadow="st_shadow", staging="st_staging", location=f"{tmp_path}/new").first()
        assert row.match and row.row_count_ok and row.schema_ok
        kind, partitions, properties = migration._layout(spark, "st_live")
        assert (kind.lower(), partitions, properties["team"]) == ("orc", ["p"], "x'y")
        described = {r.col_name: r for r in spark.sql("DESCRIBE TABLE EXTENDED st_live").collect()}
        assert described["a"].comment == "the a" and described["Comment"].data_type == "it's"
        assert spark.table("st_shadow").count() == 2 and not spark.catalog.tableExists("st_staging")
        with pytest.raises(ValueError):
            migration.staged_rewrite(spark, "st_live", shadow="st_shadow", staging="st_staging")
    finally:
        for name in ("st_live", "st_shadow", "st_staging"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
