"""Views from query files, and joins of tables kept in buckets."""

import pytest
from conftest import SF, rows

from tillflow.catalog.mechanisms import bucketed_by_invoice, invoice_chain
from tillflow.sources import readers, views
from tillflow.testbed.tables import ShopTables


def test_views_from_files_outlive_the_session(spark, tmp_path):
    (tmp_path / "b_total.sql").write_text("select sum(n) as n\nfrom a_small;\n")
    (tmp_path / "a_small.sql").write_text("select id as n from range(5)")
    (tmp_path / "c_none.sql").write_text("select n from b_total where n > 100")
    (tmp_path / "notes.txt").write_text("no query")
    assert views.create_views_from(spark, str(tmp_path)) == ["a_small", "b_total", "c_none"]
    other = spark.newSession()
    assert views.read_view(other, "b_total").first().n == 10 and views.read_view(other, "c_none").count() == 0
    # a changed file replaces its view; what builds on it follows
    (tmp_path / "a_small.sql").write_text("select id as n from range(50)")
    views.create_views_from(spark, str(tmp_path))
    assert views.read_view(other, "c_none").first().n == 1225
    for name in ("c_none", "b_total", "a_small"):
        spark.sql(f"drop view default.{name}")


def test_wrong_sets_of_views(spark, tmp_path):
    with pytest.raises(ValueError, match="circle"):
        views.in_order({"a": "select * from b", "b": "select * from a", "c": "select 1"})
    (tmp_path / "no name.sql").write_text("select 1")
    with pytest.raises(ValueError, match="no name"):
        views.query_files(spark, str(tmp_path))


def test_query_file_from_any_storage(spark, tmp_path):
    (tmp_path / "q.sql").write_text("select n\nfrom {t}\nwhere n >= :least")
    found = readers.run_query_file(spark, f"file://{tmp_path}/q.sql", {"least": 3}, t=spark.range(5).withColumnRenamed("id", "n"))
    assert rows(found) == [(3,), (4,)]
    with pytest.raises(Exception):  # noqa: B017
        readers.run_query_file(spark, str(tmp_path / "none.sql"))


def test_bucketed_chain_moves_no_side(spark):
    session = spark.newSession()
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        session.conf.set(key, "-1")
    chain = invoice_chain(*bucketed_by_invoice(ShopTables(session, SF)))
    plan = chain._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan and "Bucketed: true" in plan
    assert chain.count() > 0
