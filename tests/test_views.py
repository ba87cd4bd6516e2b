"""SQL over the registered views gives the same result as the DataFrame job."""

from periodix.catalog import plan_fact, world
from periodix.sources.views import register_views
from tests.conftest import SF_SMALL


def test_sql_over_views(spark):
    w = world(spark, SF_SMALL)
    mart = plan_fact(w)
    names = register_views(w, {"plan_fact_mart": mart})
    assert "raw_spider__gandoper" in names and "plan_fact_mart" in names
    via_sql = spark.sql("SELECT smr_type, count(*) AS n, round(sum(SMRFull)) AS s FROM plan_fact_mart GROUP BY smr_type")
    via_df = mart.groupBy("smr_type").count()
    assert {r.smr_type: r.n for r in via_sql.collect()} == {r.smr_type: r["count"] for r in via_df.collect()}
    assert spark.sql("SELECT count(*) FROM raw_spider__gandoper WHERE project_type = 'проект'").first()[0] > 0
