from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.operators import products
from clickloom.plans.area_products import area_top_products
from clickloom.sources.tasks import JobParams


def cities(spark):
    rows = [(1, "Rome", "China North"), (2, "Oslo", "China North"), (3, "Lima", "West South"), (4, "Bonn", "Elsewhere")]
    return spark.createDataFrame(rows, schemas.CITY_INFO)


def catalogue(spark):
    rows = [(i, f"p{i}", '{"product_status": %d}' % (i % 2)) for i in range(1, 6)] + [(6, "p6", None), (7, "p7", "{")]
    return spark.createDataFrame(rows, schemas.PRODUCT_INFO)


def clicks(make_actions):
    listed = [(1, 1)] * 3 + [(2, 1)] * 2 + [(1, 2)] * 4 + [(2, 3)] * 4 + [(1, 4)] + [(1, 99)] * 9
    listed += [(3, 5), (4, 6), (77, 1), (None, 1)]
    return make_actions(*[{"city_id": c, "click_product_id": p} for c, p in listed], {"city_id": 1})


def test_area_levels(spark):
    areas = ["China North", "China East", "China South", "China Middle", "West North", "West South", "Moon", None]
    df = spark.createDataFrame([(a,) for a in areas], "area string").select(products.area_level(F.col("area")))
    assert [r[0][0] for r in df.collect()] == list("AABBCCDD")


def test_status_defaults_to_third_party(spark):
    rows = catalogue(spark).select("product_id", products.product_status(F.col("extend_info"))).collect()
    assert {r[0] for r in rows if r[1] == "Self"} == {2, 4}


def test_top_products(spark, make_actions):
    result = area_top_products(clicks(make_actions), cities(spark), catalogue(spark)).collect()
    north = sorted((r for r in result if r.area == "China North"), key=lambda r: (-r.click_count, r.product_id))
    # product 99 is unknown; 2 and 3 tie and the smaller id comes first
    assert [(r.product_id, r.click_count, r.city_infos) for r in north] == [
        (1, 5, "1:Rome,2:Oslo"), (2, 4, "1:Rome"), (3, 4, "2:Oslo")]
    others = {(r.area, r.area_level, r.product_id, r.product_status) for r in result if r.area != "China North"}
    assert others == {("West South", "C Level", 5, "Third Party"), ("Elsewhere", "D Level", 6, "Third Party")}
    assert {r.area_level for r in north} == {"A Level"}


def test_top_products_with_too_many_cities_to_broadcast(spark, make_actions, shuffle_only):
    args = clicks(make_actions), cities(spark), catalogue(spark)
    want = sorted(map(repr, area_top_products(*args).collect()))
    shuffle_only()
    assert sorted(map(repr, area_top_products(*args).collect())) == want


def test_date_range(spark, make_actions):
    params = JobParams(start_date="2024-04-01", end_date="2024-04-30")
    assert area_top_products(clicks(make_actions), cities(spark), catalogue(spark), params).count() == 0


def test_scan_and_count_happen_once(spark, make_actions):
    from clickloom.session import shared_table

    stored = shared_table(clicks(make_actions), "clicks")
    result = area_top_products(stored, cities(spark), catalogue(spark))
    result.collect()
    plan = result._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in plan and "ReadSchema: struct<click_product_id:bigint,city_id:bigint>" in plan
