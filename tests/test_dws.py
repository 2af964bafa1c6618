"""Decisions of the daily aggregates that the derived test data cannot show."""

from parcelstream.operators import dws

ORGANS = [("c1", "Centre", None, "d1"), ("s1", "Station", "c1", "d1")]
REGIONS = [("d1", "City", "p1"), ("p1", "Province", None)]


def _dims(spark, organs):
    return (spark.createDataFrame(organs, "id string, org_name string, org_parent_id string, region_id string"),
            spark.createDataFrame(REGIONS, "id string, name string, parent_id string"))


def _facts(spark):
    day = 1_700_000_000_000
    rows = [("o1", "d1", "10.50", day), ("o1", "d1", "10.50", day + 1000), ("o2", "d1", "4.00", day)]
    df = spark.createDataFrame(rows, "order_id string, sender_district_id string, a string, ts long")
    return df.selectExpr("order_id", "sender_district_id", "cast(a as decimal(16,2)) amount", "ts")


def test_an_order_with_two_cargo_rows_counts_once(spark):
    organ, region = _dims(spark, ORGANS)
    r = dws.org_order_day(_facts(spark), organ, region).collect()
    assert [(x.org_id, x.order_count_base, str(x.order_amount_base)) for x in r] == [("c1", 2, "14.50")]


def test_two_centres_of_one_district_do_not_double_a_measure(spark):
    organ, region = _dims(spark, ORGANS + [("c2", "Other centre", None, "d1")])
    for make in (dws.org_order_day, dws.org_receive_day):
        r = make(_facts(spark), organ, region).collect()
        count = "order_count_base" if make is dws.org_order_day else "receive_order_count_base"
        assert [(x.org_id, x[count]) for x in r] == [("c1", 2)]
