import pytest
from conftest import TESTDATA

from cityloom.gallery.registry import table
from cityloom.gallery.relations import income_rows, inner_join_chain, listing_rows

pytestmark = pytest.mark.skipif(not TESTDATA.exists(), reason="test tables not present")


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_every_order_of_a_nation_with_suppliers_finds_an_area(spark, scale):
    sf = str(TESTDATA / scale)
    nations = table(spark, sf, "supplier").selectExpr("s_nationkey AS c_nationkey").distinct()
    customers = table(spark, sf, "customer").join(nations, "c_nationkey").selectExpr("c_custkey AS o_custkey")
    of_nations = table(spark, sf, "orders").join(customers, "o_custkey").count()
    listings = listing_rows(spark, sf, fine=True)
    assert listings.count() == table(spark, sf, "orders").count()
    areas = income_rows(spark, sf, fine=True).select("neighborhood")
    assert areas.count() == areas.distinct().count() == table(spark, sf, "supplier").count()
    meeting = listings.join(areas, "neighborhood")
    assert meeting.count() == of_nations > 0
    sizes = sorted(r["count"] for r in meeting.groupBy("neighborhood").count().collect())
    # The hot area; the fewer suppliers a nation has, the less it stands out.
    assert sizes[-1] > 2 * sizes[len(sizes) // 2]


def test_the_chain_has_all_areas(spark):
    sf = str(TESTDATA / "sf0.01")
    joined = {r.neighborhood for r in inner_join_chain(spark, sf).select("neighborhood").distinct().collect()}
    met = listing_rows(spark, sf, fine=True).join(income_rows(spark, sf, fine=True), "neighborhood")
    assert joined == {r.neighborhood for r in met.select("neighborhood").distinct().collect()}
