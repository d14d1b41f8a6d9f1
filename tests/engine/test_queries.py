"""Registered queries take part with every row of their tables."""

import pytest
from pyspark.sql import functions as F

from climbout.plans.catalog import QUERIES
from tests.engine.test_operators import nm


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    k = F.col("id")
    spark.range(1, 401).select(k.alias("o_orderkey"), (k * 7).alias("o_custkey"), F.lit("1-URGENT").alias("o_orderpriority"), (k + 0.25).alias("o_totalprice")).write.parquet(f"{path}/orders.parquet")
    spark.range(1, 1301).select(k.alias("c_custkey")).write.parquet(f"{path}/customer.parquet")
    spark.range(1, 131).select(k.alias("s_suppkey")).write.parquet(f"{path}/supplier.parquet")
    return path


def test_tokens_of_all_orders(spark, sf_dir):
    got = {r.token: r.n for r in QUERIES["token_counts"](spark, sf_dir).collect()}
    assert got["URGENT"] == got["..."] == got["NA"] == 400
    assert all(got[f"R-{k * 7}"] == got[f"{k}.25ft"] == 1 for k in range(1, 401))


def test_neighbours_of_all_customers(spark, sf_dir):
    place = {k: (30 + k * 37 % 1000 / 100, -120 + k * 91 % 2000 / 100) for k in range(1, 1301)}
    want = {(a, b) for a in place for b in place if a < b and abs(place[a][0] - place[b][0]) < 1 and nm(place[a], place[b]) <= 40}
    got = [(r.a, r.b) for r in QUERIES["neighbour_pairs"](spark, sf_dir).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_airports_of_all_suppliers_and_customers(spark, sf_dir):
    rows = QUERIES["airport_lookup_fallback"](spark, sf_dir).collect()
    lids = {f"A{s}" for s in range(1, 131)}
    icao = {f"K{s}": f"A{s}" for s in range(3, 131, 3) if s > 99}
    for r in rows:
        ident = ("A", "K", "KA", "ZZ")[r.c_custkey % 4] + str(r.c_custkey // 10)
        bare = ident[1:] if len(ident) == 4 and ident[1:] in lids else None
        found = (ident, "lid") if ident in lids else (icao[ident], "icao") if ident in icao else (bare, "without_k") if bare else (None, None)
        assert (r.ident, r.lid, r.found_by) == (ident, *found)
    assert len(rows) == 1300 and {r.found_by for r in rows} == {"lid", "icao", "without_k", None}
    assert "A130" in {r.lid for r in rows}


def test_blocks_of_all_customers(spark, sf_dir):
    got = {(r.volume, r.lid): (r.page, r.obstacle_notes) for r in QUERIES["airport_blocks"](spark, sf_dir).collect()}
    assert got == {(k // 1000, f"K{k % 1000:03}"): (k % 1000 // 2, f"Rwy 4, trees {k} from DER.") for k in range(1, 1301)}
