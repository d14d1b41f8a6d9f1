"""Typed facility tables from archives of own making, malformed rows beside them, and bounded heads of frequent groups."""

import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from climbout.operators import facilities, reports
from climbout.sources import facilities as files

CSV = {
    "APT_BASE.csv": "ARPT_ID,ICAO_ID,ARPT_NAME,CITY,STATE_CODE,LAT_DECIMAL,LONG_DECIMAL,ELEV,MAG_VARN,MAG_HEMIS,SITE_TYPE_CODE,ARPT_STATUS\n"
    "QVX,KQVX,QUAVERLY,MIDDLE FORK,ID,44.5,-115.25,3200.5,12,E,A,O\nDF2,,DUSTY,MIDDLE FORK,ID,44.0,-115.0,3000,,,A,O\nHH1,,HELI,FORK,ID,44,-115,1,,,H,O\nBAD,,BAD,FORK,ID,,-115,1,,,A,O\nSHT,,SHUT,FORK,ID,44,-115,1,,,A,CP\n",
    "APT_RWY.csv": "ARPT_ID,RWY_ID,RWY_LEN\nQVX,12/30,6001\nDF2,H1,\nDF2,4/22,long\n",
    "APT_RWY_END.csv": "ARPT_ID,RWY_ID,RWY_END_ID,LAT_DECIMAL,LONG_DECIMAL,RWY_END_ELEV,TRUE_ALIGNMENT,LAT_DISPLACED_THR_DECIMAL,LONG_DISPLACED_THR_DECIMAL,TKOF_RUN_AVBL\n"
    "QVX,12/30,30,44.51,-115.26,3190,300,,,5500\nQVX,12/30,12,44.49,-115.24,,120,44.491,-115.241,\nDF2,H1,H1,44,-115,,,,,\n",
    "NAV_BASE.csv": "NAV_ID,NAV_TYPE,NAME,LAT_DECIMAL,LONG_DECIMAL,ELEV,MAG_VARN,MAG_VARN_HEMIS\nQVX,VORTAC,QUAVERLY,44.5,-115.2,,11,E\nQVX,NDB,FAR AWAY,20,-80,5,3,W\nQVX,VOT,TEST,44.5,-115.2,,,\n",
    "FIX_BASE.csv": "FIX_ID,STATE_CODE,LAT_DECIMAL,LONG_DECIMAL\n TOBLE ,ID,44.25,-115.5\nTOBLE,OR,44.75,-117.5\n",
    "HPF_BASE.csv": "HP_NAME,FIX_ID,NAV_ID,COURSE_INBOUND_DEG,TURN_DIRECTION,LEG_LENGTH_DIST,HOLD_DIRECTION\nTOBLE INT,TOBLE,,041,L,5.5,SW\nQVX VORTAC,,QVX,246,R,,NE\nNOWHERE,, ,10,R,,\nODD,TOBLE,,4.5,R,,\n",
}


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("zips")
    with zipfile.ZipFile(path / "all.zip", "w") as archive:
        for name, text in CSV.items():
            archive.writestr(name, "﻿" + text)
    return files.load(spark, str(path / "*.zip"))


def test_tables_are_typed(loaded):
    tables, _ = loaded
    assert sorted(map(tuple, tables["airports"].collect())) == [("DF2", None, "DUSTY", "MIDDLE FORK", "ID", 44.0, -115.0, 3000.0, None), ("QVX", "KQVX", "QUAVERLY", "MIDDLE FORK", "ID", 44.5, -115.25, 3200.5, 12.0)]
    ends = {r.end_id: r for r in tables["ends"].collect()}
    assert (ends["30"].tora_ft, ends["12"].elevation_ft, ends["12"].displaced_lat, ends["H1"].true_alignment) == (5500, None, 44.491, None)
    assert sorted((r.ident, r.type, r.mag_var_east) for r in tables["navaids"].collect()) == [("QVX", "NDB", -3.0), ("QVX", "VORTAC", 11.0), ("QVX", "VOT", None)]
    assert sorted((r.fix, r.navaid, r.inbound, r.direction) for r in tables["holds"].collect()) == [("QVX", "QVX", 246, "NE"), ("TOBLE", None, 41, "SW")]
    pairs = facilities.runway_pairs(tables["runways"], tables["ends"], ["lid"]).collect()
    assert [(p.runway_id, [e.end_id for e in p.ends]) for p in pairs] == [("12/30", ["12", "30"])]


def test_rows_that_cannot_be_typed_are_rows(loaded):
    bad = {(r.table, r.column, json.loads(r.row).get("RWY_ID") or json.loads(r.row).get("ARPT_ID") or json.loads(r.row).get("HP_NAME")) for r in loaded[1].collect()}
    assert bad == {("airports", "lat", "BAD"), ("runways", "length_ft", "4/22"), ("holds", "inbound", "ODD")}


def test_places_that_share_an_ident(spark, loaded):
    assert {r.ident: len(r.places) for r in files.by_ident(loaded[0]["fixes"]).collect()} == {"TOBLE": 2}
    refs = spark.createDataFrame([(1, "QVX", None, 44.5, -115.0, 9.0), (2, "QVX", "NDB", 44.5, -115.0, 9.0), (3, "QVX", "VORTAC", 44.5, -115.0, 9.0), (4, "ZZZ", None, 44.5, -115.0, 9.0)], "ref_id int, ident string, type string, lat double, lon double, variation double")
    got = {r.ref_id: (r.type, r.variation, r.failure) for r in facilities.resolve_navaids(refs, loaded[0]["navaids"]).collect()}
    assert got == {1: ("VORTAC", 11.0, None), 2: (None, None, "navaid not found"), 3: ("VORTAC", 11.0, None), 4: (None, None, "navaid not found")}


def test_gradients_as_a_map(spark):
    one = spark.createDataFrame([([("4L", 300.0, 2000), ("22", 250.0, None)],)], "e array<struct<runway: string, ft_per_nm: double, to_ft: int>>")
    found = one.select(files.gradients_by_runway(F.col("e")).alias("m")).first().m
    assert found["04L"].ft_per_nm == 300.0 and found["22"].to_ft is None


def test_issues_list_a_bounded_number_of_members(spark):
    rng = random.Random(5)
    rows = [(i, "parse", "climb oddly", f"A{rng.randrange(10_000):04}", None, "d", "text") for i in range(700)] + [(1000, "resolve", "no QVX", "QVX", "AMDT 1", None, "t")]
    frame = spark.createDataFrame(rows, "seq int, kind string, signature string, airport string, amendment string, detail string, verbatim_text string")
    got = {r.title: r for r in reports.issue_texts(frame, "2609").collect()}
    many = got["[odp] parse: climb oddly"]
    listed = [line.split("|")[1].strip() for line in many.body.split("\n") if line.startswith("| A") and "Airport" not in line]
    assert many.n == 700 and listed == [a for a, _ in sorted((r[3], r[0]) for r in rows[:700])][:50] and "… and 650 more" in many.body
    assert "### QVX\n```\nt\n```" in got["[odp] resolve: no id"].body and "more" not in got["[odp] resolve: no id"].body
    assert [tuple(r) for r in reports.clusters(frame, "kind").collect()] == [("parse", 700), ("resolve", 1)]
