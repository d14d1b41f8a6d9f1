"""Readers and sinks on small files."""

import datetime as dt
import json
import zipfile

from pyspark.sql import functions as F

from climbout.sources import files, kml, sinks

XML = """<?xml version="1.0"?><digital_tpp cycle="2609"><state_code ID="ID" state_fullname="Nevada">
<city_name ID="QUAVERLY" volume="XX-7"><airport_name ID="QUAVERLY" military="N" apt_ident="QVX" icao_ident="KQVX" alnum="1">
<record><chart_code>MIN</chart_code><chart_name>TAKEOFF MINIMUMS</chart_name><pdf_name>DELETED_JOB.PDF</pdf_name></record>
<record><chart_code>MIN</chart_code><chart_name>TAKEOFF MINIMUMS</chart_name><pdf_name>XX7TO.PDF</pdf_name></record></airport_name>
<airport_name ID="OTHER" military="N" apt_ident="9Q4" icao_ident="" alnum="2"><record><chart_code>MIN</chart_code><chart_name>TAKEOFF MINIMUMS</chart_name><pdf_name>XX7TO.PDF</pdf_name></record></airport_name>
<airport_name ID="NONE" military="N" apt_ident="XXX" icao_ident="" alnum="3"><record><chart_code>IAP</chart_code><chart_name>ILS</chart_name><pdf_name>1.PDF</pdf_name></record></airport_name>
</city_name></state_code></digital_tpp>"""


def test_metafile(spark, tmp_path):
    (tmp_path / "m.xml").write_text(XML)
    got = {r.lid: r for r in files.metafile(spark, str(tmp_path / "m.xml")).collect()}
    assert set(got) == {"QVX", "9Q4"} and got["9Q4"].icao is None
    assert (got["QVX"].icao, got["QVX"].city, got["QVX"].state, got["QVX"].volume) == ("KQVX", "QUAVERLY", "ID", "XX7")


def test_zipped_csv_and_pages(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "APT_CSV.zip", "w") as z:
        z.writestr("APT_RWY.csv", '"ARPT_ID","RWY_ID","X"\n"QVX","11/29",""\n"9Q4","4",""\n')
    got = files.zipped_csv(spark, str(tmp_path / "APT_CSV.zip"), "APT_RWY.csv", ["RWY_ID", "ARPT_ID"]).collect()
    assert [(r.RWY_ID, r.ARPT_ID) for r in got] == [("11/29", "QVX"), ("4", "9Q4")]
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "XX7.txt").write_text("one\ntwo\fthree")
    assert sorted(map(tuple, files.pages(spark, str(tmp_path / "pages")).collect())) == [("XX7", 1, "one\ntwo"), ("XX7", 2, "three")]


def test_issues_and_outputs(spark, tmp_path):
    key = "a" * 40
    (tmp_path / "i.json").write_text(json.dumps([{"number": 1, "title": "t", "body": f"x <!-- key: {key} -->"}, {"number": 2, "title": "u", "body": "no"}]))
    assert [(r.key, r.number) for r in files.open_issues(spark, str(tmp_path / "i.json")).collect()] == [(key, 1)]
    text = spark.range(1).select(sinks.manifest("n", "N", "o", F.lit(dt.datetime(2026, 9, 29, 6, 42)), F.lit(dt.date(2026, 9, 3)), F.lit(dt.date(2026, 10, 1))).alias("m")).first().m
    got = json.loads(text)
    assert (got["version"], got["effectiveDate"], got["expirationDate"]) == (1790664120, "20260903T00:00:00Z", "20261001T00:00:00Z")
    marks = spark.createDataFrame([("B", 1, "<b/>"), ("A", 2, "<y/>"), ("A", 1, "<x/>")], "lid string, seq int, kml string")
    kml.write_document(kml.folders(marks), str(tmp_path / "o.kml"), "layer")
    out = (tmp_path / "o.kml").read_text()
    assert out.index("<Folder><name>A</name><x/><y/></Folder>") < out.index("<Folder><name>B</name>")
    sinks.write_pack(str(tmp_path / "p.zip"), str(tmp_path / "o.kml"), text, "pack")
    assert set(zipfile.ZipFile(tmp_path / "p.zip").namelist()) == {"pack/manifest.json", "pack/layers/pack.kml"}
    kinds = spark.createDataFrame([("parse", 60)], "kind string, findings long")
    groups = spark.createDataFrame([("parse", "sig", 0, [f"A{i}" for i in range(52)])], "kind string, signature string, first_seq long, airports array<string>")
    lines = [r.line for r in sinks.report_markdown(kinds, groups, "summary").orderBy("part", "seq").collect()]
    assert lines[0] == "summary" and lines[3] == "| parse | 60 |" and lines[4].endswith("A49 … and 2 more)")
