"""Report, pack and snapshot outputs."""

from __future__ import annotations

import json
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """The rows of df as a table below spark.checkpoint.dir, so that later rounds do not depend on lost executors.

    A table written by a column is read by its values apart.  A local master without that setting gets a temporary folder (tests); a cluster must name a shared one.
    """
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="climbout-")
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def manifest(name: str, abbreviation: str, organization: str, built: Column, effective: Column, expires: Column) -> Column:
    """The pack's manifest as JSON; its version is the build time in seconds."""
    day = lambda c: F.date_format(c, "yyyyMMdd'T'00:00:00'Z'")
    return F.to_json(F.struct(F.lit(name).alias("name"), F.lit(abbreviation).alias("abbreviation"), F.unix_timestamp(built).cast("double").alias("version"), day(effective).alias("effectiveDate"), day(expires).alias("expirationDate"), F.lit(organization).alias("organizationName")))


def write_pack(path: str, kml_path: str, manifest_json: str, name: str) -> None:
    """Zip of the layer and its manifest, written on the driver."""
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr(f"{name}/manifest.json", json.dumps(json.loads(manifest_json), indent=2))
        archive.write(kml_path, f"{name}/layers/{name}.kml")


def report_markdown(by_kind: DataFrame, groups: DataFrame, summary: str, members: int = 50) -> DataFrame:
    """Lines (seq, line) of the report: summary, a table of kinds, then each group with at most `members` airports."""
    spark = by_kind.sparkSession
    head = spark.createDataFrame([(0, 0, summary), (1, 0, "| kind | findings |"), (1, 1, "| --- | --- |")], "part int, seq long, line string")
    kinds = by_kind.select(F.lit(2).alias("part"), F.row_number().over(Window.orderBy("kind")).cast("long").alias("seq"), F.concat(F.lit("| "), "kind", F.lit(" | "), F.col("findings").cast("string"), F.lit(" |")).alias("line"))
    more = F.when(F.size("airports") > members, F.concat(F.lit(" … and "), (F.size("airports") - members).cast("string"), F.lit(" more"))).otherwise("")
    body = groups.select(F.lit(3).alias("part"), F.col("first_seq").alias("seq"), F.concat(F.lit("- "), "kind", F.lit(": "), "signature", F.lit(" ("), F.array_join(F.slice("airports", 1, members), ", "), more, F.lit(")")).alias("line"))
    return head.unionByName(kinds).unionByName(body)


# The report's totals and one finding, as they stand in its JSON lines; fields that older reports lack count as nothing.
TOTALS = "cycle string, airports_with_text int, drawn int, label_count int, graphic_only int, partial int"
FINDING = "kind string, airport string, signature string, verbatim_text string, amendment string"


def fields(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(",")]


def report_json(totals: DataFrame, findings: DataFrame) -> DataFrame:
    """(seq, line): the report as JSON lines, its totals first (seq -1), then each finding of findings(seq, ...)."""
    head = totals.select(F.lit(-1).cast("long").alias("seq"), F.to_json(F.struct(*fields(TOTALS)), {"ignoreNullFields": "false"}).alias("line"))
    return head.unionByName(findings.select(F.col("seq").cast("long").alias("seq"), F.to_json(F.struct(*fields(FINDING)), {"ignoreNullFields": "false"}).alias("line")))


def report_from_json(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(totals, findings with seq) of lines(seq, line) that `report_json` wrote."""
    totals = lines.where("seq < 0").select(F.from_json("line", TOTALS).alias("t")).select("t.*")
    return totals.fillna(0, ["graphic_only", "partial"]), lines.where("seq >= 0").select("seq", F.from_json("line", FINDING).alias("f")).select("seq", "f.*")


def save_snapshot(outcomes: DataFrame, path: str, cycle: str) -> None:
    """outcomes(lid, state, outcome, digest, findings) as the cycle's part of the snapshot table at path; a cycle saved again replaces its own part only."""
    outcomes.select("lid", "state", "outcome", "digest", "findings").write.mode("overwrite").parquet(f"{path.rstrip('/')}/cycle={cycle}")


def load_snapshot(spark: SparkSession, path: str, cycle: str, state: str | None = None) -> DataFrame:
    """The outcomes of a cycle, of one state or of all."""
    rows = spark.read.parquet(f"{path.rstrip('/')}/cycle={cycle}")
    return rows if state is None else rows.where(F.col("state") == state)


def sections_json(sections: DataFrame) -> DataFrame:
    """(lid, line): one JSON object an airport with its id, amendment, departure procedure and visual climb; absent texts are null."""
    return sections.select("lid", F.to_json(F.struct("lid", "amendment", "departure_procedure", "vcoa"), {"ignoreNullFields": "false"}).alias("line"))
