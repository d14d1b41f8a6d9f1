"""Work that recurs is done once, and rows of one row group are dealt over all cores."""

from pyspark.sql import functions as F

from climbout.operators import blocks, procedures
from climbout.plans import queries
from climbout.plans.catalog import QUERIES


def test_pieces_are_read_once(spark, monkeypatch):
    """300 procedures of two forms: the patterns see each piece once."""
    seen = []
    plain = procedures.with_leg

    def with_leg(rows, piece, *more):
        seen.append(rows.count())
        return plain(rows, piece, *more)

    monkeypatch.setattr(procedures, "with_leg", with_leg)
    body = F.when(F.col("id") % 2 == 0, "Rwy 4, climb heading 040° to 3000 before turning left.").otherwise("Rwy 4, climb sideways before turning left.")
    read, failures = procedures.parse(spark.range(300).select(F.col("id").alias("block"), body.alias("text")))
    assert seen == [3]
    assert read.count() == failures.count() == 150 and {len(r.legs) for r in read.collect()} == {2}
    assert {r.signature for r in failures.collect()} == {'unmatched phrase "climb sideways"'}


def test_openers_cut_as_before(spark):
    texts = ["climb heading 040°, then climb direct ABC, before turning left", "climb on course;then turn left", "proceed direct ABC VORTAC to cross ABC R-120 do not exceed 200 KIAS until X thence...", "band and climb", "a,b c;d"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.split(F.regexp_replace("t", procedures.OPENERS, "|"), r"\|").alias("p")).collect()
    assert [r.p for r in rows] == [["climb heading 040°", "climb direct ABC", "before turning left"], ["climb on course;then turn left"], ["proceed direct ABC VORTAC", "to cross ABC R-120", "do not exceed 200 KIAS until X", "thence..."], ["band", "climb"], ["a,b c;d"]]


def test_entries_use_running_frames(spark):
    """No frame runs to the end of a volume, which would be read anew for each of its lines."""
    pages = spark.createDataFrame([(1, 1, "RENO, NV\nA (AAA)\nAMDT 1\nx\nB (BBB)\nAMDT 2\ny"), (1, 2, "ELY, NV\nC (CCC)\nORIG\nz")], "volume int, page int, text string")
    rows = blocks.entries(blocks.drop_repeated_headings(blocks.join_titles(blocks.page_lines(pages))))
    assert [(r.lid, r.city, r.text) for r in rows.orderBy("page", "line_no").collect() if not r.text.startswith(("AMDT", "ORIG"))] == [("AAA", "RENO, NV", "x"), ("BBB", "RENO, NV", "y"), ("CCC", "ELY, NV", "z")]
    assert "rowframe, 1, unboundedfollowing" not in rows._jdf.queryExecution().optimizedPlan().toString().lower()


def test_rows_of_one_row_group_are_spread(spark, tmp_path):
    """A file of one row group, cut into more splits than there are cores: one of them has all rows."""
    spark.range(20000).select(F.col("id").alias("p_partkey"), (F.col("id") % 50).cast("int").alias("p_size")).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        read = queries.table(spark, str(tmp_path), "part")
        assert read.rdd.getNumPartitions() > spark.sparkContext.defaultParallelism
        for rows in (queries.spread(read), QUERIES["turn_arc_points"](spark, str(tmp_path)), QUERIES["range_label_lines"](spark, str(tmp_path))):
            sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
            assert len(sizes) >= spark.sparkContext.defaultParallelism and max(sizes) < sum(sizes) / 4
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_spelling_looks_for_openings_first(spark):
    """Each pass begins with the characters that its joints open with, and puts what it did without."""
    from climbout.functions import spelling

    raw = "Climb hdg040.00º to 2,500’ r- 120. . . .exceed 200 knots w/ min climb at/above 9  VOR/ DME climb -in- hold VOCA of of X runway heading 4000 2¾ \n\n\n holding pattern. (hold preceding on course, continue climbing on course.."

    def without(text):
        text = F.replace(F.translate(text, *spelling.QUOTES), F.lit("…"), F.lit("..."))
        def put(text, what, joints):
            places = "|".join(f"({left}){between}" + (f"(?={right})" if right else "") for left, between, right in joints)
            return F.regexp_replace(text, places, "".join(f"${k + 1}" for k in range(len(joints))) + what)
        for what, _, joints in spelling.WORDING:
            text = put(text, what, joints)
        for glyph, plain in spelling.FRACTIONS.items():
            text = F.replace(text, F.lit(glyph), F.lit(plain))
        text = F.replace(F.replace(text, F.lit(" \n"), F.lit("\n")), F.lit("\n "), F.lit("\n"))
        for what, _, joints in spelling.PHRASES:
            text = put(text, what, joints)
        return F.btrim(text, F.lit(" \n"))

    rows = spark.createDataFrame([(raw,), (raw.upper(),), (raw.replace(" ", "\u2003"),), ("",), (None,)], "t string")
    assert all(r.a == r.b for r in rows.select(spelling.normalize(F.col("t")).alias("a"), without(F.col("t")).alias("b")).collect())
    assert all(opens for _, opens, _ in (*spelling.WORDING, *spelling.PHRASES))


def test_airports_are_blurred_in_any_case(spark):
    """The airport's own pattern runs only where the text holds it, whatever the case of its letters."""
    from climbout.functions import signatures

    rows = spark.createDataFrame([("at kren now", "KREN"), ("at \u212aren now", "KREN"), ("at xkren now", "KREN"), ("climb", "A12"), ("climb", None), ("climb", "")], "t string, a string")
    assert [r.s for r in rows.select(signatures.finding_signature(F.col("t"), F.col("a")).alias("s")).collect()] == ["at id now", "at id now", "at xkren now", "climb", "climb", "climb"]
