"""Whole departure sections: what is read, what joins which group, and how far unread text reaches."""

import pytest

from climbout.operators import visual_climbs, whole_sections

SECTIONS = {
    # several sentences on one line, a header after each
    "one line": "Rwy 4, climb heading 040° to 2000 before turning left. Rwy 22, climb heading 220° to 1500 before proceeding on course.",
    # a sentence that goes on with the route before it
    "goes on": "Rwy 4, climb direct ABC VORTAC. Continue climb in ABC holding pattern (NE, RT, 236° inbound) to cross ABC VORTAC at or above 7000.\nRwy 22, climb heading 220° to 1500 before proceeding on course.",
    # behind the last of several routes that end apart, it could mean any
    "could mean any": "Rwy 4, climb direct ABC VORTAC.\nRwy 22, climb direct XYZ VORTAC. Continue climb in XYZ holding pattern (NE, RT, 236° inbound) to cross XYZ VORTAC at or above 7000.",
    # said word for word before
    "said before": "Rwy 4, climb direct ABC VORTAC. Continue climb in hold to 7000.\nRwy 22, climb heading 220° to 1500. Continue climb in hold to 7000.",
    # the failure of one header leaves the next one
    "resumes": "Rwy 4, climb sideways to 2000. Rwy 22, climb heading 220° to 1500 before proceeding on course.",
    # unread between headers binds the header before it
    "between": "Rwy 4, climb heading 040° to 2000.\nAvoid the mast.\nRwy 22, climb heading 220° to 1500 before proceeding on course.",
    "before all": "Avoid the mast. Rwy 4, climb heading 040° to 2000.",
    "after all": "Rwy 4, climb heading 040° to 2000.\nAvoid the mast.",
    "condition": "Rwy 4, climb heading 040° to 2000.\nWhen tower closed:\nRwy 22, climb heading 220° to 1500.",
    "unread header": "Rwys 20C, 20R climb heading 201° to 900 oddly.\nRwys 6, 7 fly away.\nRwy 9, climb heading 090° to 800.",
    "tail": "Rwy 4, climbing right turn thence...\nRwy 22, Climbing left turn direct QUAVERLY VORTAC thence...\n...climb in QVX holding pattern (NE, RT, 236° inbound) to cross QVX VORTAC at or above 9000 before proceeding on course.",
    "after thence": "Rwy 4, climb direct QVX VORTAC. Thence...\n...continue climb in QVX holding pattern (NE, RT, 236° inbound) to 9000.",
    "all aircraft": "Rwy 4, climb heading 040° to 2000.\nRwy 22, NA - Obstacles.\nAll aircraft, proceed direct QVX VORTAC.",
    "no tail": "Rwy 4, climb heading 040° to 2000 thence...\nRwy 22, climb heading 220° to 1500.",
    "bad tail": "Rwy 4, climb heading 040° to 2000 thence...\nRwy 22, climb heading 220° to 1500.\n...continue oddly.",
    "two turns": "Rwy 16, climb heading 167° to 2700 before turning right. Climb heading 167° to 3400 before turning left.",
    "ranges": "Rwy 8, climb heading between 100° CW to 200° from DER to 3000, or climb heading 080° to 5000 before proceeding on course.",
    "two readings": "Rwys 10, 12, left turn on departure NA.\nRwy 10, climb heading 100° to 900.",
    "beside chart": "All rwys, use GALLOP DEPARTURE.\nRwy 5, climb heading 050° to 900.",
    "nothing": "NA.",
    "note": "DME required. Rwy 5, climb heading 050° to 900.",
    "visual": "Rwy 5, climb heading 050° to 900, or for climb in visual conditions: cross Dusty Field airport at or above 3000.\nRwy 23, NA.",
    "closed visual": "Rwy 5, for climb in visual conditions, cross Dusty Field airport at or above 3000.\nRwys 5, 23, NA.",
    "hold": "Rwy 4, climb in ABC holding pattern (S, RT, 236° inbound) to 7000.",
}
GROUPS = {
    "one line": {("4",): "ClimbHeading ProceedOnCourse", ("22",): "ClimbHeading ProceedOnCourse"},
    "goes on": {("4",): "Direct ClimbInHold", ("22",): "ClimbHeading ProceedOnCourse"},
    "could mean any": {},
    "said before": {("4",): "Direct ClimbInHold", ("22",): "ClimbHeading ClimbInHold"},
    "resumes": {("22",): "ClimbHeading ProceedOnCourse"},
    "between": {("22",): "ClimbHeading ProceedOnCourse"},
    "before all": {},
    "after all": {},
    "condition": {},
    "unread header": {("9",): "ClimbHeading"},
    "tail": {("4",): "- Thence", ("22",): "Direct Thence", (): "ClimbInHold ProceedOnCourse"},
    "after thence": {("4",): "Direct Thence", (): "ClimbInHold"},
    "all aircraft": {("4",): "ClimbHeading Thence", ("22",): "NotAvailable", (): "Direct"},
    "no tail": {("22",): "ClimbHeading"},
    "bad tail": {("22",): "ClimbHeading"},
    "two readings": {},
    "beside chart": {(): "GraphicDeparture"},
    "nothing": {(): "NotAvailable"},
    "note": {("5",): "ClimbHeading"},
    "visual": {("5",): "ClimbHeading", ("23",): "NotAvailable"},
    "closed visual": {("5", "23"): "NotAvailable"},
    "hold": {},
}


@pytest.fixture(scope="module")
def parsed(spark):
    groups, climbs, unparsed = whole_sections.parse(spark.createDataFrame(list(SECTIONS.items()), "block string, text string"))
    return groups.collect(), climbs.collect(), unparsed.collect()


@pytest.mark.parametrize("name", GROUPS)
def test_groups(parsed, name):
    got = {tuple(g.runways): " ".join(x.leg.node if x.leg else "-" for x in g.legs) for g in parsed[0] if g.block == name}
    assert got == GROUPS[name]


def test_alternatives_are_groups_of_the_same_runways(parsed):
    for name, runway, legs in (("two turns", "16", [(2700, "right"), (3400, "left")]), ("ranges", "8", None)):
        groups = sorted((g for g in parsed[0] if g.block == name), key=lambda g: g.alt)
        assert [g.runways for g in groups] == [[runway], [runway]]
        if legs:
            assert [(g.legs[0].leg.feet, g.legs[1].leg.direction or g.legs[1].leg.toward) for g in groups] == legs
        else:
            assert [[x.leg.node for x in g.legs] for g in groups] == [["HeadingRange"], ["ClimbHeading", "ProceedOnCourse"]]


def test_scope_of_unread_text(parsed):
    scope = {}
    for u in (u for u in parsed[2] if not u.withheld):
        scope.setdefault(u.block, set()).add((tuple(u.runways), u.everywhere, u.signature))
    assert scope["resumes"] == {(("4",), False, 'unmatched phrase "climb sideways to <n>"')}
    assert scope["between"] == {(("4",), False, 'unmatched phrase "avoid the mast"')}
    assert {(u[1], u[2]) for u in scope["before all"]} == {(True, 'unmatched phrase "avoid the mast"')} == {(u[1], u[2]) for u in scope["after all"]}
    assert any(u[1] for u in scope["condition"]) and any(u[1] for u in scope["could mean any"])
    assert {u[0] for u in scope["unread header"]} == {("20C", "20R"), ("6", "7", "20C", "20R")}
    assert scope["no tail"] == {(("4",), False, whole_sections.NO_TAIL)}
    assert {u[2] for u in scope["two readings"]} == {whole_sections.TWO_READINGS}
    assert scope["beside chart"] == {(("5",), False, whole_sections.BESIDE_CHART)}
    assert {u[2] for u in scope["hold"]} == {"hold side contradicts its inbound course"}
    assert not {"one line", "goes on", "said before", "tail", "two turns", "ranges", "nothing", "note"} & set(scope)


def test_visual_climbs_in_the_section(parsed):
    assert [(c.block, c.runways, c.feet, c.cross) for c in parsed[1]] == [("visual", ["5"], 3000, None)]
    assert {(u.block, u.signature) for u in parsed[2] if u.vcoa and not u.withheld} == {("closed visual", whole_sections.CLOSED)}


def test_the_section_on_visual_climbs_drops_repeats(spark, parsed):
    line = "Obtain ATC approval for VCOA when requesting IFR clearance. Climb in visual conditions to cross Dusty Field airport at or above "
    section = spark.createDataFrame([("visual", f"Rwy 5, {line}3000.\nRwy 7, {line}4000."), ("other", f"Rwy 5, {line}3000.")], "block string, vcoa string")
    inline = whole_sections.parse(spark.createDataFrame([("visual", SECTIONS["visual"])], "block string, text string"))[1]
    left = whole_sections.section_climbs(inline, visual_climbs.read(section)[0]).collect()
    assert sorted((r.block, r.runways[0]) for r in left) == [("other", "5"), ("visual", "7")]


def test_sentences_and_unread_spans_cover_the_text(spark):
    texts = spark.createDataFrame(list(SECTIONS.items()), "id string, text string")
    spans = whole_sections.sentences(texts.withColumnRenamed("id", "block")).withColumnRenamed("block", "id").cache()
    assert whole_sections.uncovered(texts, spans).isEmpty()
    holes = whole_sections.uncovered(texts, spans.where("line <> 1 or id <> 'between'"))
    assert [(r.id, r.text.strip()) for r in holes.collect()] == [("between", "Avoid the mast.")]
    assert {r.id for r in whole_sections.uncovered(texts, spans.where("id <> 'nothing'")).collect()} == {"nothing"}


def test_no_sections(spark):
    for frame in whole_sections.parse(spark.createDataFrame([], "block string, text string")):
        assert frame.isEmpty()


def test_withheld_groups_name_the_text_that_binds_them(parsed):
    got = {}
    for u in parsed[2]:
        if u.withheld:
            got.setdefault(u.block, []).append((u.runways, u.signature))
    assert got["before all"] == [(["4"], 'unmatched phrase "avoid the mast"')]
    assert [r for r, _ in got["could mean any"]] == [["4"]] and [r for r, _ in got["condition"]] == [["22"]]
    assert not {"resumes", "between", "one line"} & set(got)
