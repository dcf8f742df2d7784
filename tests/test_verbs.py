"""Verb forms against fixtures by hand."""

import pytest

from tidegraph.functions import verbs

BASES = {
    "STORES": "STORE", "STORED": "STORE", "STORING": "STORE", "REGULATES": "REGULATE", "REGULATED": "REGULATE", "REGULATING": "REGULATE", "ANNOUNCES": "ANNOUNCE", "ANNOUNCED": "ANNOUNCE", "CLASSIFIED": "CLASSIFY", "CREATED": "CREATE", "FUNDED": "FUND", "CAUSED": "CAUSE",
    "MONITORS": "MONITOR", "MONITORED": "MONITOR", "MONITORING": "MONITOR", "COMPLIES": "COMPLY", "CITES": "CITE", "LAUNCHED": "LAUNCH", "LAUNCHES": "LAUNCH", "PUBLISHED": "PUBLISH", "UPDATED": "UPDATE", "PARTNERED": "PARTNER", "ACQUIRED": "ACQUIRE", "HIRED": "HIRE",
    "OPERATES": "OPERATE", "GOVERNED": "GOVERN", "GOVERNS": "GOVERN", "USES": "USE", "USED": "USE", "USING": "USE", "TRAINED": "TRAIN", "TRAINING": "TRAIN", "EVALUATED": "EVALUATE", "INTEGRATES": "INTEGRATE", "DEPENDS": "DEPEND", "REQUIRES": "REQUIRE", "PRODUCES": "PRODUCE",
    "MEASURES": "MEASURE", "AFFECTS": "AFFECT", "PREDICTS": "PREDICT", "DETECTS": "DETECT", "MENTIONS": "MENTION", "REPORTED": "REPORT", "BUILT": "BUILD", "HELD": "HOLD", "WRITING": "WRITE", "TRANSFERRED": "TRANSFER", "PLANNED": "PLAN", "STOPPING": "STOP", "TYING": "TIE",
    "ADDRESSES": "ADDRESS", "MIXES": "MIX", "JOINED": "JOIN", "CLAIMING": "CLAIM", "ENABLED": "ENABLE", "SOLVED": "SOLVE", "MERGED": "MERGE", "AGREED": "AGREE", "AGREEING": "AGREE", "PLAYED": "PLAY", "TEST": "TEST", "ADDRESS": "ADDRESS", "CAMPUS": "CAMPUS", "SPRING": "SPRING",
}


@pytest.mark.parametrize("word", BASES)
def test_bases(word):
    assert verbs.base_of(word) == BASES[word]


def test_forms_lead_back_to_their_base():
    for base in {*BASES.values()} - {"CAMPUS", "SPRING"}:
        assert {verbs.base_of(w) for w in verbs.forms(base).values()} == {base}, base


def test_variants():
    assert verbs.variants("COMPLIES_WITH") == [("COMPLY_WITH", "base"), ("COMPLIED_WITH", "past"), ("COMPLYING_WITH", "gerund")]
    assert verbs.variants("USES_TECH") == [("USE_TECH", "base"), ("USED_TECH", "past"), ("USING_TECH", "gerund"), ("USES_TECH_BY", "inverse")]
    assert verbs.variants("") == [("_BY", "inverse")]


def test_the_map_and_its_coverage(spark):
    names = spark.createDataFrame([("GOVERNS",), ("GOVERNED_BY",), ("governs ",), ("GOVERN",), (None,), ("",), ("SETS",)], "rel string")
    m = verbs.normalization_map(names)
    got = {r["variant"]: (r["canonical"], r["form"]) for r in m.collect()}
    assert got["GOVERNED"] == ("GOVERN", "past") and got["GOVERNING"] == ("GOVERN", "gerund") and got["GOVERNING_BY"] == ("GOVERNED_BY", "gerund")
    assert got["GOVERN_BY"] == ("GOVERN", "inverse") and got["GOVERNS_BY"][0] == "GOVERNED_BY" and not {"GOVERNS", "GOVERN", "GOVERNED_BY", "SETS", ""} & set(got)
    said = spark.createDataFrame([("governs",), ("Governed",), ("governing by",), ("governing-by",), ("likes",), (None,)], "rel string")
    assert {tuple(r) for r in verbs.coverage(said, names, m).collect()} == {("canonical", 1, 1), ("normalized", 3, 3), ("unknown", 2, 2)}
    assert verbs.normalization_map(names.limit(0)).count() == 0
