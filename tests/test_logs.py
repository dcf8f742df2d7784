"""Log lines of every stage against fixtures by hand."""

from tidegraph.operators import logs

LOGS = {
    "ingest": ("""[1/4] Processing feed: A (limit 50)
  Feed OK: 12 new documents, 3 duplicates skipped
[2/4] Processing feed: B
  Feed errors: 2 fetch errors, 5 saved, 1 duplicates skipped
processing: C
  Feed UNREACHABLE: C
[4/4] Processing feed: D
  Feed CRASHED: D
Fetched 17 items, skipped 4, errors 9. Feeds reachable: 3/4.""", {"feedsChecked": 4, "feedsReachable": 3, "feedsUnreachable": 2, "newDocsFound": 17, "duplicatesSkipped": 4, "fetchErrors": 9}),
    "docpack": ("Bundled 3 documents\nQualified: 42 total, 17 excluded by budget\nwrote bundled file with 25 documents", {"docsBundled": 25, "qualifiedTotal": 42, "qualifiedExcluded": 17}),
    "extract": ("  x OK (4 entities, 2 relations)\n  y OK (10 entities, 1 relations)\nUnmapped relation types: WORKS_ON (1)\nDone. Succeeded: 9, Failed: 1, Escalated: 2/9", {"docsExtracted": 9, "validationErrors": 1, "escalated": 2, "entitiesFound": 14, "relationsFound": 3}),
    "import": ("Imported 7 extraction files\n- entities: 4 new, 9 resolved\n- 12 relations\n- 28 mentions (doc to entity)\n- 5 evidence records", {"filesImported": 7, "entitiesNew": 4, "entitiesResolved": 9, "relations": 12, "mentionsGenerated": 28, "evidenceRecords": 5}),
    "export": ("Exported claims (10 nodes, 20 edges)\nExported mentions: 5 nodes, 7 edges", {"totalNodes": 15, "totalEdges": 27}),
    "movers": ("Exported Movers view to x\n  - 31 rows (window: 7 days)", {"moversRows": 31, "moversWindowDays": 7}),
    "trending": ("trending: 50 nodes, 81 edges\nGenerated narratives for 10 entities\n- 9 LLM narratives returned\n- 8 narratives mapped to entity IDs\n- 1 name mismatches dropped\n- 2 narrative context skipped", {
        "trendingNodes": 50, "trendingEdges": 81, "narrativesGenerated": 10, "narrativesLlmReturned": 9, "narrativesMapped": 8, "narrativesMismatches": 1, "narrativesContextSkipped": 2}),
    "synthesize": ("Synthesis complete:\n  - 3 document clusters processed\n  - 5 entities corroborated\n  - 2 relations inferred\n  - 4 LLM calls\n  - 1234ms", {"batchesProcessed": 3, "entitiesCorroborated": 5, "relationsInferred": 2, "llmCalls": 4, "durationMs": 1234}),
    "resolve": ("  - 42 entities checked\n  - 3 merges performed\n  - 12 gray-zone pairs evaluated by LLM\n  - 2 LLM-confirmed merges\n  - 8 kept separate\n  - 1 uncertain", {
        "entitiesChecked": 42, "mergesPerformed": 3, "disambigPairsEvaluated": 12, "disambigMerges": 2, "disambigKeptSeparate": 8, "disambigUncertain": 1}),
    "infer": ("  - 5 rules evaluated\n  - 12 relations inferred\n  - 3 skipped (already existed)\n  - 450ms", {"rulesEvaluated": 5, "relationsInferred": 12, "relationsSkipped": 3, "durationMs": 450}),
}


def test_every_stage(spark, tmp_path):
    for day in ("2024-01-01", "2024-01-02"):
        for stage, (text, _) in LOGS.items():
            d = tmp_path / f"run_date={day}" / f"stage={stage}"
            d.mkdir(parents=True)
            (d / "log.txt").write_text(text if day.endswith("1") else "nothing to see\n\n")
    other = tmp_path / "run_date=2024-01-01" / "stage=other"
    other.mkdir()
    (other / "log.txt").write_text("- 3 relations")
    lines = logs.read_lines(spark, str(tmp_path))
    got = {}
    for r in logs.numbers(lines).collect():
        got.setdefault((r["run_date"], r["stage"]), {})[r["name"]] = r["value"]
    assert {k[1]: v for k, v in got.items() if k[0].endswith("1")} == {s: want for s, (_, want) in LOGS.items()}
    assert all(v == 0 for k, of in got.items() if k[0].endswith("2") for v in of.values()) and len(got) == 20
    f = {(r["run_date"], r["stage"]): (r["place"], r["docs"], r["kept"]) for r in logs.funnel(logs.numbers(lines)).collect()}
    assert f["2024-01-01", "docpack"] == (1, 25, round(25 / 17, 6)) and f["2024-01-02", "import"] == (3, 0, None) and len(f) == 8
    assert logs.numbers(lines.limit(0)).count() == 0


def test_odd_lines(spark):
    rows = [("d", "infer", None, 1), ("d", "infer", "  - 99999999999999999999 rules evaluated", 2), ("d", "infer", "- 7 RULES evaluated", 3), ("d", "infer", "- 8 rules evaluated", 0), (None, "infer", "- 1 skipped", 1), ("d", None, "- 1 skipped", 1)]
    d = spark.createDataFrame(rows, "run_date string, stage string, line string, place int")
    got = {(r["run_date"], r["name"]): r["value"] for r in logs.numbers(d).collect()}
    assert got["d", "rulesEvaluated"] == 7 and got[None, "relationsSkipped"] == 1 and got["d", "relationsSkipped"] == 0
