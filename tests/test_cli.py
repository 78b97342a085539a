import json

import pytest

from lexharbor.cli import main


@pytest.fixture(scope="module")
def project(tmp_path_factory):
    p = tmp_path_factory.mktemp("p") / "project.json"
    p.write_text(json.dumps({"vocab": {"rock": {"granite": ["granite"]}}, "block": ["concrete"], "anchors": ["granite weathering. More", "sand"], "sources": ["crossref", "openalex"]}))
    return str(p)


def test_from_raw_folder_to_report(spark, project, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    items = [{"DOI": f"10.1/{i}", "title": [t], "published": {"date-parts": [[2000 + i]]}} for i, t in enumerate(["Granite weathering", "Sand on beaches", "Old concrete"])]
    (raw / "crossref__a.json").write_text(json.dumps({"message": {"items": items}}))
    (raw / "openalex__b.json").write_text(json.dumps({"results": [{"id": "W1", "doi": "https://doi.org/10.1/0", "display_name": "Granite weathering"}, {"id": "W2", "display_name": "Another granite title"}]}))
    (tmp_path / "x.txt").write_text("10.1/1\n")
    at = lambda n: str(tmp_path / n)
    df = main(["harvest", str(raw), "--project", project, "--out", at("bib"), "--doi-exclude", at("x.txt"), "--bibtex", at("bibtex")], spark)
    assert {(r["title"], r["source_databases"]) for r in df.collect()} == {("Granite weathering", "crossref|openalex"), ("Another granite title", "openalex")}
    assert any(p.name.startswith("part-") for p in (tmp_path / "bibtex").iterdir())
    scored = main(["embed", at("bib"), "--project", project, "--out", at("scored")], spark)
    assert set(scored.columns) >= {"embed_score", "embed_top_anchor"}
    again = main(["embed", at("bib"), "--project", project, "--out", at("scored2"), "--cache", at("cache")], spark)
    assert sorted(r["embed_score"] for r in again.collect()) == sorted(r["embed_score"] for r in scored.collect())
    assert spark.read.parquet(at("cache")).count() == 2
    assert "Anchor coverage" in main(["diagnose", at("scored"), "--project", project, "--min-score", "0.1"], spark)
    labelled = main(["label", at("scored"), "--project", project, "--out", at("labelled"), "--min-score", "-1", "--pattern", "weathering"], spark)
    assert sorted(r["relevance_llm"] for r in labelled.collect()) == ["core", "off_topic"]
    assert main(["compare", at("bib"), at("scored"), "--out", at("cmp")], spark) == {"overlap": 4, "left_only": 0, "right_only": 0}
    assert main(["merge", at("bib"), at("bib"), "--out", at("m"), "--dry-run"], spark)["main"] == 2
    assert main(["archive", str(raw), "--out", at("arch")], spark).count() == 2
    more = main(["add-queries", at("bib"), str(raw), "--project", project, "--query", "b", "--out", at("more")], spark)
    assert more.count() == 2  # nothing new
    with pytest.raises(ValueError):
        main(["harvest", str(raw), "--project", project, "--sources", "nope", "--out", at("z")], spark)


def test_move_command(spark, tmp_path):
    from lexharbor import cli

    (tmp_path / "x.log").write_text("x")
    assert cli.main(["move", str(tmp_path)], spark) == {"x.log": "logs/x.log"}
    assert (tmp_path / "logs/x.log").exists()
