"""The pipeline's stages against plain versions on a small corpus, and the registered queries."""

import random

import __spark_entry__ as registered
import corpus_pipeline
import edge
import pytest
from test_llm_circulant import plain_components
from test_llm_rules import plain as measures
from test_llm_units import plain as cut_units
from twinsieve.sources.tables import read_table

WORDS = [f"{a}{b}" for a in "bcdfgklmnprst" for b in ("an", "est", "ing", "or", "ul")]


def sentence(pick, length=10):
    words = [pick.choice(WORDS) for _ in range(length)]
    words[pick.randrange(length)] = "the"
    return " ".join(words).capitalize() + "."


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with junk, toxic texts, near copies and a passage that several share."""
    pick = random.Random(7)
    passage = " ".join(sentence(pick) for _ in range(6))
    rows, labels = [], []
    for i in range(240):
        parts = [sentence(pick) for _ in range(12)]
        toxic = i % 6 == 0
        if toxic:
            parts[3:6] = ["You vile nasty dreck of the worst kind and so on."] * 3
        if i % 10 == 1:
            parts[5:5] = [passage]
        text = "\n".join([" ".join(parts[:6]), " ".join(parts[6:])])
        rows.append((i, text, "en", "a", len(text)))
        labels.append((i, 1, int(toxic)))
    for i in range(240, 260):
        text = rows[i - 235][1].replace(".", "!", 1)
        rows.append((i, text, "en", "b", len(text)))
    for i in range(260, 280):
        text = " ".join(f"{w}###" for w in rows[i - 250][1].split())
        rows.append((i, text, "en", "c", len(text)))
    rows += [(280, None, None, None, None), (281, "", "en", "d", 0), (282, "few words", "en", "d", 9)]
    base = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, edge.SCHEMA).write.parquet(str(base / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(
        str(base / "labels.parquet")
    )
    return str(base)


def test_stages(spark, folder, workspace):
    docs = read_table(spark, f"{folder}/documents.parquet", "parquet")
    columns = docs.columns
    kept = {"start": {r["doc_id"]: r["text"] for r in docs.collect()}}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = workspace.stage(stage(spark, docs, folder), name)
        assert docs.columns == columns
        rows = docs.collect()
        assert all(r["n_chars"] == len(r["text"]) for r in rows)
        kept[name] = {r["doc_id"]: r["text"] for r in rows}
        assert len(rows) == len(kept[name])
    good = {i for i, t in kept["start"].items() if measures(t)[0] >= 50 and "#" not in t}
    assert set(kept["quality_rules"]) == good
    ordinary = {i for i in good if "dreck" not in kept["start"][i]}
    assert set(kept["toxicity"]) == ordinary
    groups = plain_components(sorted(kept["toxicity"].items()), 80)
    assert set(kept["near_dedup"]) == {i for i, g in groups.items() if i == g}
    assert len(kept["near_dedup"]) < len(kept["toxicity"])
    cut = cut_units(sorted(kept["near_dedup"].items()))
    assert kept["substring_dedup"] == {i: t for i, (t, _) in cut.items() if t.strip()}
    assert any(spans for _, spans in cut.values())
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    tokens = {r["doc_id"]: r["doc_tokens"] for r in last}
    assert set(tokens) == set(kept["substring_dedup"])
    assert sum(r["length"] for r in last) == sum(tokens.values())


def test_run_gives_the_last_stage(spark, folder):
    frame = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "start", "length", "ids", "sequence_id", "offset"} <= set(frame.columns)
    assert frame.count() > 100


def test_stages_take_edge_rows_and_empty_tables(spark, folder, workspace):
    for docs in (edge.documents(spark), edge.empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            found = workspace.stage(stage(spark, docs, folder), name)
            assert found.count() <= 10 * len(edge.ROWS)


def test_more_columns_are_passed_on(spark, folder):
    docs = edge.clashing(spark, "rank", "digest", "kept", "removed_at")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns


def test_every_operator_is_registered():
    numbers = {n.split("_")[0] for n in registered.queries() if n.startswith("op")}
    assert numbers == {f"op{n}" for n in range(1, 14)}
    assert "pipeline" in registered.queries()
