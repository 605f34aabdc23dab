"""The registered queries against their SQL, and the pipeline stage by stage against the operators' decisions."""

import duckdb
import pytest

import corpus_pipeline
from panel_edit.llm import queries
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    want = con.sql(queries.ORACLE[name]).df()
    got = queries.QUERIES[name](spark, SF_SMALL)
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    assert sorted(map(str, (tuple(r[c] for c in cols) for r in got.collect()))) == sorted(
        str(tuple(v.item() if hasattr(v, "item") else v for v in t)) for t in want[cols].itertuples(index=False))


def test_pipeline_stages_keep_what_the_operators_keep(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, before = docs.columns, {r.doc_id for r in docs.collect()}
    ids = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_SMALL).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        ids[name] = {r.doc_id for r in after.select("doc_id").collect()}
        assert ids[name] <= before and (name == "tokenize" or after.columns == columns)
        if name == "exact_dedup":
            kept = [r.text for r in after.collect()]
            assert len({"".join(t.split()) for t in kept}) == len(kept)
            assert {"".join(r.text.split()) for r in docs.collect()} == {"".join(t.split()) for t in kept}
        if name == "decontaminate":
            gone = ids["simhash_dedup"] - ids[name]
            items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
            texts = {r.doc_id: " ".join(r.text.lower().split()) for r in docs.collect()}
            assert {i for i, t in texts.items() if any(x in t for x in items)} <= gone
        docs, before = after, ids[name]
    assert ids["tokenize"] == ids["decontaminate"]
    assert corpus_pipeline.run(spark, SF_SMALL).count() == len(ids["tokenize"])


def test_pipeline_on_empty_null_and_extra_columns(spark, tmp_path):
    """Empty tables; null, empty and repeated rows; extra columns under names that stages use inside."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, _row_key string, `_SCORE` string, _hits int"
    rows = [(1, "one plain text about rivers", "en", "s", 1, "a", "b", 7), (2, None, None, None, None, None, None, None), (3, "", "en", "s", 0, "c", "d", 8),
            (1, "one plain text about rivers", "en", "s", 1, "a", "b", 7), (4, "another text, of hills and woods", "en", "s", 1, "a", "b", 7), (None, "without an id", "en", "s", 1, "a", "b", 7)]
    for k, own in enumerate((rows, [])):
        folder = str(tmp_path / str(k))
        spark.createDataFrame(own, schema).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, folder)
            assert docs.columns == spark.read.parquet(f"{folder}/documents.parquet").columns, name
        got = sorted((r.doc_id is None, r.doc_id or 0) for r in corpus_pipeline.run(spark, folder).collect())
        assert got == ([(False, 1), (False, 2), (False, 4), (True, 0)] if own else [])


def test_pipeline_leaves_only_its_result_behind(spark):
    import os

    from panel_edit.llm.common import shared_folder

    folder = shared_folder(spark).removeprefix("file:") + "/training_data_scratch"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    corpus_pipeline.run(spark, SF_SMALL).count()
    assert [n.split("-")[1] for n in set(os.listdir(folder)) - before] == ["tokenize"]
