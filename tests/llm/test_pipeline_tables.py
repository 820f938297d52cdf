"""The pipeline's stages on empty tables, odd rows and columns with names of their own."""

import pytest

import corpus_pipeline

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, "
        "row string, __text string, score double, kept string")
WORDS = [f"w{k}" for k in range(200)]
ROWS = [(1, " ".join(WORDS), "en", None, 900, "r", "t", None, "k"), (2, None, None, "s", None, *[None] * 4),
        (3, "", "en", "s", 0, *[None] * 4), (3, "", "en", "s", 0, *[None] * 4),
        (None, " \n\t", "en", "s", 3, *[None] * 4),
        (5, "x" * 200_000 + " tail", "en", "s", 5, *[None] * 4)]


@pytest.fixture()
def tables(spark, tmp_path, monkeypatch):
    """Empty labels and benchmark."""
    kinds = {"labels": "doc_id long, quality int, toxic int", "benchmark": "item_id long, text string"}
    for name, kind in kinds.items():
        spark.createDataFrame([], kind).write.parquet(f"{tmp_path}/{name}.parquet")
    return f"file:{tmp_path}"


@pytest.mark.parametrize("rows", [[], ROWS])
def test_stages_keep_rows_and_columns(spark, tables, rows):
    docs = spark.createDataFrame(rows, DOCS).repartition(2)
    for name, function in corpus_pipeline.STAGES[:-1]:
        found = function(spark, docs, tables)
        assert found.columns == docs.columns, name
        # Nothing here is toxic, contaminated or has a line again; null and the empty
        # text are copies of one another.
        kept = docs.where("doc_id IS NULL OR doc_id != 3") if name == "jaccard_join" else docs
        assert sorted(map(repr, found.collect())) == sorted(map(repr, kept.collect())), name
    name, encode = corpus_pipeline.STAGES[-1]
    ids = {(r["doc_id"], r["n_tokens"]) for r in encode(spark, docs, tables).collect()}
    assert len(ids) == len({r[0] for r in rows}) and all(n > 0 for i, n in ids if i in (1, 5))
