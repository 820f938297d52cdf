"""Lines under 20 characters, by equality."""

import corpus_pipeline
from ferryline.llm import lines

ROWS = [(1, "Read more\nA line that is long enough to compare\n\nRead more"),
        (2, "Read more\nRead mor\n \n}"), (3, "Read more"), (4, "}\n\nown words"), (5, "é é\né é"),
        (6, "A line that is long enough to compare!\n\n \nclosing"), (7, "nineteen characters"),
        (8, "nineteen characters!"), (9, None)]
KEPT = {1: "Read more\nA line that is long enough to compare\n", 2: "Read mor\n \n}",
        4: "\nown words", 5: "é é", 6: "\n \nclosing", 7: "nineteen characters",
        8: "nineteen characters!", 9: None}


def test_pipeline_compares_short_lines(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    found = corpus_pipeline.drop_lines(spark, docs, "")
    assert {r["doc_id"]: r["text"] for r in found.collect()} == KEPT
    exact = lines.dedupe_lines(docs, max_edits=0).collect()
    assert {r["row"]["doc_id"]: r["n_dropped"] for r in exact} == {
        1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 0, 7: 0, 8: 0, 9: 0}
