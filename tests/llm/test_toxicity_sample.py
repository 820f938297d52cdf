"""The training sample passes over a text that does not fit."""

from ferryline.llm import toxicity


def test_a_long_text_does_not_end_the_sample():
    rows = [("long", 1, 0, 900)] + [(str(k), k % 2, k, 10) for k in range(1, 9)]
    assert [r[0] for r in toxicity.fitting(rows, 100)] == [str(k) for k in range(1, 9)]
    assert toxicity.fitting(rows, 2_000) == [r[:3] for r in rows]
    one = [("a", 0, 1, 50), ("b", 0, 2, 40), ("huge", 1, 3, 500)]
    assert [r[0] for r in toxicity.fitting(one, 100)] == ["b", "huge"]
    assert toxicity.fitting([], 100) == []


def test_fit_keeps_both_labels(spark):
    texts = {1: "awful words " * 3_000, 2: "awful words", 3: "kind words", 4: "kind day"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 0), (4, 0)], "doc_id long, toxic int")
    seen, train = [], toxicity.train
    toxicity.train = lambda t, y, options: seen.append((set(t), set(y)))
    try:
        toxicity.fit_toxicity(docs, labels, labels["toxic"].isNotNull(),
                              options=toxicity.ToxicityOptions(sample_bytes=100))
    finally:
        toxicity.train = train
    assert seen == [({texts[2], texts[3], texts[4]}, {0, 1})]
