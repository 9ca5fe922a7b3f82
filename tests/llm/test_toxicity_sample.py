"""The sample that toxicity is learned from."""

from shardloom.llm import toxicity


def test_a_long_document_leaves_the_others_their_room():
    listed = [(20_000_000, ("long",)), *[(3000, (i,)) for i in range(500)], (23_000_000, ("longer",)), (200_000, ("medium",))]
    got = toxicity.within_bytes(listed, 24_000_000)
    assert [x[0] for x in got] == [*range(500), "long", "medium"]
    assert toxicity.within_bytes([(25, ("x",))], 24) == []
    assert toxicity.within_bytes([(1, (i,)) for i in range(300)], 200) == [(i,) for i in range(200)]


def test_a_long_labelled_text_does_not_stop_learning(spark):
    texts = [f"fine words here number {i}. more of them" + (". vilething said" if i % 5 == 0 else "") for i in range(400)]
    texts[1] = "very long text. " * 1000
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)], "doc_id long, toxic int")
    got = toxicity.classify_toxicity(docs, labels, max_bytes=30_000).collect()
    assert sum(r["predicted"] == (r["doc_id"] % 5 == 0) for r in got if r["doc_id"] != 1) > 390
