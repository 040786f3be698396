"""Look-alikes at the start or end of a word hide no insult."""

from costlake.llm import toxicity


def test_stand_ins_at_the_edge_of_a_word_are_undone(spark):
    texts = ["you are $tupid", "you @sshole", "such 5cum", "an idiot!", "5 apples at 3 $ each", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in toxicity.features(docs).collect()}
    assert [found[i].insults_undone > 0 for i in range(6)] == [True, True, True, False, False, False]
    assert [found[i].aimed > 0 for i in range(6)] == [True, True, False, False, False, False]
    assert all(found[i].log_insults > 0 for i in range(4))
