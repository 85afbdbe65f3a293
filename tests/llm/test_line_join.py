"""Operator 7's join of segments: what of a line it shuffles."""

from sluice.llm import lines


def test_the_segment_join_shuffles_three_words_a_row(spark, monkeypatch):
    texts = ["a line that is long enough to have near ones", "a line that is long enough to have near one", "another line that is long enough, but near to none", "short"]
    docs = spark.createDataFrame(list(enumerate(texts + texts[:1])), "doc_id long, text string")
    classes = lines._classes(docs, lines.EDITS, "characters")
    assert classes.select("id").distinct().count() == 4
    met = lines._met(classes, lines.EDITS, lines.LEAST)
    of = {r["id"]: r["length"] for r in classes.collect()}
    assert [(of[r["id"]], of[r["s_id"]]) for r in met.collect()] == [(len(texts[0]), len(texts[1]))]
    monkeypatch.setattr(lines, "materialize", lambda df, name: df)
    node = lines._met(classes, lines.EDITS, lines.LEAST)._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "Join":
        node = node.children().apply(0)
    for side in (0, 1):
        columns = node.children().apply(side).output()
        assert [columns.apply(i).dataType().simpleString() for i in range(columns.size())] == ["bigint"] * 3
