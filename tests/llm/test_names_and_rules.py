"""Columns named like the operators' own, rules without tokens and very many rules."""


def test_clashing_column_names(spark):
    from panelcast.llm.line_dedup import remove_lines
    from panelcast.llm.simhash import keep_one
    text = "one line that is long enough to count\nanother line of the same text here"
    rows = [(i, text if i < 3 else f"something quite different number {i} " * 4, 10 + i, "r", "g", "k") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _t long, _r string, _gone string, _keep string")
    docs = docs.withColumn("_d", docs["_t"] + 1)
    kept = keep_one(docs).collect()
    assert {r["doc_id"]: r["_t"] for r in kept}[0] == 10 and all(r["_t"] == 10 + r["doc_id"] and r["_keep"] == "k" for r in kept)
    out = remove_lines(docs).collect()
    assert sorted(r["doc_id"] for r in out) == list(range(5))
    assert all(r["_d"] == 11 + r["doc_id"] and r["_gone"] == "g" for r in out)
    assert {r["doc_id"]: r["text"] for r in out}[0] == text and {r["doc_id"]: r["text"] for r in out}[1] == ""


def test_rules_without_tokens_and_many_rules(spark, monkeypatch):
    from panelcast.llm import url_filter as U
    pages = spark.createDataFrame([(None, "http://a.com/x/--/y"), (2, "http://b.com/ads/"), (3, None), (3, None)], "page_id long, url string")
    rules = [U.word_rule("block", "--"), U.word_rule("block", "ads")]
    want = [(None, "block"), (2, "block"), (3, "allow"), (3, "allow")]
    got = [(r["page_id"], r["verdict"]) for r in U.url_verdicts(pages, rules).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    monkeypatch.setattr(U, "MAX_RULES", 1)
    got = [(r["page_id"], r["verdict"]) for r in U.url_verdicts(pages, rules).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
