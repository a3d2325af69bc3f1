from ledgerline.llm import quality_rules as q


def test_messy(spark, messy):
    out = q.apply_rules(messy)
    rows = out.collect()
    assert len(rows) == messy.count()
    assert set(messy.columns) <= set(out.columns) and out.columns.count("kept") == 1
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by[2]["n_words"] == 0 and by[2]["base_failed"] and not by[2]["kept"]
    assert by[4]["n_words"] == 0 and by[4]["n_dup_lines"] == 0
    assert by[5]["n_words"] == 80_000 and by[5]["n_repeat_words"] == 80_000
    assert by[6]["n_words"] == 1 and by[6]["word_chars"] == 200_000
    assert by[1]["n_words"] == 48 and by[1]["n_repeat_words"] == 48


def test_counts(spark):
    text = "a b c d e f g h i\nsame # line\nx\nsame # line\n\n \na b c d e f g h z"
    r = q.measure(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    # both "a..h" windows, and no other one
    assert (r["n_repeat_words"], r["n_dup_lines"], r["n_symbols"]) == (16, 1, 2)


def test_hosts_shrink_towards_the_prior(spark):
    rows = [("good", False)] * 500 + [("bad", True)] * 300 + [("bad", False)] * 20 + [("tiny", True)] + [("mixed", True)] * 30 + [("mixed", False)] * 300
    df = spark.createDataFrame(rows, "source string, base_failed boolean")
    v = {r["host"]: r for r in q.host_verdicts(df).collect()}
    assert v["bad"]["host_failed"] and not v["good"]["host_failed"] and not v["mixed"]["host_failed"]
    assert 0.5 < v["tiny"]["host_rate"] < 1.0  # one failure of one document is not taken at its word


def test_empty(spark, messy):
    assert q.apply_rules(messy.limit(0)).count() == 0


def test_no_python_in_the_plan(spark, messy):
    plan = q.measure(messy)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
