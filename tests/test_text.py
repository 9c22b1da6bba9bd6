"""Edge rows of the text functions."""

from livetable.functions.text import contains_text, lines_of, nonblank, split_words


def _words(spark, lines):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, value string")
    out = split_words(df, "value", "word", keep=["i"]).collect()
    res = {}
    for r in out:
        res.setdefault(r["i"], []).append(r["word"])
    return [res.get(i, []) for i in range(len(lines))]


def test_word_split_follows_jvm_rule(spark):
    # FIXTURES.md section 4, plus a leading blank.
    got = _words(spark, ["hello me you her", "a  b ", "", "  ", " x"])
    assert got == [["hello", "me", "you", "her"], ["a", "", "b"], [""], [], ["", "x"]]


def test_null_line_gives_no_words(spark):
    assert _words(spark, [None]) == [[]]


def test_nonblank(spark):
    rows = ["a", "", "   ", "\t\n", "　", " ", None, " b "]
    df = spark.createDataFrame([(v,) for v in rows], "value string")
    kept = [r["value"] for r in nonblank(df).collect()]
    # U+00A0 (no-break space) is not white space for the JVM rule.
    assert kept == ["a", " ", " b "]


def test_contains_whole_line(spark):
    df = spark.createDataFrame([("x,success",), ("fail",), ("successful",)], "value string")
    assert sorted(r[0] for r in contains_text(df, "success").collect()) == ["successful", "x,success"]


def test_lines_keep_empty(spark):
    df = spark.createDataFrame([(1, "a\n\nb\n")], "doc_id int, text string")
    got = [r["value"] for r in lines_of(df, keep=["doc_id"]).collect()]
    assert got == ["a", "", "b", ""]
    numbered = lines_of(df, with_number=True).orderBy("line_no").collect()
    assert [r["line_no"] for r in numbered] == [0, 1, 2, 3]


def test_words_use_no_python(spark):
    df = spark.createDataFrame([("a b",)], "value string")
    plan = split_words(df).groupBy("word").count()._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
