"""Line removal against hand-made cases and the SQL over the sample tables."""

from earshot.llm.line_dedup import dedup_lines


def rows(spark, data, schema="doc_id long, text string, source string, n_lines string"):
    return spark.createDataFrame(data, schema)


def cleaned(df):
    return {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in df.collect()}


def test_first_occurrence_stays(spark):
    data = [(i, f"own {i}\n  shared line \n\nend {i}", f"s{i % 4}", "x") for i in range(1, 9)]
    got = cleaned(dedup_lines(rows(spark, data), sites=4))
    assert got[1] == ("own 1\n  shared line \n\nend 1", 4, 0)
    assert got[5] == ("own 5\n\nend 5", 4, 1)
    assert sum(r[2] for r in got.values()) == 7


def test_sites_count_not_documents(spark):
    data = [(i, "again", "one site", None) for i in range(50)]
    assert all(r[2] == 0 for r in cleaned(dedup_lines(rows(spark, data), sites=2)).values())


def test_threshold_is_exact_around_the_sketch_error(spark):
    data = []
    for n in range(90, 111):
        data += [(1000 * n + k, f"line on {n}", f"site {k}", None) for k in range(n)]
    got = dedup_lines(rows(spark, data), sites=100)
    removed = {r["doc_id"] // 1000 for r in got.where("n_removed > 0").collect()}
    assert removed == set(range(100, 111))


def test_nulls_blanks_repeats_and_long_texts(spark):
    data = [
        (1, None, "a", None), (2, "", "b", None), (3, "\n \n", "c", None), (4, "x", None, None), (5, "x", None, None),
        (6, "dup\ndup", "a", None), (7, "dup", "b", None), (7, "dup", "b", None), (None, "dup\nkeep", "c", None),
        (8, "long\n" * 20000 + "dup", "d", None),
    ]
    got = cleaned(dedup_lines(rows(spark, data), sites=3))
    assert got[1] == (None, 0, 0) and got[2] == ("", 1, 0) and got[3] == ("\n \n", 3, 0)
    assert got[4] == ("x", 1, 0)  # a null site is no site
    assert got[6] == ("dup", 2, 1) and got[7] == ("", 1, 1) and got[None] == ("keep", 2, 1)
    assert got[8][2] == 1
    assert dedup_lines(rows(spark, data).limit(0), sites=3).count() == 0


def test_keeps_all_columns_and_uses_no_python(spark):
    df = dedup_lines(rows(spark, [(1, "a", "b", "c")]))
    assert df.columns == ["doc_id", "text", "source", "n_lines", "n_removed"]
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_names_used_inside_do_not_clash(spark):
    names = ("drop", "drop_id", "stay", "_stay", "line", "keep_id", "place", "site", "first", "n_removed", "_in0")
    data = [(i, f"own {i}\nshared", f"s{i}", *names) for i in range(1, 5)]
    schema = "doc_id long, text string, source string, " + ", ".join(f"`{n}` string" for n in names)
    df = spark.createDataFrame(data, schema)
    kept = dedup_lines(df, sites=3, removed_out="gone")
    assert kept.columns == [*df.columns, "n_lines", "gone"]
    for r in kept.collect():
        assert tuple(r[n] for n in names) == names
        assert (r.text, r.n_lines, r.gone) == ((f"own {r.doc_id}\nshared", 2, 0) if r.doc_id == 1 else (f"own {r.doc_id}", 2, 1))


def test_the_pipeline_stage_keeps_the_callers_counts(spark, sf_dir):
    from corpus_pipeline import drop_boilerplate

    data = [(i, f"own {i}\nshared", f"s{i}", 100 + i, "mine", 7) for i in range(1, 12)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string, n_lines long, n_removed string, n_chars long")
    got = drop_boilerplate(spark, df, sf_dir)
    assert got.columns == df.columns
    rows = {r.doc_id: r for r in got.collect()}
    assert all(r.n_lines == 100 + i and r.n_removed == "mine" for i, r in rows.items())
    assert rows[1].n_chars == 7 and rows[5].n_chars == len("own 5")
