"""Every stage of the pipeline against a plain version, on a small table and on odd rows."""

import struct

import pytest

import corpus_pipeline
from earshot.checks.compare import differences
from earshot.llm import decontamination, queries
from test_decontamination import distance
from test_ngram_join import plain as plain_groups

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """Rows before and after each stage, as the driver runs them: written and read again."""
    out, docs = {}, spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        after = spark.read.parquet(path)
        out[name] = (docs, after)
        docs = after
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_all_but_the_last_return_documents(stages):
    for _, after in list(stages.values())[:-1]:
        assert sorted(after.columns) == sorted(COLUMNS)


def test_quality_rejects_by_score_only(spark, sf_dir, stages):
    before, after = stages["keep_quality"]
    scores = {r["doc_id"]: r["predicted"] for r in queries.QUERIES["op8_quality_scores"](spark, sf_dir).collect()}
    assert set(texts(after)) == {i for i in texts(before) if scores[i]}
    assert 0 < after.count() < before.count()


def test_boilerplate_equals_the_sql(stages):
    import duckdb

    before, after = stages["drop_boilerplate"]
    con = duckdb.connect()
    con.register("documents", before.toPandas())
    sql = f"SELECT doc_id, text FROM ({queries.ORACLES['op5_line_dedup']}) WHERE n_removed = 0 OR trim(text, ' \n\r\t') <> ''"
    assert differences(after.select("doc_id", "text"), con, sql) == []
    assert after.where("n_chars <> length(text)").count() == before.where("n_chars <> length(text)").count()


def test_one_of_each_group_stays(stages):
    before, after = stages["keep_one_of_each_group"]
    groups = plain_groups(list(texts(before).items()), 5, 80)
    assert set(texts(after)) == {i for i, _, component in groups if i == component}


def test_contaminated_documents_go(spark, sf_dir, stages):
    before, after = stages["drop_contaminated"]
    items = [decontamination.words_of(r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    kept = set(texts(after))
    for i, text in texts(before).items():
        words = decontamination.words_of(text)
        near = [w for w in items if len(set(w) & set(words)) >= 0.6 * len(set(w))]
        assert (i in kept) != any(distance(w, words) <= int(0.2 * len(w)) for w in near)


def test_windows_hold_every_token_once(stages):
    from tokenizers import Tokenizer

    before, after = stages["pack_windows"]
    tokenizer = Tokenizer.from_file(queries.tokenizer_file("word_bpe_49k.json"))
    found, loads = {}, {}
    for r in after.collect():
        found.setdefault(r["doc_id"], []).append((r["start"], bytes(r["ids"])))
        loads.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    want = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for i, t in texts(before).items()}
    assert set(found) == set(want)
    for i, ids in want.items():
        assert b"".join(b for _, b in sorted(found[i])) == struct.pack(f"<{len(ids)}I", *ids)
    for pieces in loads.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 2048


def test_odd_rows_pass_every_stage(spark, sf_dir, tmp_path):
    rows = [
        (1, None, None, None, None), (None, "a b c", "en", "s", 5), (None, None, None, None, None), (2, "", "en", "s", 0),
        (3, " \n ", "xx", None, 3), (4, "same row", "en", "s", 8), (4, "same row", "en", "s", 8),
        (5, "word " * 30000, "en", "t", 150000), (6, "é\u0301 \x00 😀", "en", "t", 5),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        for label, part in (("rows", docs), ("none", empty)):
            path = str(tmp_path / f"{name}-{label}")
            stage(spark, part, sf_dir).write.parquet(path)
        assert spark.read.parquet(str(tmp_path / f"{name}-none")).count() == 0
    one = spark.read.parquet(str(tmp_path / "keep_one_of_each_group-rows"))
    assert sorted(str(r["doc_id"]) for r in one.collect()) == ["1", "2", "3", "4", "5", "6", "None", "None"]
