import corpus_pipeline as P



def test_stages(spark, tmp_path):
    text = {"en": "the cat and the dog are in the house with them and they will not be there again", "de": "der hund und die katze sind nicht mit ihnen im haus und sie werden nie wieder da sein"}
    item = "which of these seven statements about the river is true when the bridge has been closed"
    rows = [(10 * i + k, " ".join([*(f"{w}" if (i + j) % 3 else w + "x" * (i % 5) for j, w in enumerate(t.split())), f"nr{i}", *t.split()[i % 7 :]]), g, "s", 1) for i in range(12) for k, (g, t) in enumerate(text.items())]
    rows += [(500, "12 34 !!", "en", "s", 1), (501, None, "en", "s", 1), (502, rows[0][1], "en", "s", 1), (503, "a clean start of it\n" + item.upper() + "\nand the end of the house", "en", "s", 1), (504, "\n" + rows[0][1], "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for k, (name, stage) in enumerate(P.STAGES):
        now = stage(spark, now, str(tmp_path))
        now.write.parquet(f"{tmp_path}/{k}")
        now = spark.read.parquet(f"{tmp_path}/{k}")
        if k + 1 < len(P.STAGES):
            assert now.columns == docs.columns
        kept[name] = {r.doc_id for r in now.select("doc_id").collect()}
    everything = {r[0] for r in rows}
    assert kept["language_id"] == everything - {500, 501}
    assert 502 not in kept["line_dedup"] and 504 not in kept["line_dedup"] and 503 in kept["line_dedup"]
    assert kept["jaccard_join"] <= kept["line_dedup"] and 503 in kept["jaccard_join"]
    assert kept["decontamination"] == kept["jaccard_join"] - {503}
    assert kept["bpe"] == kept["decontamination"]
    assert {r.doc_id for r in P.run(spark, str(tmp_path)).collect()} == kept["bpe"]


def written(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, "which of these seven statements about the river is true when the bridge has been closed")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_clashing_columns_nulls_and_ties(spark, tmp_path):
    text = "the cat and the dog are in the house with them and they will not be there again"
    more = "der hund und die katze sind nicht mit ihnen im haus und sie werden nie wieder da sein"
    names = "lang_pred string, score string, n_lines int, n_dropped int, k1 int, component_id int"
    clash = ("p", "q", 1, 2, 3, 4)
    rows = [(None, text, "en", "s", 1, *clash), (5, more, "de", None, None, *clash), (5, more, "de", None, None, *clash), (6, "the rain will be in the house " * 3000, "en", "s", 2, *clash), (7, "", None, "s", 0, *clash)]
    written(spark, tmp_path, rows, f"doc_id long, text string, lang string, source string, n_chars long, {names}")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = now.columns
    for k, (_, stage) in enumerate(P.STAGES[:-1]):
        stage(spark, now, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        now = spark.read.parquet(f"{tmp_path}/{k}")
        assert now.columns == columns
    got = now.collect()
    assert sorted((r.doc_id is not None, r.doc_id) for r in got) == [(False, None), (True, 5), (True, 6)]
    assert all((r.lang_pred, r.score, r.n_lines, r.n_dropped, r.k1, r.component_id) == clash for r in got)
    assert P.encode(spark, now, str(tmp_path)).count() == 3


def test_empty_table(spark, tmp_path):
    written(spark, tmp_path, [], "doc_id long, text string, lang string, source string, n_chars long")
    assert P.run(spark, str(tmp_path)).collect() == []
