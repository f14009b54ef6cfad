"""The corpus pipeline on planted documents, and the registered queries of the training-data operators."""

import random

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from dnsight.llm import queries
from tests.conftest import SF_SMALL
from workload.compare import difference, duck_connection

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def sentence(count):
    return " ".join(f"w{random.randrange(4000)}" for _ in range(count))


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Clean documents, near copies, a repeated line, a benchmark passage, odd rows."""
    random.seed(12)
    folder = str(tmp_path_factory.mktemp("planted"))
    clean = [(k, "\n".join(sentence(40) for _ in range(3))) for k in range(1, 31)]
    near = clean[0][1].replace("\n", " ").split()
    near[5], near[80] = "other", "words"
    passage, repeated = sentence(30), sentence(60)
    rows = clean + [
        (100, " ".join(clean[0][1].split())), (101, " ".join(near)),
        (102, f"{repeated}\n{sentence(40)}"), (103, f"{sentence(45)}\n{repeated}"),
        (104, f"{sentence(20)} {passage} {sentence(20)}"), (105, clean[3][1]), (106, None), (107, ""),
    ]
    rows = [(d, t, "en", "s", len(t) if t is not None else None) for d, t in rows]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(1, 31)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def stages(spark, folder):
    docs, after = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, folder)
        after[name] = docs.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == COLUMNS
    return after


def test_stages_on_planted_documents(spark, planted):
    after = stages(spark, planted)
    ids = {name: {r.doc_id for r in rows} for name, rows in after.items()}
    clean = set(range(2, 31))
    assert ids["quality_classifier"] >= clean | {106, 107}
    lean = {r.doc_id: r.text for r in after["line_dedup"]}
    assert 105 not in lean and lean[102].count("\n") == 1 and "\n" not in lean[103] and lean[107] == ""
    assert all(r.n_chars == len(r.text) for r in after["line_dedup"] if r.text is not None)
    assert len(ids["near_duplicates"] & {1, 100, 101}) == 1
    assert ids["near_duplicates"] >= clean | {102, 103, 104}
    assert 104 not in ids["decontamination"] and ids["decontamination"] >= clean
    assert ids["packing"] == ids["decontamination"]


def test_contaminated_rows_go_without_a_copy_of_the_others(spark, planted, monkeypatch):
    from dnsight.sources import storage

    kept, real = [], storage.stage
    monkeypatch.setattr(storage, "stage", lambda df: kept.append(real(df)) or kept[-1])
    docs = spark.read.parquet(f"{planted}/documents.parquet")
    left = {r.doc_id for r in corpus_pipeline.drop_contaminated(spark, docs, planted).collect()}
    assert left == {r.doc_id for r in docs.collect()} - {104}
    assert [(t.columns, t.count()) for t in kept] == [(["__own"], 1)]


def test_rows_with_null_and_repeated_ids(spark, planted):
    random.seed(13)
    passage = spark.read.parquet(f"{planted}/benchmark.parquet").first().text
    one, two, three, four = (sentence(40) for _ in range(4))
    rows = [(1, one), (1, one), (2, one), (None, one), (None, two), (None, two), (3, three), (3, four), (4, ""), (5, None)]
    table = lambda rows: spark.createDataFrame(
        [(d, t, "en", "s", None) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long"
    )
    order = lambda rows: sorted(((r[0], r[1]) for r in rows), key=str)
    kept = corpus_pipeline.keep_one_of_each(spark, table(rows), planted)
    assert kept.columns == COLUMNS
    assert order(kept.collect()) == order([(1, one), (None, two), (3, three), (3, four), (4, ""), (5, None)])
    clean = [(None, one), (6, two), (6, two), (7, three), (None, None)]
    bad = [(None, passage), (7, passage), (8, passage), (8, passage)]
    kept = corpus_pipeline.drop_contaminated(spark, table(clean + bad), planted)
    assert kept.columns == COLUMNS
    assert order(kept.collect()) == order(clean)


def test_stages_on_odd_tables(spark, planted):
    """Columns named like those of the operators, a very long text, nulls, and no rows at all."""
    random.seed(14)
    names = ["score", "predicted", "component_id", "contaminated", "removed", "n_words", "class", "doc"]
    long = "\n".join(sentence(50) for _ in range(2000))
    rows = [(1, sentence(60)), (2, long), (3, None), (None, ""), (5, sentence(40)), (5, sentence(40))]
    odd = spark.createDataFrame([(d, t, "en", "s", None, *range(8)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` long" for n in names))
    for docs, count in ((odd, len(rows)), (odd.filter("false"), 0)):
        for name, function in corpus_pipeline.STAGES[:-1]:
            docs = function(spark, docs, planted)
            assert docs.columns == odd.columns
            assert docs.count() == count, name
            if count:
                assert {tuple(r)[5:] for r in docs.collect()} == {tuple(range(8))}
        pieces = corpus_pipeline.pack_sequences(spark, docs, planted)
        assert {r.doc_id for r in pieces.select("doc_id").collect()} == ({1, 2, 3, None, 5} if count else set())


def test_run_gives_the_last_stage(spark, planted):
    rows = corpus_pipeline.run(spark, planted).collect()
    expected = stages(spark, planted)["packing"]
    key = lambda r: (r.doc_id, r.piece, r.length, r.ids_crc32)
    assert sorted(map(key, rows)) == sorted(map(key, expected))


def test_all_are_registered():
    names = entry.queries()
    assert set(queries.ENTRIES) | {"pipeline"} <= set(names)
    assert {int(n[2:].split("_")[0]) for n in queries.ENTRIES} == set(range(1, 14))


WITH_SQL = sorted(name for name, (_, sql) in queries.ENTRIES.items() if sql)


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_against_sql(spark, name):
    run, sql = queries.ENTRIES[name]
    assert difference(run(spark, SF_SMALL), duck_connection(SF_SMALL), sql) is None


@pytest.mark.parametrize("name", sorted(set(queries.ENTRIES) - set(WITH_SQL)))
def test_query_runs(spark, name):
    documents = spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    rows = queries.ENTRIES[name][0](spark, SF_SMALL).count()
    assert rows >= documents if name == "op5_packing" else rows == documents
