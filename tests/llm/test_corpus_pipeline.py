from collections import Counter

import pytest
from llm import brute
from llm.test_operators import edited, prose

import corpus_pipeline

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "web", len(t or "")) for i, t in rows], DOCS).repartition(3)


def test_one_document_of_each_group_stays_without_words_or_id(spark, rows):
    one, two, three = prose(1, 200), prose(2, 200), prose(3, 200)
    near = " ".join(edited(two.split(), 0.85, True, 9))
    docs = [
        (7, ""), (5, " \n "), (6, None), (5, " \n "), (None, ""), (None, None), (None, " "),
        (None, one), (None, one), (None, near), (8, two), (9, three), (9, three),
    ]
    assert brute.jaccard(two, near) >= 0.8
    got = corpus_pipeline.simhash_near_dedup(spark, frame(spark, docs), "")
    assert rows(got, "doc_id", "text") == sorted([(5, " \n "), (None, one), (8, two), (9, three)], key=repr)
    assert got.columns == corpus_pipeline.COLUMNS
    alone = corpus_pipeline.simhash_near_dedup(spark, frame(spark, [(None, ""), (None, None), (None, "")]), "")
    assert len(rows(alone)) == 1


# --- the stages, each on rows of every kind ----------------------------------------------

@pytest.fixture(scope="module")
def mixed(spark):
    """Clean, junk and toxic documents, copies, shared passages, and odd rows; with labels of four in five."""
    passage = prose(77, 130)
    texts = {i: prose(i, 90) + "." for i in range(300)}
    texts |= {i: texts[i].replace(" ", " ## ") for i in range(0, 300, 5)}
    texts |= {i: texts[i] + " you stupid worthless idiots" for i in range(1, 300, 5)}
    texts |= {300: texts[2], 301: texts[2], 302: texts[3] + " more", 303: passage + " " + prose(400, 90), 304: prose(401, 90) + " " + passage}
    texts |= {310: None, 311: "", 312: "word", 313: "of the and " * 20_000}
    rows = [(i, t, "en", "s", len(t) if t is not None else None) for i, t in texts.items()] + [(None, texts[4], None, None, None)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    labels = [(i, int(i % 5 != 0), int(i % 5 == 1)) for i in range(300) if i % 7]
    return docs, spark.createDataFrame(labels + [(None, 1, 1), (9, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def folder(mixed, tmp_path_factory):
    path = tmp_path_factory.mktemp("sf")
    mixed[0].write.parquet(str(path / "documents.parquet"))
    mixed[1].write.parquet(str(path / "labels.parquet"))
    return str(path)


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def test_the_quality_stage_drops_junk_and_keeps_the_rest(spark, mixed, folder):
    kept = corpus_pipeline.quality_classifier(spark, mixed[0], folder)
    assert kept.columns == corpus_pipeline.COLUMNS
    junk = set(range(0, 300, 5))
    found = ids(kept)
    assert len(junk & found.keys()) <= 2 and len(set(range(300)) - junk - found.keys()) <= 2
    assert {300, 301, 302} <= found.keys() and found[None] == 2


def test_the_toxicity_stage_drops_toxic_documents_only(spark, mixed, folder):
    found = ids(corpus_pipeline.toxicity_classifier(spark, mixed[0], folder))
    toxic = set(range(1, 300, 5))
    assert len(toxic & found.keys()) <= 2 and set(range(300)) - toxic <= found.keys()
    assert {310, 311, 312, 313} <= found.keys() and found[None] == 2


def test_the_repeat_stage_is_brute_force_on_bytes(spark, mixed, folder):
    docs = mixed[0].filter("doc_id IS NOT NULL AND doc_id <> 313")
    got = {r.doc_id: (r.text, r.lang, r.source, r.n_chars) for r in corpus_pipeline.suffix_dedup(spark, docs, folder).collect()}
    plain = brute.repeats([(r.doc_id, r.text) for r in docs.collect()], corpus_pipeline.REPEAT_BYTES)
    assert {i: x[0] for i, x in got.items()} == {i: x[3].decode() for i, x in plain.items()}
    assert all(x[1:] == ("en", "s", len(x[0])) for x in got.values())
    assert len(got[303][0]) < 700 and got[2][0] == ""


def test_the_packing_stage_packs_every_document(spark, mixed, folder):
    packed = corpus_pipeline.best_fit_packing(spark, mixed[0], folder)
    assert ids(packed.filter("piece = 0")) == ids(mixed[0])
    assert packed.agg({"length": "max"}).first()[0] <= 2048


def test_a_whole_run_and_runs_without_documents_or_labels(spark, mixed, folder, tmp_path):
    found = ids(corpus_pipeline.run(spark, folder).filter("piece = 0"))
    gone = set(range(0, 300, 5)) | set(range(1, 300, 5)) | {300, 301, 302, 311, None}
    assert len(gone & found.keys()) <= 4 and len(set(range(300)) - gone - found.keys()) <= 4
    for name, docs, labels in (("none", mixed[0].limit(0), mixed[1]), ("unlabelled", mixed[0], mixed[1].limit(0))):
        docs.write.parquet(str(tmp_path / name / "documents.parquet"))
        labels.write.parquet(str(tmp_path / name / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
    assert corpus_pipeline.run(spark, str(tmp_path / "unlabelled")).count() > 200
