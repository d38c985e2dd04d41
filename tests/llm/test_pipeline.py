import inspect
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from brightwash.llm import pii, simhash
from brightwash.llm.common import table, written
from brightwash.llm.queries import QUERIES
from llm_fixtures import make_docs, prose, rng  # noqa: F401

SF001 = "/root/testdata/sf0.001"


def test_registered():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {q.partition("_")[0] for q in names if q.startswith("op")} 
    assert names["pipeline"] is corpus_pipeline.run and set(QUERIES) <= set(names)
    for _, stage in corpus_pipeline.STAGES:
        assert list(inspect.signature(stage).parameters) == ["spark", "docs", "sf_dir"]


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF001, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, SF001), name)
        out.append((before, docs))
    return dict(zip([n for n, _ in corpus_pipeline.STAGES], out))


def ids(frame):
    return sorted(r.doc_id for r in frame.select("doc_id").collect())


def test_stages_return_the_columns_of_documents(spark, stages):
    columns = table(spark, SF001, "documents").dtypes
    assert all(after.dtypes == columns for name, (_, after) in stages.items() if name != "pack")


def test_language_id_keeps_documents_with_letters(stages):
    before, after = stages["language_id"]
    assert ids(after) == sorted(r.doc_id for r in before.collect() if any(c.isalpha() for c in r.text or ""))


def test_one_of_each_group_stays(stages):
    before, after = stages["simhash_dedup"]
    groups = simhash.near_duplicates(before)
    assert ids(after) == ids(groups.filter("doc_id = component_id"))


def test_contaminated_documents_go(spark, stages):
    before, after = stages["decontaminate"]
    flat = lambda t: " ".join("".join(c if c.isalnum() else " " for c in t.lower()).split())
    items = [flat(r.text) for r in table(spark, SF001, "benchmark").collect()]
    leaked = {r.doc_id for r in before.collect() if any(i in flat(r.text) for i in items)}
    assert leaked and set(ids(after)) == set(ids(before)) - leaked


def test_personal_data_is_redacted(stages):
    before, after = stages["redact_pii"]
    assert ids(before) == ids(after)
    texts = {r.doc_id: r for r in before.collect()}
    changed = 0
    for r in after.collect():
        assert not pii.base_spans(r.text) and (r.text == texts[r.doc_id].text or r.n_chars == len(r.text))
        changed += r.text != texts[r.doc_id].text
    assert changed


def test_pieces_cover_every_kept_document(stages):
    before, after = stages["pack"]
    assert ids(before) == sorted(set(ids(after)))
    bad = after.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert bad.filter("n <> end or n > 4096").isEmpty()


def test_null_ids_and_repeated_rows(spark, make_docs, rng):
    text, other = prose(rng, 80), prose(rng, 80)
    docs = make_docs([text, text, text, other, other, prose(rng, 50), None, "", "42"], ids=[None, 9, 9, None, None, None, 1, 2, 3])
    first = corpus_pipeline.language_id(spark, docs.withColumn("lang", F.lit("en")), SF001)
    assert first.count() == 6
    kept = corpus_pipeline.simhash_dedup(spark, first, SF001).collect()
    assert sorted((r.doc_id or -1, r.text) for r in kept) == sorted([(9, text), (-1, other), (-1, kept_text(docs, 5))])
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF001).count() == 0


def kept_text(docs, at):
    return docs.collect()[at].text


def test_held_out_marks(spark):
    rows = QUERIES["op8_langid"](spark, SF001).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    lang = {r.doc_id: r.lang for r in table(spark, SF001, "documents").collect()}
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)


def test_unlabelled_corpus_is_kept(make_docs, spark, rng):
    docs = make_docs([prose(rng, 30), prose(rng, 30, "de"), "日本語", None, "", "42 +"])
    kept = corpus_pipeline.language_id(spark, docs, SF001)
    assert kept.dtypes == docs.dtypes
    assert sorted((r.doc_id, r.lang) for r in kept.collect()) == [(0, None), (1, None), (2, None)]


OWN = ["score", "matches", "spans", "redacted", "lang_pred", "base_sha256", "n_email", "__text", "__row", "row", "doc", "rest", "a.b"]


def test_stages_leave_other_columns_alone(spark, make_docs, rng):
    """Columns with the names of an operator's results, or of those that stages
    use inside, come back as they were, in their place."""
    same = prose(rng, 60)
    texts = [same, same, prose(rng, 4000), "mail ann.lee@example.org now " + prose(rng, 30), None, "", prose(rng, 20, "de")]
    docs = make_docs(texts, ["en", None, "en", "en", "en", "en", "de"]).drop("n_chars")
    docs = docs.select(*[F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")).alias(c) for c in OWN[:6]], "*",
                       F.lit(7).cast("long").alias("n_chars"), *[F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")).alias(c) for c in OWN[6:]])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(docs, "before")
        after = written(stage(spark, docs, SF001), name)
        assert after.dtypes == docs.dtypes
        for r in after.collect():
            assert [r[c] for c in OWN] == [f"{c}-{r.doc_id}" for c in OWN]
        docs = after
    left = {r.doc_id: r for r in docs.collect()}
    assert sorted(left) == [0, 2, 3, 6] and left[2].text == texts[2] and left[3].text.startswith("mail [EMAIL] now")
    assert left[3].n_chars == len(left[3].text) and left[0].n_chars == 7
    assert corpus_pipeline.pack(spark, docs, SF001).count() >= 4
