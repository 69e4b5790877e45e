"""Every operator on rows with nulls, repeats, clashing columns, and on empty tables."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from jobstrata.llm import bpe, exact_dedup, fingerprints, language_id, line_dedup, packing, quality, simhash_dedup, url_filter, warc
from jobstrata.llm.queries import URL_RULES, vocabulary
from tests.llm import odd

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def docs(spark):
    return odd.frame(spark).cache()


def ids(df):
    return Counter(row["doc_id"] for row in df.select("doc_id").collect())


ALL = Counter(row[0] for row in odd.rows())


def labels(spark, rows):
    return spark.createDataFrame(rows, LABELS)


def test_language(spark, docs):
    found = language_id.predict(docs, language_id.learn(docs), ["doc_id"])
    assert ids(found) == ALL
    by = {row["doc_id"]: row for row in found.collect()}
    assert all(by[k]["lang_pred"] == "und" and by[k]["score"] == 0 for k in (0, 1, 2, 3))
    assert by[8]["lang_pred"] in ("en", "de") and 0 <= by[8]["score"] <= 1
    nothing = language_id.learn(docs.filter("lang is null"))
    assert {r["lang_pred"] for r in language_id.predict(docs, nothing, ["doc_id"]).collect()} == {"und"}
    assert language_id.accept(docs, nothing).count() == len(odd.rows())
    kept = language_id.accept(docs, language_id.learn(docs), 0.0)
    assert kept.columns == docs.columns and set(ids(kept)) == set(ALL) - {0, 1, 2, 3, None} | {None}
    assert {r["score"] for r in kept.collect()} == {7.5}


def test_simhash(spark, docs):
    found = simhash_dedup.near_duplicates(docs)
    assert ids(found) == ALL
    by = {row["doc_id"]: row for row in found.filter("doc_id <> 6").collect()}
    assert by[0]["fingerprint"] == "0" * 16 and {by[k]["component_id"] for k in (0, 1, 2)} == {0}
    assert {r["component_id"] for r in found.filter("doc_id = 6").collect()} >= {6} and by[7]["component_id"] == 6
    kept = simhash_dedup.deduplicate(docs)
    # The row without id and text is linked to row 0; that with a text of its own stays.
    assert kept.columns == docs.columns and not {1, 2, 7} & set(ids(kept)) and ids(kept)[None] == 1
    # Row 6 stays once, and so does the other text under its id, which nothing is linked to.
    assert Counter(r["text"] for r in kept.filter("doc_id = 6").collect()) == {odd.TEXTS[6]: 1, "another text under one id": 1}


def test_rows_under_one_id(spark):
    rows = [(1, "a b c d"), (2, "a b c d"), (2, "something else here now"), (None, "no id here at all"), (None, "no id here at all"), (3, "x"), (3, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_row_key", F.lit("k"))
    kept = simhash_dedup.deduplicate(docs)
    assert sorted(map(repr, ((r["doc_id"], r["text"], r["_row_key"]) for r in kept.collect()))) == sorted(
        map(repr, [(1, "a b c d", "k"), (2, "something else here now", "k"), (None, "no id here at all", "k"), (3, "x", "k")])
    )


def test_clashing_names_inside(spark):
    rows = [(k, "one long line of words here\nand another line of words", "en" if k % 2 else "de") for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for name in ("_gone", "_n_lines", "_n_dropped", "_score", "_lang_pred", "score", "lang_pred", "_row_gone"):
        docs = docs.withColumn(name, F.lit(f"own {name}"))
    for out in (line_dedup.clean(docs), language_id.accept(docs, language_id.learn(docs), 0.0), simhash_dedup.deduplicate(docs)):
        assert out.columns == docs.columns and all(r[x] == f"own {x}" for r in out.collect() for x in docs.columns[3:])


def test_more_languages_than_one_alphabet(spark):
    names = [f"l{k:02d}" for k in range(70)]
    rows = [(10 * k + i, " ".join(f"{chr(97 + k % 26)}{chr(97 + k // 26)}word{j}" .replace("0", "q").replace("1", "r").replace("2", "s") for j in range(3)), x) for k, x in enumerate(names) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.learn(docs)
    assert model.languages == names
    found = {r["doc_id"]: r["lang_pred"] for r in language_id.predict(docs, model, ["doc_id"]).collect()}
    assert sum(found[d] == x for d, _, x in rows) > 200


def test_copies_are_drawn_one_by_one(spark):
    docs = spark.range(4000).selectExpr("id doc_id", "'the same words in every row' text", "'en' lang")
    sample, _ = language_id._sample(docs.select("lang", "text", F.col("doc_id").cast("string").alias("drawn_by")), 1000)
    assert 800 < sample.count() < 1200


def test_fingerprints(spark, docs):
    found = fingerprints.compare_edited(docs, every=2)
    assert ids(found) == ALL
    rows = found.collect()
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    assert all((r["near_docs"] is not None) == (r["doc_id"] is not None and r["doc_id"] % 2 == 0) for r in rows)
    by = {r["doc_id"]: r for r in rows}
    assert by[0]["fingerprint"] == "0" * 32 == by[1]["fingerprint"] and by[0]["n_chars"] == 0


def test_quality(spark, docs):
    known = labels(spark, [(6, 1, 0), (6, 0, 0), (7, 1, 0), (3, 0, 0), (8, None, None), (None, 1, 1), (11, 0, 1)])
    found = quality.classify(docs, known, F.coalesce(F.col("doc_id") % 5 == 0, F.lit(False)))
    assert ids(found) == ALL
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in found.collect())
    alone = quality.classify(docs, labels(spark, [(6, 1, 0)]), F.lit(False))
    assert {r["score"] for r in alone.collect()} == {1.0}
    none = quality.classify(docs, labels(spark, []), F.lit(False))
    assert {r["score"] for r in none.collect()} == {0.5}


def test_bpe_and_packing(spark, docs):
    encoded = bpe.encode(docs, vocabulary())
    assert ids(encoded) == ALL
    assert ids(bpe.decode(encoded, vocabulary())) == ALL
    packed = packing.pack(docs, vocabulary(), with_ids=True)
    rows = packed.collect()
    assert set(r["doc_id"] for r in rows) == set(ALL)
    assert all(r["length"] == len(r["ids"]) == r["bucket"] and r["length"] & (r["length"] - 1) == 0 and r["offset"] == 0 for r in rows)
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    assert [r["length"] for r in rows if r["doc_id"] == 1] == [1]


def test_lines(spark, docs):
    found = line_dedup.deduplicate(docs)
    assert ids(found) == ALL
    by = {r["doc_id"]: r for r in found.collect()}
    assert by[0]["text"] is None and by[1]["text"] == "" and by[12]["n_dropped"] == 0
    cleaned = line_dedup.clean(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == len(odd.rows()) and {r["n_lines"] for r in cleaned.collect()} == {6}


def test_exact(spark, docs):
    found = exact_dedup.find_duplicates(docs)
    assert ids(found) == ALL
    by = {r["doc_id"]: r for r in found.filter("doc_id <> 6").collect()}
    # The longest original of the empty texts is the one of blanks.
    assert {by[k]["keep_id"] for k in (0, 1, 2)} == {2} and by[2]["kept"] and not by[0]["kept"] and by[0]["group_size"] == 5
    same = found.filter("doc_id = 6 and group_size = 3").collect()
    assert len(same) == 3 and all(r["kept"] for r in same)


def test_urls(spark):
    urls = [None, "", "no scheme", "://", "http://", "http://a.com", "http://COM/x", "http://Example.COM/en/?q=/", "https://x.net/es/#/fr/", "http://net/fr", "x://é.net/fr/" + "y" * 3000]
    pages = spark.createDataFrame([(k, u, None, "x", 1.0) for k, u in enumerate(urls)] + [(3, "://", None, "x", 1.0)], "page_id long, url string, html string, rule string, length double")
    by = {r["page_id"]: r for r in url_filter.judge(pages, URL_RULES).collect()}
    assert len(by) == len(urls) and all(by[k]["host"] == by[k]["path"] == "" for k in (0, 1, 2, 3, 4))
    assert (by[5]["host"], by[5]["path"], by[5]["rule"]) == ("a.com", "", None)
    assert (by[6]["host"], by[6]["rule"], by[6]["verdict"]) == ("com", "com/", "allow")
    assert (by[7]["path"], by[7]["rule"], by[7]["verdict"]) == ("/en/", "example.com/en/", "block")
    assert by[8]["rule"] == "net/es/" and by[9]["rule"] is None and by[10]["verdict"] == "block"
    assert url_filter.judge(pages.limit(0), URL_RULES).count() == 0


def test_warc(spark):
    rows = [(1, None, None, "x"), (2, "http://a/", "", "x"), (3, "http://b/", "<p>x<br>y &amp; z<script>var a='</p>';", "x"), (3, "http://b/", "<p>x<br>y &amp; z<script>var a='</p>';", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, block string")
    made = warc.derive(warc.responses(pages, "2024-01-01T00:00:00Z", ["page_id"]), ["page_id"]).collect()
    assert len(made) == 8
    assert {bytes(r["block"]) for r in made if r["page_id"] == 3 and r["warc_type"] == "conversion"} == {b"x\ny & z"}
    assert warc.derive(warc.responses(pages.limit(0), "d")).count() == 0


def test_empty_tables(spark):
    none, vocab = odd.empty(spark), vocabulary()
    known = labels(spark, [(1, 1, 0)])
    frames = [
        language_id.predict(none, language_id.learn(none), ["doc_id"]), simhash_dedup.near_duplicates(none), simhash_dedup.deduplicate(none),
        fingerprints.compare_edited(none, 100), quality.classify(none, known, F.lit(False)), bpe.encode(none, vocab), packing.pack(none, vocab),
        line_dedup.deduplicate(none), exact_dedup.find_duplicates(none),
    ]
    assert [x.count() for x in frames] == [0] * len(frames)


def test_stages(spark, docs, tmp_path):
    labels(spark, [(6, 1, 0), (13, 1, 0), (3, 0, 0), (11, 0, 1)]).write.parquet(f"{tmp_path}/labels.parquet")
    for name, source in (("odd", docs), ("none", odd.empty(spark))):
        for number, (stage, function) in enumerate(corpus_pipeline.STAGES):
            out = function(spark, source, str(tmp_path))
            if number < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == source.columns and out.dtypes == source.dtypes, stage
            out.write.parquet(f"{tmp_path}/{name}-{stage}")
            source = spark.read.parquet(f"{tmp_path}/{name}-{stage}") if number < len(corpus_pipeline.STAGES) - 1 else source
