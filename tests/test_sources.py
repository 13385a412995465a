"""FIXTURES B: readers on tiny hand-written files."""
import os
import tempfile

import pytest

from aspectra.operators import predict as PR
from aspectra.schema import require_columns
from aspectra.sources import readers as RD


def _dir():
    return tempfile.mkdtemp(prefix="aspectra-src-", dir="/tmp")


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_hotel_json_rejects_bad_rows_or_prefix(spark):
    d = _dir()
    _write(f"{d}/h1.json", '{"HotelInfo":{"HotelID":"h1"},"Reviews":[{"Ratings":{"Overall":"4.0"},"Content":"ok"},'
                           '{"Ratings":{},"Content":"x"},{"Ratings":{"Overall":"1.0"},"Content":"bad"}]}')
    default = RD.read_hotel_reviews(spark, f"{d}/*.json").orderBy("review_pos").collect()
    assert [(r.review_text, r.polarity) for r in default] == [("ok", "positive"), ("bad", "negative")]
    compat = RD.read_hotel_reviews(spark, f"{d}/*.json", compat_prefix=True).collect()
    assert [r.review_text for r in compat] == ["ok"]


def test_tagged_reviews_whole_values_by_name(spark):
    d = _dir()
    rec = ("<review>\n<unique_id>\nu1\n</unique_id>\n<rating>\n5.0\n</rating>\n<review_text>\n"
           "good and/or bad\nsecond line\n</review_text>\n</review>\n")
    _write(f"{d}/books/positive.review", rec)
    _write(f"{d}/books/negative.review", rec.replace("u1", "u2").replace("5.0", "1.0"))
    _write(f"{d}/books/unlabeled.review", rec)
    rows = {r.polarity: r for r in RD.read_tagged_reviews(spark, d).collect()}
    assert set(rows) == {"positive", "negative"}
    assert rows["positive"].review_text == "good and/or bad\nsecond line"
    assert rows["positive"].rating == 5.0 and rows["positive"].domain == "books"
    assert rows["positive"].product_name is None  # tag absent -> null, columns not shifted


def test_gold_terms_xml(spark):
    d = _dir()
    _write(f"{d}/train.xml", '<sentences><sentence id="1"><text>Good food &amp; wine</text><aspectTerms>'
                             '<aspectTerm term="food" polarity="positive" from="5" to="9"/></aspectTerms></sentence>'
                             '<sentence id="2"><text>no terms here</text></sentence></sentences>')
    rows = RD.read_gold_terms(spark, f"{d}/*.xml").collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.review_text == "Good food & wine" and r.aspect == ["food"] and r.partition == "train"
    assert (r.position[0].start, r.position[0].end) == (5, 9)


def test_gold_opinions_truncation(spark):
    d = _dir()
    xml = ('<Reviews><Review rid="1"><sentences>'
           '<sentence id="1"><text>A</text><Opinions><Opinion target="t1" polarity="positive" from="0" to="1"/></Opinions></sentence>'
           '<sentence id="2"><text>B</text></sentence>'
           '<sentence id="3"><text>C</text><Opinions><Opinion target="t3" polarity="negative" from="0" to="1"/></Opinions></sentence>'
           '</sentences></Review></Reviews>')
    _write(f"{d}/test.xml", xml)
    assert sorted(r.review_text for r in RD.read_gold_opinions(spark, f"{d}/*.xml").collect()) == ["A", "C"]
    assert [r.review_text for r in RD.read_gold_opinions(spark, f"{d}/*.xml", compat_truncate=True).collect()] == ["A"]
    with pytest.raises(ValueError):
        RD.read_gold_opinions(spark, f"{d}/*.xml", year="2017")


def test_legacy_list_csv_and_app_join(spark):
    d = _dir()
    _write(f"{d}/gold.csv", "review_text;aspect\nfood ok;['food']\nbad;['it''s']\nnone;[]\n")
    rows = {r.review_text: r.aspect for r in RD.read_gold_csv(spark, f"{d}/gold.csv").collect()}
    assert rows["food ok"] == ["food"] and rows["none"] == [] and rows["bad"] is None
    _write(f"{d}/apps.csv", "App,Category\nA1,x\nA1,y\nA2,z\n")
    _write(f"{d}/rev.csv", 'App,Translated_Review,Sentiment,Sentiment_Polarity,Sentiment_Subjectivity\n'
                           'A1,"nice, really",Positive,0.5,0.1\nA3,lost,Negative,-0.5,0.1\n')
    out = RD.read_app_reviews(spark, f"{d}/apps.csv", f"{d}/rev.csv").collect()
    assert len(out) == 2 and out[0].review_text == "nice, really" and out[0].polarity == "positive"
    assert len(RD.read_app_reviews(spark, f"{d}/apps.csv", f"{d}/rev.csv", dedupe_apps=True).collect()) == 1


def test_rejects_and_required_columns(spark):
    df = spark.createDataFrame([(1, None), (2, "  \n"), (3, "fine")], "review_id long, review_text string")
    assert sorted((r.review_id, r.reason) for r in PR.reject_reviews(df).collect()) == \
        [(1, "null_text"), (2, "blank_text")]
    with pytest.raises(ValueError):
        require_columns(df, ["review_id", "aspect"], "test")


def test_reviews_dataset_legacy_csv(spark):
    d = _dir()
    _write(f"{d}/reviews_dataset.csv", ";source;product_name;review_text;rating;polarity\n"
                                       "0;google-play;A1;nice app;0.5;positive\n"
                                       "1;lara-tripadvisor;h1;;1.0;negative\n")
    rows = RD.read_reviews_dataset(spark, f"{d}/reviews_dataset.csv").orderBy("product_name").collect()
    assert [(r.source, r.product_name, r.rating, r.polarity) for r in rows] == \
        [("google-play", "A1", 0.5, "positive"), ("lara-tripadvisor", "h1", 1.0, "negative")]
    assert rows[1].review_text is None  # dropped later by the null-text filter (P4)
