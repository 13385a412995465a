"""Rules inside the rows of sentences that may hold a finding: same rows as the relational rules,
no cached table, also where ids repeat or are null."""
import pytest
from pyspark.sql import functions as F

from aspectra.functions import text as TX
from aspectra.operators import annotate as A
from aspectra.operators import inrow as I
from aspectra.operators import rules as R
from aspectra.operators import spans as SP
from aspectra.plans import queries as Q

TEXTS = [
    "The food was not good. It was terrible, really. no comfortable rooms!", "We loved New York City Hotel. Great Big Apple was wonderful",
    "Nothing here. Plain words only, of all kinds; 12 of them", "breakfast was delivered terribly late, the staff wasn't helpful",
    "menu wow. staff thanks! The BEAUTIFUL Room", "ISN'T couldn't isn'ts. they quickly cleaned it. it wasn't", "'s is. `are` 'they're nice", None, " . ",
    "this is garbage. These are lovely, reliable and famous places", "staff remained helpful", "service was amazingly quickly provided by John Smith",
]


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("sf")
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, TEXTS[0]), (1, TEXTS[1])]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(rows[:len(TEXTS)], "doc_id long, text string").write.parquet(f"{path}/once/documents.parquet")
    return str(path)


@pytest.fixture(scope="module")
def table(spark, sf):
    return A.annotate_corpus(Q.reviews(spark, sf).repartition(2, "review_id"), assume_partitioned=True)[1:]


def _same(a, b):
    a = Q.finalize(a)
    rows = lambda d: sorted(map(repr, map(tuple, d.collect())))
    assert rows(a) == rows(Q.finalize(b).select(*a.columns))


@pytest.mark.parametrize("n", [1, 3, 4, 5, 6])
def test_rules_equal_and_cache_nothing(spark, sf, table, n):
    t = Q._copula_tokens(table[1]) if n in (5, 6) else table[1]
    _same(Q.QUERIES[f"rule_r{n}"](spark, sf), R.rule_by_number(t, n).drop("rule_no"))
    plan = Q.QUERIES[f"rule_r{n}"](spark, f"{sf}/once")._jdf.queryExecution().optimizedPlan().toString()
    assert "InMemoryRelation" not in plan and "Join" not in plan and "Window" not in plan


def test_named_findings_equal(spark, sf, table):
    s, t = table
    a = R.map_pronouns(R.all_rules(t))
    _same(Q.q_aspect_canonical(spark, sf), R.canonical_aspects(a, R.synonym_table(spark)).select(
        *A.SENT_KEYS, "rule_no", "ord_i", "aspect", "canonical", "kind"))
    _same(Q.q_entity_match(spark, sf), R.entity_match(a, A.entities(t)).select(*A.SENT_KEYS, "rule_no", "ord_i", "aspect_idx", "aspect"))
    w = SP.aspect_window(R.all_rules(t), s, t.select(*A.SENT_KEYS, "i", "idx", "text"), 6, True)
    _same(Q.QUERIES["aspect_window_compat"](spark, sf), w.select(
        *A.SENT_KEYS, "rule_no", "ord_i", "aspect_i", "win_left", "win_right", "aspect_sentence"))


def test_sentences_left_out_hold_no_finding(spark, table):
    s, t = table
    left_out = {n: {tuple(r) for r in s.filter(~A.may_find(F.col("sentence"), n)).select(*A.SENT_KEYS).collect()} for n in (*range(1, 8), None)}
    found = [tuple(r) for r in R.all_rules(t).select(*A.SENT_KEYS, "rule_no").collect()]
    copula = [tuple(r) for r in R.all_rules(Q._copula_tokens(t)).filter("rule_no in (5, 6)").select(*A.SENT_KEYS, "rule_no").collect()]
    assert {n for _, _, n in found + copula} == set(range(1, 8))
    assert not [r for r in found + copula if r[:2] in left_out[r[2]]]
    assert not [r for r in found if r[:2] in left_out[None]] and left_out[None]
    assert s.filter(TX.token_count(F.col("sentence")) != F.col("n_tokens")).count() == 0


def test_skipped_sentences_are_not_tagged(spark, sf):
    """Extraction tags the sentences that may hold a finding, and no others."""
    plan = I.extract(A.split_sentences(Q.reviews(spark, sf)))._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "length(regexp_replace(" in plan


def test_words_for_the_tagger_are_not_linked(spark, sf):
    s, w = A.word_corpus(Q.reviews(spark, f"{sf}/once"))
    assert w.columns == [*A.SENT_KEYS, "i", "text"] and s.columns == [*A.SENT_KEYS, "n_tokens"]
    _same(w, A.tokenize(A.split_sentences(Q.reviews(spark, f"{sf}/once"), num_partitions=2)).select(*A.SENT_KEYS, "i", "text"))
