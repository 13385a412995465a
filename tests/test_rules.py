"""Hand-made token tables (FIXTURES C1) through the seven rules."""
from aspectra.operators import rules as R

# (text, dep, head, pos, tag, is_stop)
CASES = {
    1: [("The", "det", 1, "DET", "DT", True), ("food", "nsubj", 2, "NOUN", "NN", False),
        ("was", "ROOT", 2, "AUX", "VBD", True), ("not", "neg", 2, "PART", "RB", True),
        ("good", "acomp", 2, "ADJ", "JJ", False), ("but", "cc", 2, "CCONJ", "CC", True),
        ("service", "nsubj", 8, "NOUN", "NN", False), ("could", "aux", 8, "AUX", "MD", True),
        ("be", "conj", 2, "AUX", "VB", True), ("better", "acomp", 8, "ADJ", "JJR", False)],
    2: [("no", "det", 3, "DET", "DT", True), ("very", "advmod", 2, "ADV", "RB", True),
        ("interesting", "amod", 3, "ADJ", "JJ", False), ("plot", "ROOT", 3, "NOUN", "NN", False)],
    3: [("The", "det", 1, "DET", "DT", True), ("breakfast", "nsubjpass", 3, "NOUN", "NN", False),
        ("was", "auxpass", 3, "AUX", "VBD", True), ("delivered", "ROOT", 3, "VERB", "VBN", False),
        ("terribly", "advmod", 5, "ADV", "RB", False), ("late", "advmod", 3, "ADV", "RB", False)],
    4: [("This", "det", 1, "DET", "DT", True), ("phone", "nsubj", 2, "NOUN", "NN", False),
        ("is", "ROOT", 2, "AUX", "VBZ", True), ("garbage", "attr", 2, "NOUN", "NN", False)],
    5: [("menu", "nsubj", 1, "NOUN", "NN", False), ("ok", "ROOT", 1, "INTJ", "UH", False)],
    6: [("Staff", "nsubj", 2, "NOUN", "NN", False), ("never", "neg", 2, "ADV", "RB", True),
        ("made", "ROOT", 2, "VERB", "VBD", False), ("happy", "dobj", 2, "ADJ", "JJ", False)],
    7: [("room", "nsubj", 2, "NOUN", "NN", False), ("seems", "cop", 2, "VERB", "VBZ", False),
        ("spacious", "ROOT", 2, "ADJ", "JJ", False)],
    8: [("great", "amod", 1, "ADJ", "JJ", False), ("it", "ROOT", 1, "PRON", "PRP", True)],
    9: [("Hello", "ROOT", 0, "INTJ", "UH", False), ("there", "advmod", 0, "ADV", "RB", True)],
}
EXPECTED = {
    1: [("food", "not good", "r3", 1), ("service", "not better", "r3", 6)],
    2: [("plot", "not very interesting", "r1", 3)],
    3: [("breakfast", "terribly late", "r4", 1)],
    4: [("phone", "garbage", "r7", 1)],
    5: [("menu", "ok", "r6", 0)],
    6: [("Staff", "never happy", "r2", 0)],
    7: [("room", "spacious", "r5", 0)],
    8: [("product", "great", "r1", 1)],
    9: [],
}


def token_frame(spark):
    rows = []
    for rid, toks in CASES.items():
        idx = 0
        for i, (text, dep, head, pos, tag, stop) in enumerate(toks):
            rows.append((rid, 0, i, idx, text, text.lower(), pos, tag, dep, head, stop))
            idx += len(text) + 1
    return spark.createDataFrame(
        rows, "review_id long, sent_id int, i int, idx int, text string, lemma string, pos string, tag string, "
              "dep string, head_i int, is_stop boolean")


def sentence_frame(spark):
    rows = [(rid, 0, " ".join(t[0] for t in toks), len(toks)) for rid, toks in CASES.items()]
    return spark.createDataFrame(rows, "review_id long, sent_id int, sentence string, n_tokens int")


def test_rules_match_hand_worked_rows(spark):
    out = R.map_pronouns(R.all_rules(token_frame(spark))).collect()
    got = {}
    for r in out:
        got.setdefault(r.review_id, []).append((r.aspect, r.modifier, r.rule, r.aspect_i))
    for rid, exp in EXPECTED.items():
        assert sorted(got.get(rid, [])) == sorted(exp), rid


def test_compat_rule_id_for_interjection(spark):
    out = R.all_rules(token_frame(spark), compat_rule_ids=True).filter("review_id = 5").collect()
    assert [(r.aspect, r.rule) for r in out] == [("menu", "r5")]


def test_extract_aspects_null_row_and_windows(spark):
    e = R.extract_aspects(sentence_frame(spark), token_frame(spark), window=6)
    rows = {r.review_id: r for r in e.filter("review_id = 9").collect()}
    assert rows[9].aspect is None and rows[9].aspect_sentence == "Hello there"
    one = e.filter("review_id = 1").orderBy("aspect_i").collect()
    assert [r.aspect_sentence for r in one] == ["The food was not good",
                                              "was not good but service could be better"]


def test_head_children_last_and_first_wins(spark):
    hc = R.head_children(token_frame(spark)).filter("review_id = 3 AND head_i = 3").collect()[0]
    assert hc.advmod.text == "late" and hc.subj_any.text == "breakfast"
