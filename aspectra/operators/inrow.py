"""Extraction inside the sentence's row (T10, N1, N2, A5, R1-R9, W1, N3 over arrays).

The same tokens, links, rules and windows as ``annotate`` / ``rules`` / ``spans``, but a
sentence keeps its tokens as one ``array<struct>`` and every step is an array function over
it.  From the review to its findings the plan is one narrow stage: no exchange, no sort, no
window, no cached token table, on batches and streams alike.  The relational operators stay
for token tables of other annotators.

Every step is linear in the sentence.  Where a window would look up "the next noun", the
positions of the nouns are known, and each is repeated over the gap before it (``_fill``);
running sums are taken block by block, so no array is copied once per token.

Catalyst would merge neighbouring projections and put an array expression into the lambda
that reads it, evaluating it once per element; ``_step`` stands between them (an ``inline``
of one struct, which no rule moves an expression across).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import text as TX
from . import annotate as A
from . import spans as SP

K = A.SENT_KEYS
SCAN_BLOCK = 16


def _step(df: DataFrame, drop: tuple = (), **new: Column) -> DataFrame:
    """Add or replace columns; later steps read them as values, not as expressions.  The keys
    pass beside the struct, so a partitioning by them stays known."""
    kept = [F.col(c) for c in df.columns if c not in new and c not in drop and c not in K]
    return df.select(*K, F.inline(F.array(F.struct(*kept, *[e.alias(n) for n, e in new.items()]))))


def _last(array: Column) -> Column:
    return F.try_element_at(array, F.lit(-1))


def _indices(size: Column) -> Column:
    """0 .. size - 1."""
    return F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))


def _block(i: Column) -> Column:
    return F.floor(i / SCAN_BLOCK).cast("int")


def block_starts(sizes: Column, n: Column) -> Column:
    """The sum of the ``sizes`` before each block of ``SCAN_BLOCK``."""
    add = lambda x, y: x + y
    starts = F.aggregate(F.sequence(F.lit(0), _block(n - 1)), F.array(F.lit(0)), lambda acc, b: F.concat(acc, F.array(
        F.aggregate(F.slice(sizes, b * SCAN_BLOCK + 1, SCAN_BLOCK), _last(acc), add))))
    return F.when(n > 0, starts)


def running_starts(sizes: Column, blocks: Column) -> Column:
    """The sum of the ``sizes`` before each of them, from the sums before their blocks."""
    return F.transform(sizes, lambda x, i: F.aggregate(
        F.slice(sizes, _block(i) * SCAN_BLOCK + 1, i % SCAN_BLOCK), F.get(blocks, _block(i)), lambda x, y: x + y))


def _fill(lo: Column, hi: Column, positions: Column) -> Column:
    """For every i of lo .. hi the least of the (sorted) positions after i, or null."""
    return F.flatten(F.zip_with(F.concat(F.array(lo), positions), F.concat(positions, F.array(F.lit(None).cast("int"))),
                                lambda a, b: F.array_repeat(b, F.coalesce(b, hi + 1) - a)))


# ---------------------------------------------------------------------------------------
# tokens (T10, N1, N2)
# ---------------------------------------------------------------------------------------
def _pairs_of(kind: Column, which: int) -> Column:
    table = [x for k, v in A._POS_TAG.items() if v[which] is not None for x in (F.lit(k), F.lit(v[which]))]
    return F.try_element_at(F.create_map(*table), kind)


def sentence_tokens(sentences: DataFrame) -> DataFrame:
    """``split_sentences`` rows with their tokens as arrays: ``toks`` (the fields of the token
    table) and ``low`` (lower-cased texts); ``matches`` goes."""
    d = _step(sentences.select(*K, "sentence", "matches"), drop=("matches",),
              m=F.transform("matches", lambda x: F.replace(x, F.lit(TX.NT_MARK), F.lit(""))))
    d = _step(d, n=F.size("m"), sizes=F.transform("m", lambda x: F.length(x)))
    d = _step(d, blocks=block_starts(F.col("sizes"), F.col("n")))
    d = _step(d, drop=("m", "sizes", "blocks"), idx=running_starts(F.col("sizes"), F.col("blocks")), txt=F.transform("m", lambda x: F.trim(x)),
              low=F.transform("m", lambda x: F.lower(F.trim(x))))
    # every test of token_kind gives the same for a text and for its lower case
    d = _step(d, tk=F.transform("low", lambda x, i: F.struct(i.alias("i"), A.token_kind(x, lowered=True).alias("k"))),
              stop=F.transform("low", lambda x: x.isin(S.STOP_WORDS)),
              seps=F.filter(_indices(F.col("n")), lambda i: F.get("txt", i).isin(list(S.CLAUSE_CHARS))))
    ends = F.when(_last(F.col("seps")) == F.col("n") - 1, F.col("seps")).otherwise(F.concat("seps", F.array(F.col("n") - 1)))
    d = _step(d, drop=("seps",), ends=F.when(F.col("n") > 0, ends).otherwise(F.array().cast("array<int>")))
    starts = F.concat(F.array(F.lit(0)), F.transform("ends", lambda e: e + 1))
    d = _step(d, drop=("ends",), clauses=F.filter(F.zip_with(starts, F.col("ends"), lambda a, b: F.struct(
        a.alias("lo"), b.alias("hi"), F.slice("tk", a + 1, F.coalesce(b - a + 1, F.lit(0))).alias("ks"))), lambda c: c["hi"].isNotNull()))

    def of(c, *kinds):
        return F.transform(F.filter(c["ks"], lambda t: t["k"].isin(*kinds)), lambda t: t["i"])

    d = _step(d, clauses=F.transform("clauses", lambda c: F.struct(
        c["lo"].alias("lo"), c["hi"].alias("hi"), of(c, "noun").alias("nouns"), of(c, "noun", "pron").alias("names"),
        F.get(of(c, "be"), 0).alias("be"),
        F.coalesce(F.get(of(c, "verb"), 0), F.get(of(c, "be"), 0), F.get(of(c, "intj"), 0)).alias("pred"),
        F.transform(F.filter(c["ks"], lambda t: ~t["k"].isin("adv", "adj")), lambda t: t["i"]).alias("heads"))))
    d = _step(d, clauses=F.transform("clauses", lambda c: F.struct(
        c["lo"].alias("lo"), c["hi"].alias("hi"), c["pred"].alias("pred"),
        F.get("tk", c["pred"])["k"].alias("pk"), (c["be"] < c["pred"]).alias("be_before"),
        _last(F.filter(c["names"], lambda i: i < c["pred"])).alias("subj"),
        F.get(F.filter(c["nouns"], lambda i: i > c["pred"]), 0).alias("after"),
        _fill(c["lo"], c["hi"], c["nouns"]).alias("next_noun"), _fill(c["lo"], c["hi"], c["heads"]).alias("next_head"))))

    def kind_at(i):
        return F.get("tk", i)["k"]

    def dep(c, i):
        k, pred, pk = kind_at(i), c["pred"], c["pk"]
        ahead = i > pred
        return (F.when(i == pred, "ROOT")
                .when(i == c["subj"], F.when((pk == "verb") & c["be_before"], "nsubjpass").otherwise("nsubj"))
                .when(k == "noun", F.when((i == c["after"]) & (pk == "be"), "attr")
                      .when((i == c["after"]) & (pk == "verb"), "dobj").otherwise("dep"))
                .when(k == "det", "det")
                .when(k == "adj", F.when(kind_at(F.get(c["next_head"], i - c["lo"])) == "noun", "amod")
                      .when(ahead & (pk == "be"), "acomp").when(ahead & (pk == "verb"), "dobj").otherwise("dep"))
                .when(k == "adv", "advmod").when(k == "neg", "neg").when(k == "modal", "aux")
                .when(k == "be", F.when((pk == "verb") & (i < pred), "auxpass").otherwise("aux"))
                .when(k == "punct", "punct").otherwise("dep"))

    d = _step(d, drop=("clauses",), links=F.flatten(F.transform("clauses", lambda c: F.transform(
        F.sequence(c["lo"], c["hi"]), lambda i: F.struct(
            dep(c, i).alias("dep"), F.coalesce(c["pred"], i).alias("to"),
            F.when(i < c["hi"], kind_at(i + 1)).alias("next_kind"),
            F.get(c["next_noun"], i - c["lo"]).alias("next_noun"), F.get(c["next_head"], i - c["lo"]).alias("next_head"))))))

    def token(t, k):
        i, kind = k["i"], k["k"]
        head = (F.when(t["dep"] == "det", F.coalesce(t["next_noun"], t["to"])).when(t["dep"] == "amod", t["next_head"])
                .when((t["dep"] == "advmod") & t["next_kind"].isin("adj", "adv"), i + 1).otherwise(t["to"]))
        return F.struct(i.alias("i"), F.get("idx", i).alias("idx"), F.get("txt", i).alias("text"), F.get("low", i).alias("lemma"),
                        _pairs_of(kind, 0).alias("pos"),
                        F.when(kind == "punct", F.get("txt", i)).otherwise(_pairs_of(kind, 1)).alias("tag"),
                        t["dep"].alias("dep"), head.cast("int").alias("head_i"), F.get("stop", i).alias("is_stop"))

    return _step(d, drop=("links", "tk", "idx", "stop", "txt"), toks=F.zip_with("links", "tk", token))


def token_table(tokens: DataFrame) -> DataFrame:
    """``sentence_tokens`` as a token table, one row per token."""
    return tokens.select(*K, F.inline("toks"))


TOKEN_FIELDS = ("i", "idx", "text", "lemma", "pos", "tag", "dep", "head_i", "is_stop")


def retag(tokens: DataFrame, changed) -> DataFrame:
    """``toks`` with the fields that ``changed`` gives for a token (name -> column)."""
    def token(x):
        new = changed(x)
        return F.struct(*[new.get(c, x[c]).alias(c) for c in TOKEN_FIELDS])
    return _step(tokens, toks=F.transform("toks", token))


# ---------------------------------------------------------------------------------------
# rules (A5, R1-R7), entities (N3), windows
# ---------------------------------------------------------------------------------------
def _summary(h: Column, kids: Column) -> Column:
    """A5 for one head: the children that the rules ask for."""
    ref = lambda t: F.struct(t["i"].alias("i"), t["text"].alias("text"), t["idx"].alias("idx"))
    pick = lambda test: F.filter(kids, test)
    last = lambda test: _last(F.transform(pick(test), ref))
    live = lambda *deps: last(lambda t: t["dep"].isin(*deps) & ~t["is_stop"])
    modal = lambda t: (t["dep"] == "aux") & (t["tag"] == "MD")
    negs = F.transform(pick(lambda t: (t["dep"] == "neg") | modal(t)),
                       lambda t: F.when(t["dep"] == "neg", t["text"]).otherwise(F.lit("not")))
    return F.struct(
        h.alias("h"), live("nsubj").alias("nsubj"), live("nsubj", "nsubjpass").alias("subj_any"),
        last(lambda t: (t["dep"] == "dobj") & (t["pos"] == "ADJ") & ~t["is_stop"]).alias("dobj_adj"),
        live("acomp").alias("acomp"), live("advmod").alias("advmod"), live("attr").alias("attr"),
        F.get(F.transform(pick(lambda t: t["dep"] == "advmod"), lambda t: t["text"]), 0).alias("first_adv"),
        F.exists(kids, lambda t: (t["dep"] == "cop") & ~t["is_stop"]).alias("has_cop"),
        last(lambda t: t["dep"] == "neg")["text"].alias("neg"), _last(negs).alias("neg_or_modal"),
        F.exists(kids, lambda t: (t["dep"] == "det") & (t["text"] == "no")).alias("has_det_no"))


def with_heads(tokens: DataFrame) -> DataFrame:
    """Adds ``hc`` (one summary per head with children, by position) and ``at`` (per token the
    number of its summary, or null)."""
    links = F.sort_array(F.transform(F.filter("toks", lambda t: t["head_i"] != t["i"]),
                                     lambda t: F.struct(t["head_i"].alias("h"), t["i"].alias("i"))))
    d = _step(tokens, links=links)
    d = _step(d, first=F.filter(_indices(F.size("links")), lambda p: (p == 0) | (F.get("links", p)["h"] != F.get("links", p - 1)["h"])))
    stops = F.concat(F.slice("first", F.lit(2), F.size("first")), F.array(F.size("links")))
    d = _step(d, drop=("links", "first"), groups=F.when(F.size("first") > 0, F.zip_with(F.col("first"), stops, lambda a, b: F.struct(
        F.get("links", a)["h"].alias("h"),
        F.transform(F.slice("links", a + 1, b - a), lambda x: F.get("toks", x["i"])).alias("kids")))))
    d = _step(d, drop=("groups",), hc=F.transform("groups", lambda g: _summary(g["h"], g["kids"])))
    heads = F.transform("hc", lambda x, j: F.struct(x["h"].alias("h"), j.alias("j")))
    before = F.concat(F.array(F.lit(-1)), F.transform("hc", lambda x: x["h"]))
    at = F.flatten(F.zip_with(F.slice(before, F.lit(1), F.size("hc")), heads, lambda p, x: F.concat(
        F.array_repeat(F.lit(None).cast("int"), x["h"] - p - 1), F.array(x["j"]))))
    return _step(d, at=F.when(F.col("hc").isNotNull(), at))


def _finding(rule_no: int, ord_i: Column, aspect: Column, modifier: Column, rule: str) -> Column:
    return F.struct(F.lit(rule_no).alias("rule_no"), ord_i.alias("ord_i"), aspect["text"].alias("aspect"),
                    modifier.alias("modifier"), F.lit(rule).alias("rule"), aspect["idx"].alias("aspect_idx"), aspect["i"].alias("aspect_i"))


def with_findings(heads: DataFrame, compat_rule_ids: bool = False) -> DataFrame:
    """Adds ``found``: the findings of the seven rules, as an array."""
    summary = lambda i: F.get("hc", F.get("at", i))
    first = F.transform(F.filter("toks", lambda t: (t["dep"] == "amod") & ~t["is_stop"]), lambda t: _finding(
        1, t["i"], F.get("toks", t["head_i"]),
        F.concat_ws(" ", F.when(summary(t["head_i"])["has_det_no"], F.lit("not")), summary(t["i"])["first_adv"], t["text"]), "r1"))

    def others(x):
        head, nsubj = F.get("toks", x["h"]), x["nsubj"]
        nn = nsubj.isNotNull()
        adv = F.concat_ws(" ", x["neg"], summary(x["advmod"]["i"])["first_adv"], x["advmod"]["text"])
        rule = lambda cond, *f: F.when(cond, _finding(f[0], x["h"], *f[1:]))
        return F.filter(F.array(
            rule(nn & x["dobj_adj"].isNotNull(), 2, nsubj, F.concat_ws(" ", x["neg"], x["dobj_adj"]["text"]), "r2"),
            rule(nn & x["acomp"].isNotNull(), 3, nsubj, F.concat_ws(" ", x["neg_or_modal"], x["acomp"]["text"]), "r3"),
            rule(x["subj_any"].isNotNull() & x["advmod"].isNotNull(), 4, x["subj_any"], adv, "r4"),
            rule(nn & x["has_cop"], 5, nsubj, head["text"], "r5"),
            rule(nn & (head["pos"] == "INTJ") & ~head["is_stop"], 6, nsubj, head["text"], S.COMPAT_RULE6_ID if compat_rule_ids else "r6"),
            rule(nn & x["attr"].isNotNull(), 7, nsubj, F.concat_ws(" ", x["neg"], x["attr"]["text"]), "r7")), lambda r: r.isNotNull())

    rest = F.flatten(F.transform(F.filter("hc", lambda x: x["subj_any"].isNotNull()), others))
    return _step(heads, drop=("hc", "at"), found=F.when(F.col("hc").isNotNull(), F.concat(first, rest)))


def _capital(i: Column) -> Column:
    return F.coalesce((i > 0) & F.get("toks", i)["text"].rlike("^[A-Z]"), F.lit(False))


def with_entities(d: DataFrame) -> DataFrame:
    """Adds ``since``, per token the last one up to it that is in no run of capitalised tokens
    (not sentence-initial), or null without such a run."""
    d = _step(d, plain=F.filter(_indices(F.col("n")), lambda i: ~_capital(i)))
    nexts = F.concat(F.slice("plain", F.lit(2), F.size("plain")), F.array(F.col("n")))
    return _step(d, drop=("plain",), since=F.when(F.size("plain") < F.col("n"), F.flatten(
        F.zip_with(F.col("plain"), nexts, lambda a, b: F.array_repeat(a, b - a)))))


def map_pronouns(d: DataFrame) -> DataFrame:
    """T14 inside ``found``."""
    return _step(d, found=F.transform("found", lambda f: f.withField("aspect", F.when(
        f["aspect"].isin(S.PRODUCT_PRONOUNS), F.lit(S.PRODUCT_ASPECT)).otherwise(f["aspect"]))))


def match_entities(d: DataFrame) -> DataFrame:
    """J4 inside ``found``: an aspect that ends a run of capitalised tokens becomes the run."""
    def named(f):
        i = f["aspect_i"]
        lo = F.get("since", i)
        run = F.array_join(F.transform(F.slice("toks", lo + 2, i - lo), lambda t: t["text"]), " ")
        return f.withField("aspect", F.when(_capital(i) & ~_capital(i + 1), run).otherwise(f["aspect"]))

    return _step(d, drop=("since",), found=F.transform("found", named))


def with_windows(d: DataFrame, window: int = S.WINDOW_MAIN, keep_duplicates: bool = False, with_words: bool = False) -> DataFrame:
    """The rows of ``found``, with their windows; a sentence without any gives one row with
    null fields and the whole sentence.  ``with_words`` adds ``win_words``."""
    every = F.transform("found", lambda f: f["aspect_i"])
    d = _step(d, spots=F.array_sort(every if keep_duplicates else F.array_distinct(every)))

    def bounded(f):
        i = f["aspect_i"]
        at = F.array_position("spots", i).cast("int")
        left, right = SP.bounds_from_neighbours(i, F.size("spots"), F.get("spots", at - 2), F.get("spots", at), F.col("n"), window)
        return f.withField("win_left", left).withField("win_right", right)

    none = F.struct(*_no_finding(), F.lit(0).alias("win_left"), F.col("n").cast("int").alias("win_right"))
    d = _step(d, drop=("spots",), found=F.when(F.size("found") > 0, F.transform("found", bounded)).otherwise(F.array(none)))

    # windows are cut before the findings leave the row, so none of them carries the token array
    def cut(f):
        l, r = f["win_left"], f["win_right"]
        start, stop = F.get("toks", l)["idx"], F.get("toks", r - 1)
        text = F.substring("sentence", start + 1, stop["idx"] + F.length(stop["text"]) - start)
        f = f.withField("aspect_sentence", F.when(r > l, text).otherwise(F.lit("")))
        return f.withField("win_words", F.slice("low", l + 1, r - l)) if with_words else f

    return _step(d, drop=tuple(d.columns), found=F.transform("found", cut)).select(*K, F.inline("found"))


def _no_finding() -> list[Column]:
    fields = [("rule_no", "int"), ("ord_i", "int"), ("aspect", "string"), ("modifier", "string"), ("rule", "string"),
              ("aspect_idx", "int"), ("aspect_i", "int")]
    return [F.lit(None).cast(kind).alias(name) for name, kind in fields]


def extract(sentences: DataFrame, window: int = S.WINDOW_MAIN, compat_rule_ids: bool = False,
            keep_duplicates: bool = False, with_words: bool = False) -> DataFrame:
    """R8 + R9 + W1 over ``split_sentences``: the rows of ``rules.extract_aspects``, without an
    exchange.  ``with_words`` adds ``win_words``, the lower-cased tokens of each window.

    Sentences without any word that a rule needs skip tagging and linking: their row is the
    whole sentence (tokens and single spaces tile the cleaned text)."""
    hit = A.may_find(F.col("sentence"))
    found = with_findings(with_heads(sentence_tokens(sentences.filter(hit))), compat_rule_ids)
    found = with_windows(match_entities(map_pronouns(with_entities(found))), window, keep_duplicates, with_words)
    rest = sentences.filter(~hit)
    words = [F.transform("matches", lambda x: F.lower(F.trim(F.replace(x, F.lit(TX.NT_MARK), F.lit(""))))).alias("win_words")]
    rest = rest.select(*K, *_no_finding(), F.lit(0).alias("win_left"), TX.token_count(F.col("sentence")).cast("int").alias("win_right"),
                       F.col("sentence").alias("aspect_sentence"), *(words if with_words else []))
    return found.unionByName(rest)


def extract_reviews(reviews: DataFrame, window: int = S.WINDOW_MAIN, id_col: str = "review_id",
                    text_col: str = "review_text", **kw) -> DataFrame:
    """``extract`` from (id, text) rows, of a batch or a stream."""
    return extract(A.split_sentences(A.spread(reviews, id_col, text_col), assume_partitioned=True), window, **kw)
