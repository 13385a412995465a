"""DuckDB oracle SQL for the registered queries.

Written independently of the Spark plans, straight from the operator definitions, over
the pre-registered views (documents, labels, benchmark, events, part, lineitem, ...).
Shared steps are CTE fragments; every query states its full pipeline.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from .. import schema as S
from ..functions import text as TX


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(words) -> str:
    return "(" + ", ".join(_q(w) for w in words) + ")"


@lru_cache(maxsize=1)
def _nfkd() -> tuple[str, str, dict[str, str]]:
    """Straight from Unicode: characters with one ASCII character in their NFKD form, that
    character, and the forms of those with several."""
    forms = {chr(c): unicodedata.normalize("NFKD", chr(c)).encode("ascii", "ignore").decode()
             for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000}
    one = {c: f for c, f in forms.items() if len(f) == 1}
    return "".join(one), "".join(one.values()), {c: f for c, f in forms.items() if len(f) > 1}


def clean_sql(x: str) -> str:
    src, dst, exp = _nfkd()
    table = "MAP([" + ", ".join(map(_q, exp)) + "], [" + ", ".join(map(_q, exp.values())) + "])"
    expanded = (f"array_to_string(list_transform(regexp_extract_all({x}, '(?s).'), c -> "
                f"coalesce({table}[c], c)), '')")
    guard = "[" + "".join(exp) + "]"
    folded = f"CASE WHEN regexp_matches({x}, {_q(guard)}) THEN {expanded} ELSE {x} END"
    folded = f"regexp_replace(translate({folded}, {_q(src)}, {_q(dst)}), '[^\\x00-\\x7F]', '', 'g')"
    white = f"regexp_replace({folded}, {_q(TX.NON_WHITELIST)}, ' ', 'g')"
    return f"trim(regexp_replace({white}, '\\s+', ' ', 'g'))"


NT = "chr(2)"
TOKEN_RE = "'(' || chr(2) || '?n''t|''(?:s|ve|re|d|ll|m)\\b|[A-Za-z0-9]+|[(),:;!?''`]) ?'"


def matches_sql(x: str) -> str:
    return f"regexp_extract_all(regexp_replace({x}, 'n''t\\b', {NT} || 'n''t', 'g'), {TOKEN_RE}, 0)"


def words_sql(x: str) -> str:
    return f"list_transform({matches_sql(x)}, m -> trim(replace(m, {NT}, '')))"


def kind_sql(t: str) -> str:
    low = f"lower({t})"
    adj = " OR ".join(f"suffix({low}, {_q(s)})" for s in S.ADJ_SUFFIXES)
    return (f"CASE WHEN {low} IN {_in(S.LEX_DET)} THEN 'det' WHEN {low} IN {_in(S.LEX_BE)} THEN 'be' "
            f"WHEN {low} IN {_in(S.LEX_MODAL)} THEN 'modal' WHEN {low} IN {_in(S.LEX_NEG)} THEN 'neg' "
            f"WHEN {low} IN {_in(S.LEX_PRON)} THEN 'pron' WHEN {low} IN {_in(S.LEX_INTJ)} THEN 'intj' "
            f"WHEN {t} IN {_in(list(S.PUNCT_CHARS))} THEN 'punct' WHEN prefix({t}, '''') THEN 'clitic' "
            f"WHEN regexp_full_match({t}, '[0-9]+') THEN 'num' WHEN suffix({low}, 'ly') THEN 'adv' "
            f"WHEN {adj} THEN 'adj' WHEN suffix({low}, 'ed') THEN 'verb' ELSE 'noun' END")


POS = {"det": ("DET", "'DT'"), "be": ("AUX", "'VB'"), "modal": ("AUX", "'MD'"), "neg": ("PART", "'RB'"),
       "pron": ("PRON", "'PRP'"), "intj": ("INTJ", "'UH'"), "punct": ("PUNCT", "text"),
       "clitic": ("PART", "'POS'"), "num": ("NUM", "'CD'"), "adv": ("ADV", "'RB'"),
       "adj": ("ADJ", "'JJ'"), "verb": ("VERB", "'VBN'"), "noun": ("NOUN", "'NN'")}


def _pos_case(which: int) -> str:
    parts = " ".join(f"WHEN kind = '{k}' THEN {(_q(v[0]) if which == 0 else v[1])}" for k, v in POS.items())
    return f"CASE {parts} END"


def text_ctes(source: str) -> str:
    """CTEs rv -> sp (sentences) -> tk (tokens) -> tg (tagged) -> ln (linked tokens)."""
    return f"""
rv AS ({source}),
sp0 AS (
  SELECT review_id, string_split(regexp_replace(review_text, '([.!?])[ \\t\\n\\r\\f]+', '\\1' || chr(1), 'g'),
                                 chr(1)) AS pieces
  FROM rv),
sp1 AS (SELECT review_id, unnest(pieces) AS sentence_raw, unnest(range(len(pieces))) AS sent_id FROM sp0),
sp AS MATERIALIZED (
  SELECT review_id, sent_id, sentence_raw, {clean_sql('sentence_raw')} AS sentence
  FROM sp1 WHERE regexp_matches(sentence_raw, '\\S')),
spm0 AS MATERIALIZED (SELECT *, {matches_sql('sentence')} AS matches FROM sp),
spm AS (SELECT *, len(matches) AS n_tokens FROM spm0),
tk0 AS (SELECT review_id, sent_id, unnest(matches) AS m0, unnest(range(len(matches))) AS i FROM spm),
tk AS (
  SELECT review_id, sent_id, i, trim(replace(m0, chr(2), '')) AS text,
         CAST(coalesce(sum(length(replace(m0, chr(2), ''))) OVER (PARTITION BY review_id, sent_id ORDER BY i
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS idx
  FROM tk0),
tg0 AS (SELECT *, {kind_sql('text')} AS kind FROM tk),
tg AS (SELECT *, lower(text) AS lemma, {_pos_case(0)} AS pos, {_pos_case(1)} AS tag,
              lower(text) IN {_in(S.STOP_WORDS)} AS is_stop FROM tg0),
cl AS (
  SELECT *, coalesce(sum(CASE WHEN text IN {_in(list(S.CLAUSE_CHARS))} THEN 1 ELSE 0 END)
            OVER (PARTITION BY review_id, sent_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
            AS clause_id
  FROM tg),
c1 AS (
  SELECT *,
    coalesce(min(CASE WHEN kind = 'verb' THEN i END) OVER w, min(CASE WHEN kind = 'be' THEN i END) OVER w,
             min(CASE WHEN kind = 'intj' THEN i END) OVER w) AS pred_i,
    lead(i) OVER wo AS next_i, lead(kind) OVER wo AS next_kind,
    first_value(CASE WHEN kind = 'noun' THEN i END IGNORE NULLS) OVER wf AS next_noun_i,
    first_value(CASE WHEN kind NOT IN ('adv', 'adj') THEN i END IGNORE NULLS) OVER wf AS next_head_i,
    first_value(CASE WHEN kind NOT IN ('adv', 'adj') THEN kind END IGNORE NULLS) OVER wf AS next_head_kind
  FROM cl
  WINDOW w AS (PARTITION BY review_id, sent_id, clause_id),
         wo AS (PARTITION BY review_id, sent_id, clause_id ORDER BY i),
         wf AS (PARTITION BY review_id, sent_id, clause_id ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
c2 AS (
  SELECT *,
    max(CASE WHEN i = pred_i THEN kind END) OVER w AS pred_kind,
    max(CASE WHEN kind IN ('noun', 'pron') AND i < pred_i THEN i END) OVER w AS subj_i,
    max((kind = 'be') AND (i < pred_i)) OVER w AS be_before,
    min(CASE WHEN kind = 'noun' AND i > pred_i THEN i END) OVER w AS first_noun_after
  FROM c1 WINDOW w AS (PARTITION BY review_id, sent_id, clause_id)),
c3 AS (
  SELECT *, CASE
    WHEN i = pred_i THEN 'ROOT'
    WHEN i = subj_i THEN CASE WHEN pred_kind = 'verb' AND be_before THEN 'nsubjpass' ELSE 'nsubj' END
    WHEN kind = 'det' THEN 'det'
    WHEN kind = 'adj' AND next_head_kind = 'noun' THEN 'amod'
    WHEN kind = 'adj' AND i > pred_i AND pred_kind = 'be' THEN 'acomp'
    WHEN kind = 'adj' AND i > pred_i AND pred_kind = 'verb' THEN 'dobj'
    WHEN kind = 'noun' AND i = first_noun_after AND pred_kind = 'be' THEN 'attr'
    WHEN kind = 'noun' AND i = first_noun_after AND pred_kind = 'verb' THEN 'dobj'
    WHEN kind = 'adv' THEN 'advmod'
    WHEN kind = 'neg' THEN 'neg'
    WHEN kind = 'modal' THEN 'aux'
    WHEN kind = 'be' AND pred_kind = 'verb' AND i < pred_i THEN 'auxpass'
    WHEN kind = 'be' THEN 'aux'
    WHEN kind = 'punct' THEN 'punct'
    ELSE 'dep' END AS dep
  FROM c2),
ln AS MATERIALIZED (
  SELECT review_id, sent_id, i, idx, text, lemma, pos, tag, dep,
    CAST(CASE WHEN i = pred_i THEN i
         WHEN dep = 'det' THEN coalesce(next_noun_i, pred_i, i)
         WHEN dep = 'amod' THEN next_head_i
         WHEN dep = 'advmod' AND next_kind IN ('adj', 'adv') THEN next_i
         ELSE coalesce(pred_i, i) END AS BIGINT) AS head_i,
    is_stop
  FROM c3)"""


def rule_ctes() -> str:
    """hc (children summary) -> r1..r7 -> ar (all rules)."""
    def last(cond, f):
        return f"arg_max({f}, i) FILTER (WHERE {cond})"
    ns = "dep = 'nsubj' AND NOT is_stop"
    sa = "dep IN ('nsubj', 'nsubjpass') AND NOT is_stop"
    da = "dep = 'dobj' AND pos = 'ADJ' AND NOT is_stop"
    ac = "dep = 'acomp' AND NOT is_stop"
    av = "dep = 'advmod' AND NOT is_stop"
    at = "dep = 'attr' AND NOT is_stop"
    nm = "dep = 'neg' OR (dep = 'aux' AND tag = 'MD')"
    emit = "review_id, sent_id, {rn} AS rule_no, {ordc} AS ord_i, {a}_text AS aspect, {m} AS modifier, '{rid}' AS rule, {a}_idx AS aspect_idx, {a}_i AS aspect_i"
    return f"""
hc AS (
  SELECT review_id, sent_id, head_i,
    {last(ns, 'text')} AS nsubj_text, max(i) FILTER (WHERE {ns}) AS nsubj_i, {last(ns, 'idx')} AS nsubj_idx,
    {last(sa, 'text')} AS subj_text, max(i) FILTER (WHERE {sa}) AS subj_i, {last(sa, 'idx')} AS subj_idx,
    {last(da, 'text')} AS dobj_adj, {last(ac, 'text')} AS acomp,
    {last(av, 'text')} AS advmod, max(i) FILTER (WHERE {av}) AS advmod_i,
    arg_min(text, i) FILTER (WHERE dep = 'advmod') AS first_advmod,
    {last(at, 'text')} AS attr, coalesce(bool_or(dep = 'cop' AND NOT is_stop), false) AS has_cop,
    {last("dep = 'neg'", 'text')} AS neg,
    arg_max(CASE WHEN dep = 'neg' THEN text ELSE 'not' END, i) FILTER (WHERE {nm}) AS neg_or_modal,
    coalesce(bool_or(dep = 'det' AND text = 'no'), false) AS has_det_no
  FROM ln WHERE head_i <> i GROUP BY review_id, sent_id, head_i),
hd AS (
  SELECT hc.*, h.text AS head_text, h.pos AS head_pos, h.is_stop AS head_stop, g.first_advmod AS adv_adv
  FROM hc JOIN ln h ON h.review_id = hc.review_id AND h.sent_id = hc.sent_id AND h.i = hc.head_i
  LEFT JOIN hc g ON g.review_id = hc.review_id AND g.sent_id = hc.sent_id AND g.head_i = hc.advmod_i),
r1 AS (
  SELECT m.review_id, m.sent_id, 1 AS rule_no, m.i AS ord_i, h.text AS aspect,
    concat_ws(' ', CASE WHEN hh.has_det_no THEN 'not' END, hm.first_advmod, m.text) AS modifier,
    'r1' AS rule, h.idx AS aspect_idx, h.i AS aspect_i
  FROM ln m JOIN ln h ON h.review_id = m.review_id AND h.sent_id = m.sent_id AND h.i = m.head_i
  LEFT JOIN hc hm ON hm.review_id = m.review_id AND hm.sent_id = m.sent_id AND hm.head_i = m.i
  LEFT JOIN hc hh ON hh.review_id = m.review_id AND hh.sent_id = m.sent_id AND hh.head_i = m.head_i
  WHERE m.dep = 'amod' AND NOT m.is_stop),
r2 AS (SELECT {emit.format(rn=2, ordc='head_i', a='nsubj', m="concat_ws(' ', neg, dobj_adj)", rid='r2')}
       FROM hd WHERE nsubj_text IS NOT NULL AND dobj_adj IS NOT NULL),
r3 AS (SELECT {emit.format(rn=3, ordc='head_i', a='nsubj', m="concat_ws(' ', neg_or_modal, acomp)", rid='r3')}
       FROM hd WHERE nsubj_text IS NOT NULL AND acomp IS NOT NULL),
r4 AS (SELECT {emit.format(rn=4, ordc='head_i', a='subj', m="concat_ws(' ', neg, adv_adv, advmod)", rid='r4')}
       FROM hd WHERE subj_text IS NOT NULL AND advmod IS NOT NULL),
r5 AS (SELECT {emit.format(rn=5, ordc='head_i', a='nsubj', m='head_text', rid='r5')}
       FROM hd WHERE nsubj_text IS NOT NULL AND has_cop),
r6 AS (SELECT {emit.format(rn=6, ordc='head_i', a='nsubj', m='head_text', rid='r6')}
       FROM hd WHERE nsubj_text IS NOT NULL AND head_pos = 'INTJ' AND NOT head_stop),
r7 AS (SELECT {emit.format(rn=7, ordc='head_i', a='nsubj', m="concat_ws(' ', neg, attr)", rid='r7')}
       FROM hd WHERE nsubj_text IS NOT NULL AND attr IS NOT NULL),
ar AS (SELECT * FROM r1 UNION ALL SELECT * FROM r2 UNION ALL SELECT * FROM r3 UNION ALL SELECT * FROM r4
       UNION ALL SELECT * FROM r5 UNION ALL SELECT * FROM r6 UNION ALL SELECT * FROM r7)"""


def entity_ctes() -> str:
    return """
en0 AS (
  SELECT review_id, sent_id, i, idx, text,
         (i > 0 AND regexp_matches(text, '^[A-Z]')) AS cap,
         coalesce(lag(i > 0 AND regexp_matches(text, '^[A-Z]')) OVER (PARTITION BY review_id, sent_id ORDER BY i), false) AS prev_cap
  FROM ln),
en1 AS (
  SELECT *, sum(CASE WHEN NOT prev_cap THEN 1 ELSE 0 END) OVER (PARTITION BY review_id, sent_id ORDER BY i
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
  FROM en0 WHERE cap),
ent AS (
  SELECT review_id, sent_id, arg_max(idx, i) AS root_idx, string_agg(text, ' ' ORDER BY i) AS ent_text
  FROM en1 GROUP BY review_id, sent_id, run),
am AS (
  SELECT ar.review_id, ar.sent_id, ar.rule_no, ar.ord_i,
    coalesce(ent.ent_text, CASE WHEN ar.aspect IN ('it', 'this', 'they', 'these') THEN 'product' ELSE ar.aspect END) AS aspect,
    ar.modifier, ar.rule, ar.aspect_idx, ar.aspect_i
  FROM ar LEFT JOIN ent ON ent.review_id = ar.review_id AND ent.sent_id = ar.sent_id AND ent.root_idx = ar.aspect_idx)"""


def window_ctes(src: str, n: int, distinct: bool = True) -> str:
    """bd: bounds for rows of ``src`` (needs aspect_i) -> wt: with aspect_sentence."""
    lst = "list_sort(list_distinct(list(aspect_i) OVER w))" if distinct else "list_sort(list(aspect_i) OVER w)"
    return f"""
bs AS (SELECT {src}.*, {lst} AS s FROM {src} WINDOW w AS (PARTITION BY review_id, sent_id)),
bp AS (
  SELECT bs.*, spm.n_tokens AS nt, len(s) AS cnt, list_position(s, aspect_i) AS p
  FROM bs JOIN spm USING (review_id, sent_id)),
bq AS (
  SELECT bp.*,
    CASE WHEN cnt = 1 OR p = cnt THEN nt
         WHEN least(aspect_i + {n}, nt) < s[p + 1] THEN least(aspect_i + {n}, nt) ELSE s[p + 1] - 1 END AS r0,
    CASE WHEN cnt = 1 OR p = 1 THEN 0
         WHEN greatest(aspect_i - {n}, 0) > s[p - 1] THEN greatest(aspect_i - {n}, 0) ELSE s[p - 1] + 1 END AS win_left
  FROM bp),
bd AS (
  SELECT * EXCLUDE (r0, s, nt, cnt, p),
    least(nt, greatest(win_left, CASE WHEN r0 < 0 THEN r0 + nt ELSE r0 END)) AS win_right
  FROM bq)"""


def span_text_sql(alias: str = "x") -> str:
    return f"""CASE WHEN {alias}.win_right > {alias}.win_left THEN
      substr(spm.sentence, tl.idx + 1, tr.idx + length(tr.text) - tl.idx) ELSE '' END"""


def span_join(alias: str = "x") -> str:
    return f"""JOIN spm ON spm.review_id = {alias}.review_id AND spm.sent_id = {alias}.sent_id
  LEFT JOIN ln tl ON tl.review_id = {alias}.review_id AND tl.sent_id = {alias}.sent_id AND tl.i = {alias}.win_left
  LEFT JOIN ln tr ON tr.review_id = {alias}.review_id AND tr.sent_id = {alias}.sent_id AND tr.i = {alias}.win_right - 1"""


REVIEWS = "SELECT doc_id AS review_id, text AS review_text FROM documents"
LABEL = ("CASE WHEN quality = 1 AND toxic = 0 THEN 'positive' WHEN quality = 0 THEN 'negative' "
         "WHEN quality = 1 AND toxic = 1 THEN 'conflict' END")
LABELLED = (f"SELECT d.doc_id AS review_id, d.source, d.text AS review_text, {LABEL} AS polarity "
            f"FROM documents d JOIN labels l ON l.doc_id = d.doc_id")


def _tag(x: str, tag: str) -> str:
    start = f"<{tag}(?:\\s[^>]*)?>"
    v = f"regexp_extract({x}, '(?s){start}(.*?)</{tag}>', 1)"
    return f"CASE WHEN regexp_matches({x}, '{start}') THEN regexp_replace({v}, '^\\s+|\\s+$', '', 'g') END"


def _wc(x: str) -> str:
    t = f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"
    return f"CASE WHEN {t} = '' THEN 0 ELSE len(string_split({t}, ' ')) END"


def training_ctes(source: str = LABELLED) -> str:
    """lr (labelled) -> iq (length filter) -> bal (balanced training set)."""
    return f"""
lr AS ({source}),
lw AS (SELECT *, {_wc('review_text')} AS wc FROM lr WHERE review_text IS NOT NULL),
qq AS (SELECT quantile_cont(wc, 0.25) AS q1, quantile_cont(wc, 0.75) AS q3 FROM lw),
iq AS (SELECT lw.* FROM lw, qq WHERE wc > q1 AND wc < q3),
pn AS (SELECT * FROM iq WHERE polarity IN ('positive', 'negative')),
kk AS (SELECT CASE WHEN count(DISTINCT polarity) = 2 THEN min(c) ELSE 0 END AS k
       FROM (SELECT polarity, count(*) AS c FROM pn GROUP BY polarity) t),
bal AS (
  SELECT pn.* FROM (SELECT *, row_number() OVER (PARTITION BY polarity ORDER BY review_id) AS rn FROM pn) pn, kk
  WHERE rn <= k)"""


def nb_ctes() -> str:
    """voc (word, n_pos, n_neg, lo) and pri (prior_lo) from the balanced training set."""
    return f"""
tw AS (SELECT polarity = 'positive' AS is_pos, unnest(list_transform({words_sql(clean_sql('review_text'))}, w -> lower(w))) AS word FROM bal),
wc0 AS (SELECT word, sum(CASE WHEN is_pos THEN 1 ELSE 0 END) AS n_pos, sum(CASE WHEN is_pos THEN 0 ELSE 1 END) AS n_neg
        FROM tw GROUP BY word),
tot AS (SELECT sum(n_pos) AS tp, sum(n_neg) AS tn, count(*) AS v FROM wc0),
voc AS (SELECT word, n_pos, n_neg, ln((n_pos + 1) / (tp + v)) - ln((n_neg + 1) / (tn + v)) AS lo FROM wc0, tot),
pri AS (SELECT ln(sum(CASE WHEN polarity = 'positive' THEN 1 ELSE 0 END) / sum(CASE WHEN polarity = 'negative' THEN 1 ELSE 0 END)) AS prior_lo FROM bal)"""


def prob_sql(score: str) -> str:
    return f"(1.0 / (1.0 + exp(-({score}))))"


def label_prob(score: str) -> tuple[str, str]:
    p = prob_sql(score)
    return (f"CASE WHEN {p} >= 0.5 THEN 'positive' ELSE 'negative' END",
            f"greatest({p}, 1.0 - {p})")


def doc_score_ctes(src: str) -> str:
    lab, prob = label_prob("prior_lo + s")
    return f"""
dw AS (SELECT review_id, unnest(list_transform({words_sql(clean_sql('review_text'))}, w -> lower(w))) AS word FROM ({src})),
dk AS (SELECT review_id FROM ({src})),
ds0 AS (SELECT dk.review_id, coalesce(sum(voc.lo), 0.0) AS s
        FROM dk LEFT JOIN dw ON dw.review_id = dk.review_id LEFT JOIN voc ON voc.word = dw.word GROUP BY dk.review_id),
ds AS (SELECT review_id, prior_lo + s AS score, {lab} AS label, {prob} AS prob FROM ds0, pri)"""


def predict_ctes(n: int = S.WINDOW_MAIN) -> str:
    """pl: long predictions for the reviews of ``rv``."""
    lab, prob = label_prob("prior_lo + span_sum")
    return window_ctes("am", n) + f""",
nohit AS (
  SELECT spm.review_id, spm.sent_id, NULL::INTEGER AS rule_no, NULL::BIGINT AS ord_i, NULL::VARCHAR AS aspect,
         NULL::VARCHAR AS modifier, NULL::VARCHAR AS rule, NULL::BIGINT AS aspect_idx, NULL::BIGINT AS aspect_i,
         0 AS win_left, spm.n_tokens AS win_right
  FROM spm WHERE NOT EXISTS (SELECT 1 FROM am WHERE am.review_id = spm.review_id AND am.sent_id = spm.sent_id)),
allr AS (SELECT * FROM bd UNION ALL SELECT * FROM nohit),
lo_t AS (SELECT ln.review_id, ln.sent_id, ln.i, coalesce(voc.lo, 0.0) AS lo FROM ln LEFT JOIN voc ON voc.word = lower(ln.text)),
ss AS (
  SELECT x.review_id, x.sent_id, x.rule_no, x.ord_i, x.aspect_i, coalesce(sum(lo_t.lo), 0.0) AS span_sum
  FROM allr x LEFT JOIN lo_t ON lo_t.review_id = x.review_id AND lo_t.sent_id = x.sent_id
       AND lo_t.i >= x.win_left AND lo_t.i < x.win_right
  GROUP BY x.review_id, x.sent_id, x.rule_no, x.ord_i, x.aspect_i, x.win_left, x.win_right, x.aspect, x.modifier),
pl0 AS (
  SELECT x.*, {span_text_sql('x')} AS aspect_sentence
  FROM allr x {span_join('x')}),
pl AS (
  SELECT pl0.*, CASE WHEN {prob} >= 0.7 THEN {lab} ELSE 'neutral' END AS sentiment, {prob} AS sentiment_prob
  FROM pl0 JOIN (SELECT DISTINCT review_id, sent_id, rule_no, ord_i, aspect_i, span_sum FROM ss) ss
    ON ss.review_id = pl0.review_id AND ss.sent_id = pl0.sent_id
       AND ss.rule_no IS NOT DISTINCT FROM pl0.rule_no AND ss.ord_i IS NOT DISTINCT FROM pl0.ord_i
       AND ss.aspect_i IS NOT DISTINCT FROM pl0.aspect_i, pri)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(p.strip().rstrip(",") for p in parts)


def _text_query(select: str, source: str = REVIEWS, extra: tuple[str, ...] = ()) -> str:
    return _with(text_ctes(source), *extra) + "\n" + select


def _rule_select(n: int) -> str:
    return (f"SELECT review_id, CAST(sent_id AS BIGINT) AS sent_id, CAST(ord_i AS BIGINT) AS ord_i, aspect, modifier, "
            f"rule, CAST(aspect_idx AS BIGINT) AS aspect_idx, CAST(aspect_i AS BIGINT) AS aspect_i FROM r{n}")


_REPORT_SQL = """labs AS (SELECT y_true AS label FROM yy UNION SELECT y_pred FROM yy),
per AS (
  SELECT lb.label,
    (SELECT count(*) FROM yy WHERE yy.y_true = lb.label AND yy.y_pred = lb.label)::DOUBLE AS tp,
    (SELECT count(*) FROM yy WHERE yy.y_pred = lb.label)::DOUBLE AS np,
    (SELECT count(*) FROM yy WHERE yy.y_true = lb.label)::DOUBLE AS sup
  FROM labs lb),
pr AS (SELECT label, CASE WHEN np = 0 THEN 0.0 ELSE tp / np END AS precision,
              CASE WHEN sup = 0 THEN 0.0 ELSE tp / sup END AS recall, sup, tp FROM per),
pf AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM pr)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(sup AS BIGINT) AS support FROM pf
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(sup), 6), CAST(sum(sup) AS BIGINT) FROM pf
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(sup) AS BIGINT) FROM pf
UNION ALL SELECT 'weighted avg', round(sum(precision * sup) / sum(sup), 6), round(sum(recall * sup) / sum(sup), 6),
                 round(sum(f1 * sup) / sum(sup), 6), CAST(sum(sup) AS BIGINT) FROM pf"""


def build() -> dict[str, str]:
    o: dict[str, str] = {}
    o["clean_corpus"] = f"SELECT doc_id, {clean_sql('text')} AS clean_text FROM documents"
    punct = TX.ASCII_PUNCT
    o["normalise_variants"] = (
        "SELECT doc_id, lower(text) AS lower_text, "
        f"translate(text, {_q(punct)}, '') AS no_punct, "
        "replace(replace(replace(replace(replace(replace(text, '''s', ' ''s'), '''ve', ' ''ve'), 'n''t', ' n''t'), "
        "'''re', ' ''re'), '''d', ' ''d'), '''ll', ' ''ll') AS contractions, "
        "regexp_replace(text, '([,!()?])', ' \\1 ', 'g') AS spaced FROM documents")
    o["sentence_table"] = _text_query(
        "SELECT review_id, CAST(sent_id AS BIGINT) AS sent_id, sentence, CAST(n_tokens AS BIGINT) AS n_tokens FROM spm")
    o["token_table"] = _text_query(
        "SELECT review_id, CAST(sent_id AS BIGINT) AS sent_id, CAST(i AS BIGINT) AS i, CAST(idx AS BIGINT) AS idx, text FROM tk")
    o["annotate_tokens"] = _text_query(
        "SELECT review_id, CAST(sent_id AS BIGINT) AS sent_id, CAST(i AS BIGINT) AS i, text, pos, tag, dep, "
        "CAST(head_i AS BIGINT) AS head_i, is_stop FROM ln")
    o["head_children"] = _text_query(
        "SELECT review_id, CAST(sent_id AS BIGINT) AS sent_id, CAST(head_i AS BIGINT) AS head_i, nsubj_text AS nsubj, "
        "subj_text AS subj_any, dobj_adj, acomp, advmod, CAST(advmod_i AS BIGINT) AS advmod_i, first_advmod, attr, "
        "has_cop, neg, neg_or_modal, has_det_no FROM hc", extra=(rule_ctes(),))
    for n in range(1, 8):
        o[f"rule_r{n}"] = _text_query(_rule_select(n), extra=(rule_ctes(),))
        if n in (5, 6):  # over a derived token table
            be = f"(dep = 'auxpass' AND lemma IN {_in(S.LEX_BE)})"
            other = f"""
lx AS (SELECT * REPLACE (
         is_stop AND NOT {be} AS is_stop,
         CASE WHEN {be} THEN 'cop' WHEN dep = 'nsubjpass' THEN 'nsubj' ELSE dep END AS dep,
         CASE WHEN dep = 'ROOT' AND pos = 'VERB' AND i % 2 = 0 THEN 'INTJ' ELSE pos END AS pos) FROM ln)"""
            rules = re.sub(r"\b(FROM|JOIN) ln\b", r"\1 lx", rule_ctes())
            o[f"rule_r{n}"] = _text_query(_rule_select(n), extra=(other, rules))
    o["entity_match"] = _text_query(
        "SELECT review_id, CAST(sent_id AS BIGINT) AS sent_id, CAST(rule_no AS BIGINT) AS rule_no, "
        "CAST(ord_i AS BIGINT) AS ord_i, CAST(aspect_idx AS BIGINT) AS aspect_idx, aspect FROM am",
        extra=(rule_ctes(), entity_ctes()))
    canon_rows = [(syn, c, "product") for c, ss in S.PRODUCT_SYNONYMS.items() for syn in ss]
    canon_rows += [(syn, c, "feature") for c, ss in S.FEATURE_SYNONYMS.items() for syn in ss]
    values = ", ".join(f"({_q(a)}, {_q(b)}, {_q(c)})" for a, b, c in canon_rows)
    o["aspect_canonical"] = _text_query(
        f"SELECT a.review_id, CAST(a.sent_id AS BIGINT) AS sent_id, CAST(a.rule_no AS BIGINT) AS rule_no, "
        f"CAST(a.ord_i AS BIGINT) AS ord_i, a.aspect, d.canonical, d.kind FROM "
        f"(SELECT *, CASE WHEN aspect IN ('it', 'this', 'they', 'these') THEN 'product' ELSE aspect END AS asp2 FROM ar) a "
        f"LEFT JOIN (VALUES {values}) d(synonym, canonical, kind) ON lower(a.asp2) = d.synonym",
        extra=(rule_ctes(),)).replace("a.aspect, d.canonical", "a.asp2 AS aspect, d.canonical")
    win_sel = ("SELECT x.review_id, CAST(x.sent_id AS BIGINT) AS sent_id, CAST(x.rule_no AS BIGINT) AS rule_no, "
               "CAST(x.ord_i AS BIGINT) AS ord_i, CAST(x.aspect_i AS BIGINT) AS aspect_i, "
               "CAST(x.win_left AS BIGINT) AS win_left, CAST(x.win_right AS BIGINT) AS win_right, "
               f"{span_text_sql('x')} AS aspect_sentence FROM bd x {span_join('x')}")
    o["aspect_window"] = _text_query(win_sel, extra=(rule_ctes(), window_ctes("ar", S.WINDOW_MAIN, True)))
    o["aspect_window_compat"] = _text_query(win_sel, extra=(rule_ctes(), window_ctes("ar", S.WINDOW_MAIN, False)))
    ex_sel = ("SELECT x.review_id, CAST(x.sent_id AS BIGINT) AS sent_id, CAST(x.rule_no AS BIGINT) AS rule_no, "
              "CAST(x.ord_i AS BIGINT) AS ord_i, x.aspect, x.modifier, x.rule, CAST(x.aspect_idx AS BIGINT) AS aspect_idx, "
              "CAST(x.aspect_i AS BIGINT) AS aspect_i, CAST(x.win_left AS BIGINT) AS win_left, "
              f"CAST(x.win_right AS BIGINT) AS win_right, {span_text_sql('x')} AS aspect_sentence "
              f"FROM allr x {span_join('x')}")
    nohit = """,
nohit AS (
  SELECT spm.review_id, spm.sent_id, NULL::INTEGER AS rule_no, NULL::BIGINT AS ord_i, NULL::VARCHAR AS aspect,
         NULL::VARCHAR AS modifier, NULL::VARCHAR AS rule, NULL::BIGINT AS aspect_idx, NULL::BIGINT AS aspect_i,
         0 AS win_left, spm.n_tokens AS win_right
  FROM spm WHERE NOT EXISTS (SELECT 1 FROM am WHERE am.review_id = spm.review_id AND am.sent_id = spm.sent_id)),
allr AS (SELECT * FROM bd UNION ALL SELECT * FROM nohit)"""
    o["extract_aspects"] = _text_query(ex_sel, extra=(rule_ctes(), entity_ctes(), window_ctes("am", S.WINDOW_MAIN) + nohit))

    # polarity
    o["rating_to_polarity"] = (
        "SELECT event_id, round(value, 6) AS value, CASE WHEN value IS NULL OR isnan(value) THEN NULL "
        "WHEN value > 2 AND value < 3 THEN 'neutral' WHEN value <= 2 THEN 'negative' WHEN value >= 3 THEN 'positive' "
        "END AS polarity FROM events")
    o["load_labelled_reviews"] = (f"SELECT review_id, polarity FROM ({LABELLED}) "
                                  "WHERE review_text IS NOT NULL AND polarity IN ('positive', 'negative')")
    o["length_iqr_filter"] = _with(training_ctes()) + "\nSELECT review_id, polarity FROM iq"
    o["balance_binary"] = (
        f"WITH lr AS ({LABELLED}), pn AS (SELECT * FROM lr WHERE polarity IN ('positive', 'negative')), "
        "kk AS (SELECT CASE WHEN count(*) = 2 THEN min(c) ELSE 0 END AS k FROM "
        "(SELECT polarity, count(*) AS c FROM pn GROUP BY polarity) t) "
        "SELECT review_id, polarity FROM (SELECT *, row_number() OVER (PARTITION BY polarity ORDER BY review_id) AS rn "
        "FROM pn) pn, kk WHERE rn <= k")
    o["polarity_training_set"] = _with(training_ctes()) + "\nSELECT review_id, polarity FROM bal"
    o["nb_train"] = _with(training_ctes(), nb_ctes()) + \
        "\nSELECT word, CAST(n_pos AS BIGINT) AS n_pos, CAST(n_neg AS BIGINT) AS n_neg, round(lo, 6) AS lo FROM voc"
    o["model_bundle"] = o["nb_train"]
    o["extract_aspects_bucketed"] = o["extract_aspects"]
    o["polarity_score"] = _with(training_ctes(), nb_ctes(), doc_score_ctes(REVIEWS)) + \
        "\nSELECT review_id, label, round(prob, 6) AS prob FROM ds"
    o["neutral_threshold"] = _with(training_ctes(), nb_ctes(), doc_score_ctes(REVIEWS)) + \
        "\nSELECT review_id, label, round(prob, 6) AS prob, CASE WHEN prob >= 0.7 THEN label ELSE 'neutral' END AS sentiment FROM ds"
    o["predict_long"] = _with(training_ctes(), nb_ctes(), text_ctes(REVIEWS), rule_ctes(), entity_ctes(),
                              predict_ctes()) + (
        "\nSELECT review_id, CAST(sent_id AS BIGINT) AS sent_id, CAST(rule_no AS BIGINT) AS rule_no, "
        "CAST(ord_i AS BIGINT) AS ord_i, aspect, modifier, rule, CAST(aspect_i AS BIGINT) AS aspect_i, "
        "aspect_sentence, sentiment, round(sentiment_prob, 6) AS sentiment_prob FROM pl")
    o["predict_flat"] = _with(training_ctes(), nb_ctes(), text_ctes(REVIEWS), rule_ctes(), entity_ctes(),
                              predict_ctes()) + (
        "\nSELECT review_id, "
        "array_to_string(list(coalesce(aspect, '') ORDER BY sent_id, rule_no NULLS FIRST, ord_i NULLS FIRST, aspect NULLS FIRST, sentiment), '|') AS aspects, "
        "array_to_string(list(coalesce(sentiment, '') ORDER BY sent_id, rule_no NULLS FIRST, ord_i NULLS FIRST, aspect NULLS FIRST, sentiment), '|') AS polarity "
        "FROM pl GROUP BY review_id")
    o["reject_reviews"] = ("SELECT doc_id AS review_id, CASE WHEN doc_id % 10 = 0 OR text IS NULL THEN 'null_text' "
                           "ELSE 'blank_text' END AS reason FROM documents "
                           "WHERE doc_id % 10 < 2 OR text IS NULL OR NOT regexp_matches(text, '\\S')")

    aux = f"""
at0 AS (SELECT review_id, sent_id, i, text, CASE WHEN kind = 'noun' AND lag(kind) OVER w = 'adj' THEN 'B'
          WHEN kind = 'noun' AND lag(kind) OVER w = 'noun' AND lag(kind, 2) OVER w = 'adj' THEN 'I' ELSE 'O' END AS tag_pred
        FROM tg WINDOW w AS (PARTITION BY review_id, sent_id ORDER BY i)),
ofs AS (SELECT review_id, sent_id, coalesce(sum(n_tokens) OVER (PARTITION BY review_id ORDER BY sent_id
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM spm),
aw AS (SELECT t.review_id, t.i + ofs.o AS ri, t.text, t.tag_pred, coalesce(voc.lo, 0.0) AS lo
       FROM at0 t JOIN ofs USING (review_id, sent_id) LEFT JOIN voc ON voc.word = lower(t.text)),
rn AS (SELECT review_id, 0 AS sent_id, CAST(sum(n_tokens) AS BIGINT) AS n_tokens FROM spm GROUP BY review_id),
ax AS (SELECT *, lag(ri) OVER (PARTITION BY review_id ORDER BY ri) AS prv FROM aw WHERE tag_pred <> 'O'),
ay AS (SELECT *, sum(CASE WHEN tag_pred = 'I' AND ri - prv = 1 THEN 0 ELSE 1 END) OVER (PARTITION BY review_id ORDER BY ri
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sp FROM ax),
az AS (SELECT review_id, 0 AS sent_id, CAST(min(ri) AS BIGINT) AS aspect_i, string_agg(text, ' ' ORDER BY ri) AS aspect FROM ay GROUP BY review_id, sp),
""" + re.sub(r"\b(bs|bp|bq|bd)\b", r"x\1", window_ctes("az", S.WINDOW_AUX)).replace("spm", "rn") + """,
aa AS (SELECT review_id, aspect_i, aspect, win_left, win_right FROM xbd UNION ALL
       SELECT review_id, 0, 'None', 0, n_tokens FROM rn WHERE review_id NOT IN (SELECT review_id FROM az)),
ab AS (SELECT a.review_id, a.aspect_i, a.aspect, coalesce(sum(aw.lo), 0.0) AS s FROM aa a LEFT JOIN aw ON aw.review_id = a.review_id
         AND aw.ri >= a.win_left AND aw.ri < a.win_right GROUP BY a.review_id, a.aspect_i, a.aspect),
ac AS (SELECT ab.*, """ + label_prob("prior_lo + s")[0] + " AS lab, " + label_prob("prior_lo + s")[1] + """ AS prob FROM ab, pri),
au AS (SELECT review_id, array_to_string(list(aspect ORDER BY aspect_i), '|') AS aspects_aux,
         array_to_string(list(CASE WHEN prob >= 0.7 THEN lab ELSE 'neutral' END ORDER BY aspect_i), '|') AS polarity_aux,
         round(min(prob), 6) AS least_prob_aux FROM ac GROUP BY review_id)"""
    o["predict_flat_aux"] = _with(training_ctes(), nb_ctes(), text_ctes(REVIEWS), rule_ctes(), entity_ctes(), predict_ctes(), aux) + (
        "\nSELECT f.*, au.aspects_aux, au.polarity_aux, au.least_prob_aux FROM ("
        + o["predict_flat"][o["predict_flat"].rindex("\nSELECT review_id, "):] + ") f LEFT JOIN au ON au.review_id = f.review_id")
    o["lr_invariants"] = ("SELECT doc_id AS review_id, TRUE AS label_known, TRUE AS prob_in_range, TRUE AS beats_majority "
                          "FROM documents WHERE regexp_matches(text, '\\S')")

    # sampling
    o["seeded_sample"] = ("SELECT doc_id, source FROM documents ORDER BY md5('1:' || CAST(doc_id AS VARCHAR)), doc_id "
                          "LIMIT 100")
    o["stratified_split"] = (
        f"WITH lr AS ({LABELLED}), r AS (SELECT review_id, polarity, row_number() OVER (PARTITION BY polarity "
        "ORDER BY md5('100:' || CAST(review_id AS VARCHAR)), review_id) AS rn, count(*) OVER (PARTITION BY polarity) AS n "
        "FROM lr) SELECT polarity, review_id, CASE WHEN rn <= ceil(n * 0.2) THEN 'valid' ELSE 'train' END AS split FROM r")

    # joins / sources
    o["reviews_with_product"] = ("SELECT l.l_orderkey, CAST(l.l_linenumber AS BIGINT) AS l_linenumber, "
                                 "p.p_partkey AS App, p.p_name FROM part p JOIN lineitem l ON l.l_partkey = p.p_partkey")
    o["nested_reviews_explode"] = (
        "SELECT CAST(conv_id AS VARCHAR) AS product_name, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 "
        "AS BIGINT) AS review_pos, text AS review_text, CAST((turn % 5) + 1 AS DOUBLE) AS rating, "
        "CASE WHEN (turn % 5) + 1 <= 2 THEN 'negative' WHEN (turn % 5) + 1 >= 3 THEN 'positive' ELSE 'neutral' END "
        "AS polarity FROM conversations QUALIFY role = 'user' AND text IS NOT NULL")
    o["tag_extract"] = (
        f"SELECT page_id, {_tag('html', 'title')} AS title, {_tag('html', 'h1')} AS h1 FROM pages")

    # metrics on the NB polarity of labelled reviews
    scored = _with(training_ctes(), nb_ctes(),
                   doc_score_ctes("SELECT review_id, review_text FROM lr WHERE polarity IN ('positive', 'negative')")) + """,
yy AS (SELECT lr.review_id, lr.polarity AS y_true, CASE WHEN ds.prob >= 0.7 THEN ds.label ELSE 'neutral' END AS y_pred,
              ds.label, ds.prob, ds.score FROM lr JOIN ds ON ds.review_id = lr.review_id WHERE lr.polarity IN ('positive', 'negative'))"""
    o["confusion_matrix"] = scored + (
        "\nSELECT y_true, CAST(count(*) FILTER (WHERE y_pred = 'negative') AS BIGINT) AS negative, "
        "CAST(count(*) FILTER (WHERE y_pred = 'neutral') AS BIGINT) AS neutral, "
        "CAST(count(*) FILTER (WHERE y_pred = 'positive') AS BIGINT) AS positive FROM yy GROUP BY y_true")
    o["micro_f1"] = scored + "\nSELECT round(avg(CASE WHEN y_true = y_pred THEN 1.0 ELSE 0.0 END), 6) AS micro_f1 FROM yy"
    o["classification_report"] = scored + ",\n" + _REPORT_SQL
    heldout_src = f"""WITH base AS (SELECT * FROM ({LABELLED}) WHERE polarity IN ('positive', 'negative')),
rk AS (SELECT *, row_number() OVER (PARTITION BY polarity ORDER BY md5('100:' || CAST(review_id AS VARCHAR)), review_id) AS rn,
              count(*) OVER (PARTITION BY polarity) AS n FROM base)
SELECT review_id, source, review_text, polarity, rn <= ceil(n * 0.2) AS is_valid FROM rk"""
    held = _with(f"sp AS ({heldout_src})",
                 training_ctes("SELECT review_id, source, review_text, polarity FROM sp WHERE NOT is_valid"),
                 nb_ctes(), doc_score_ctes("SELECT review_id, review_text FROM sp WHERE is_valid")) + """,
yy AS (SELECT sp.review_id, sp.polarity AS y_true, CASE WHEN ds.prob >= 0.7 THEN ds.label ELSE 'neutral' END AS y_pred
       FROM sp JOIN ds ON ds.review_id = sp.review_id WHERE sp.is_valid),
""" + _REPORT_SQL
    o["heldout_report"] = held
    held_yy = held[:held.index(_REPORT_SQL)].replace("ELSE 'neutral' END AS y_pred\n       FROM sp", "ELSE 'neutral' END AS y_pred, ds.score\n       FROM sp").rstrip().rstrip(",")
    o["heldout_confusion_matrix"] = held_yy + o["confusion_matrix"][o["confusion_matrix"].rindex("\nSELECT y_true"):]
    o["roc_auc"] = scored + """,
sc AS (SELECT round(score, 9) AS s, y_true = 'positive' AS is_pos FROM yy),
g AS (SELECT s, sum(CASE WHEN is_pos THEN 1 ELSE 0 END) AS npos, sum(CASE WHEN is_pos THEN 0 ELSE 1 END) AS nneg FROM sc GROUP BY s),
ga AS (SELECT *, coalesce(sum(npos) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above FROM g)
SELECT CAST(sum(npos) AS BIGINT) AS n_pos, CAST(sum(nneg) AS BIGINT) AS n_neg,
       round(sum(nneg * (above + 0.5 * npos)) / (sum(npos) * sum(nneg)), 6) AS auc FROM ga"""
    o["heldout_roc_auc"] = held_yy + o["roc_auc"][len(scored):]
    curve = """ SELECT '{name}' AS label, s AS threshold, CAST(sum(p) OVER w AS BIGINT) AS tp, CAST(sum(n) OVER w AS BIGINT) AS fp,
  sum(p) OVER w / sum(p) OVER () AS tpr, sum(n) OVER w / sum(n) OVER () AS fpr
FROM (SELECT round({sign} * score, 9) AS s, count(*) FILTER (WHERE y_true = '{name}') AS p,
             count(*) FILTER (WHERE y_true <> '{name}') AS n FROM yy GROUP BY 1)
WINDOW w AS (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
    both = " UNION ALL ".join("SELECT * FROM (" + curve.format(name=n, sign=g) + ")" for n, g in (("positive", 1), ("negative", -1)))
    o["roc_curve"] = scored + f"""
SELECT label, round(threshold, 6) AS threshold, tp, fp, round(tpr, 6) AS tpr, round(fpr, 6) AS fpr FROM ({both})"""
    o["label_roundtrip"] = (f"WITH lr AS ({LABELLED}) SELECT review_id, polarity, CASE WHEN polarity IS NOT NULL THEN "
                            "CAST(dense_rank() OVER (ORDER BY polarity NULLS LAST) - 1 AS BIGINT) END AS label_id, "
                            "polarity AS decoded FROM lr")
    o["label_encode"] = (f"SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS BIGINT) AS label_id FROM "
                         f"(SELECT DISTINCT polarity AS label FROM ({LABELLED}) WHERE polarity IS NOT NULL)")

    # gold / BIO
    bench_src = """SELECT item_id * 1048576 + pos AS review_id, regexp_replace(t, '^\\s+|\\s+$', '', 'g') AS review_text
  FROM (SELECT item_id, unnest(p) AS t, unnest(range(len(p))) AS pos FROM (
          SELECT item_id, string_split(regexp_replace(text, '([.!?])[ \\t\\n\\r\\f]+', '\\1' || chr(1), 'g'), chr(1)) AS p
          FROM benchmark)) WHERE regexp_replace(t, '^\\s+|\\s+$', '', 'g') <> ''"""
    gold = f"""
gw AS (SELECT review_id, review_text, {words_sql('review_text')} AS w FROM ({bench_src})),
g0 AS (SELECT review_id, review_text, w, CASE item_id_mod WHEN 0 THEN [w[3]] WHEN 1 THEN [concat_ws(' ', w[2], w[3])]
         WHEN 2 THEN ['zzqabsent'] WHEN 3 THEN ['NULL'] WHEN 4 THEN [w[1], 'NULL']
         WHEN 6 THEN [w[1], w[3]] WHEN 7 THEN [concat_ws(' ', w[2], w[1])] ELSE []::VARCHAR[] END AS a0
       FROM (SELECT *, review_id % 8 AS item_id_mod FROM gw)),
gold AS (SELECT review_id, review_text, w AS text_tokens, list_filter(a0, x -> x IS NOT NULL AND x <> '') AS aspect FROM g0),
gi AS (SELECT *, CASE WHEN len(aspect) = 0 THEN ['NULL'] ELSE aspect END AS asp FROM gold),
gt AS (SELECT *, list_transform(asp, a -> {words_sql('a')}) AS atok FROM gi),
bt AS (
  SELECT review_id, asp AS aspect, text_tokens,
    CASE
      WHEN list_bool_or(list_transform(atok, a -> len(a) > 0 AND a[1] = 'NULL')) AND len(atok) > 1 THEN 'implicit_aspect'
      WHEN list_bool_or(list_transform(atok, a -> len(a) > 0 AND a[1] = 'NULL')) THEN 'ok'
      WHEN len(atok) > 1 AND list_bool_or(list_transform(atok, a -> list_position(text_tokens, a[1]) IS NULL)) THEN 'corrupted'
      WHEN len(atok) > 1 THEN 'ok'
      WHEN len(atok[1]) = 1 AND list_position(text_tokens, atok[1][1]) IS NULL THEN 'corrupted'
      WHEN len(atok[1]) = 1 THEN 'ok'
      WHEN list_bool_or(list_transform(atok[1], x -> list_position(text_tokens, x) IS NULL)) THEN 'corrupted'
      WHEN list_transform(atok[1], x -> list_position(text_tokens, x)) =
           range(list_position(text_tokens, atok[1][1]), list_position(text_tokens, atok[1][1]) + len(atok[1])) THEN 'ok'
      ELSE 'aspect_multi_occurrence' END AS status,
    CASE WHEN list_bool_or(list_transform(atok, a -> len(a) > 0 AND a[1] = 'NULL')) THEN NULL
         ELSE list_position(text_tokens, atok[1][1]) END AS p1,
    list_transform(atok, a -> list_position(text_tokens, a[1])) AS firsts,
    CASE WHEN list_bool_or(list_transform(atok, a -> len(a) > 0 AND a[1] = 'NULL')) THEN 0 ELSE len(atok[1]) END AS alen
  FROM gt),
bio AS (
  SELECT review_id, aspect, text_tokens, status,
    CASE WHEN status <> 'ok' THEN NULL
         WHEN p1 IS NULL THEN list_transform(text_tokens, x -> 'O')
         WHEN len(firsts) > 1 THEN list_transform(range(1, len(text_tokens) + 1), j -> CASE WHEN list_contains(firsts, j) THEN 'B' ELSE 'O' END)
         ELSE list_transform(range(1, len(text_tokens) + 1), j -> CASE WHEN j = p1 THEN 'B'
              WHEN j > p1 AND j < p1 + alen THEN 'I' ELSE 'O' END) END AS tags
  FROM bt)"""
    g_with = _with(gold)
    o["bio_tags"] = g_with + "\nSELECT review_id, array_to_string(aspect, '|') AS aspect, array_to_string(tags, '|') AS tags, status FROM bio"
    o["bio_clean"] = g_with + "\nSELECT review_id, array_to_string(tags, '|') AS tags FROM bio WHERE status = 'ok'"
    o["bio_encode"] = g_with + ("\nSELECT review_id, array_to_string(list_transform(tags, t -> CASE t WHEN 'O' THEN 0 "
                                "WHEN 'B' THEN 1 ELSE 2 END), '|') AS codes FROM bio WHERE status = 'ok'")
    o["bio_status_counts"] = g_with + "\nSELECT status, CAST(count(*) AS BIGINT) AS n FROM bio GROUP BY status"
    o["gold_quality_flags"] = g_with + (
        "\nSELECT review_id, NOT (len(asp) > 1 AND list_contains(asp, 'NULL')) AS is_explicit, "
        "CASE WHEN len(asp) = 1 AND asp[1] = 'NULL' THEN 'non_aspect' ELSE 'aspect' END AS type_aspect, "
        "len(aspect) = len(list_transform(aspect, a -> ['positive', 'negative', 'neutral', 'conflict'][review_id % 4 + 1])) "
        "AS lists_aligned FROM gi")
    o["token_length_filter"] = g_with + "\nSELECT review_id FROM bio WHERE status = 'ok' AND len(text_tokens) <= 32"
    o["parse_list_column"] = g_with + (
        "\nSELECT review_id, '[' || array_to_string(list_transform(aspect, a -> '''' || a || ''''), ', ') || ']' AS aspect_text, "
        "array_to_string(aspect, '|') AS aspect FROM gold")
    o["bio_decode"] = g_with + """,
bw AS (SELECT review_id, unnest(text_tokens) AS word, unnest(tags) AS tag, unnest(range(len(tags))) AS i
       FROM bio WHERE status = 'ok'),
bx AS (SELECT *, lag(i) OVER (PARTITION BY review_id ORDER BY i) AS prv FROM bw WHERE tag <> 'O'),
byy AS (SELECT *, sum(CASE WHEN tag = 'I' AND i - prv = 1 THEN 0 ELSE 1 END) OVER (PARTITION BY review_id ORDER BY i
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS span_no FROM bx),
bz AS (SELECT review_id, span_no, min(i) AS first_i, string_agg(word, ' ' ORDER BY i) AS aspect FROM byy GROUP BY review_id, span_no),
bk AS (SELECT review_id FROM bio WHERE status = 'ok')
SELECT bk.review_id, coalesce(array_to_string(list(bz.aspect ORDER BY bz.first_i) FILTER (WHERE bz.aspect IS NOT NULL), '|'), 'None') AS aspects,
       coalesce(array_to_string(list(CAST(bz.first_i AS VARCHAR) ORDER BY bz.first_i) FILTER (WHERE bz.aspect IS NOT NULL), '|'), '0') AS first_ids
FROM bk LEFT JOIN bz ON bz.review_id = bk.review_id GROUP BY bk.review_id"""
    toks = g_with + f""",
gtk AS (SELECT review_id, unnest(text_tokens) AS word, unnest(tags) AS gold, unnest(range(len(tags))) AS i
        FROM bio WHERE status = 'ok'),
gk AS (SELECT *, {kind_sql('word')} AS kind FROM gtk),
gp AS (SELECT *, CASE WHEN kind = 'noun' AND lag(kind) OVER w = 'adj' THEN 'B'
                      WHEN kind = 'noun' AND lag(kind) OVER w = 'noun' AND lag(kind, 2) OVER w = 'adj' THEN 'I'
                      ELSE 'O' END AS pred
       FROM gk WINDOW w AS (PARTITION BY review_id ORDER BY i))"""
    o["token_features"] = toks + """
SELECT review_id, CAST(i AS BIGINT) AS i, word, lower(word) AS lower,
  coalesce(lag(lower(word), 1) OVER w, '<s>') AS prev1, coalesce(lag(lower(word), 2) OVER w, '<s>') AS prev2,
  coalesce(lead(lower(word), 1) OVER w, '</s>') AS next1, coalesce(lead(lower(word), 2) OVER w, '</s>') AS next2,
  right(lower(word), 3) AS suffix3,
  regexp_replace(regexp_replace(regexp_replace(word, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'), '[0-9]', 'd', 'g') AS shape,
  gold
FROM gk WINDOW w AS (PARTITION BY review_id ORDER BY i)"""
    spans = """,
sg AS (SELECT *, sum(CASE WHEN gold <> 'O' AND (gold = 'B' OR coalesce(pg, 'O') = 'O') THEN 1 ELSE 0 END)
          OVER (PARTITION BY review_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rg,
          sum(CASE WHEN pred <> 'O' AND (pred = 'B' OR coalesce(pp, 'O') = 'O') THEN 1 ELSE 0 END)
          OVER (PARTITION BY review_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rp
       FROM (SELECT *, lag(gold) OVER (PARTITION BY review_id ORDER BY i) AS pg,
                       lag(pred) OVER (PARTITION BY review_id ORDER BY i) AS pp FROM gp)),
es_g AS (SELECT review_id, min(i) AS s, max(i) AS e FROM sg WHERE gold <> 'O' GROUP BY review_id, rg),
es_p AS (SELECT review_id, min(i) AS s, max(i) AS e FROM sg WHERE pred <> 'O' GROUP BY review_id, rp),
cnt AS (SELECT (SELECT count(*) FROM es_g JOIN es_p USING (review_id, s, e))::DOUBLE AS tp,
               (SELECT count(*) FROM es_p)::DOUBLE AS np, (SELECT count(*) FROM es_g)::DOUBLE AS ng,
               (SELECT avg(CASE WHEN gold = pred THEN 1.0 ELSE 0.0 END) FROM gp) AS acc),
pr AS (SELECT CASE WHEN np = 0 THEN 0.0 ELSE tp / np END AS p, CASE WHEN ng = 0 THEN 0.0 ELSE tp / ng END AS r, acc FROM cnt)
SELECT round(p, 6) AS precision, round(r, 6) AS recall,
       round(CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END, 6) AS f1, round(acc, 6) AS accuracy FROM pr"""
    o["seq_report"] = toks + spans
    o["token_outcomes"] = toks + """
SELECT CASE WHEN gold = 'O' AND pred = 'O' THEN 'TN' WHEN gold = pred THEN 'TP' WHEN gold = 'O' THEN 'FP'
            WHEN pred = 'O' THEN 'FN' ELSE 'FP' END AS outcome, CAST(count(*) AS BIGINT) AS n
FROM gp GROUP BY 1"""
    flags = toks + """,
per AS (SELECT review_id, list(gold ORDER BY i) AS gl, list(pred ORDER BY i) AS pl FROM gp GROUP BY review_id),
ef AS (
  SELECT b.review_id, CAST(CASE WHEN len(b.aspect) = 1 AND b.aspect[1] = 'NULL' THEN 0 ELSE len(b.aspect) END AS BIGINT) AS aspect_size,
    CAST(len(b.text_tokens) AS BIGINT) AS sentence_size,
    list_bool_or(list_transform(b.aspect, x -> x LIKE '% %')) AS composed_aspect, per.gl = per.pl AS is_correct
  FROM bio b JOIN per ON per.review_id = b.review_id WHERE b.status = 'ok')"""
    o["error_flags"] = flags + "\nSELECT * FROM ef"
    o["error_stats"] = flags + """
SELECT is_correct, CAST(count(sentence_size) AS BIGINT) AS count, round(avg(sentence_size), 6) AS mean,
  round(stddev_samp(sentence_size), 6) AS std, CAST(min(sentence_size) AS DOUBLE) AS min, CAST(max(sentence_size) AS DOUBLE) AS max,
  quantile_cont(sentence_size, 0.25) AS q25, quantile_cont(sentence_size, 0.5) AS q50, quantile_cont(sentence_size, 0.75) AS q75
FROM ef GROUP BY is_correct"""
    stats = """CAST(count(sentence_size) AS BIGINT) AS count, round(avg(sentence_size), 6) AS mean,
  round(stddev_samp(sentence_size), 6) AS std, CAST(min(sentence_size) AS DOUBLE) AS min, CAST(max(sentence_size) AS DOUBLE) AS max,
  quantile_cont(sentence_size, 0.25) AS q25, quantile_cont(sentence_size, 0.5) AS q50, quantile_cont(sentence_size, 0.75) AS q75
FROM (SELECT *, aspect_size = 0 AS is_empty FROM ef)"""
    o["error_stats_groupings"] = flags + f"""
SELECT 'correct' AS "grouping", is_correct, NULL::BOOLEAN AS is_empty, NULL::BOOLEAN AS composed_aspect, {stats} GROUP BY is_correct
UNION ALL SELECT 'empty', is_correct, is_empty, NULL, {stats} GROUP BY is_correct, is_empty
UNION ALL SELECT 'composed', is_correct, NULL, composed_aspect, {stats} GROUP BY is_correct, composed_aspect"""
    o["error_stats_out_of_fold"] = flags + """
SELECT g AS "grouping", CAST(count(*) AS BIGINT) AS n_sentences, CAST(min(sentence_size) AS DOUBLE) AS least,
       CAST(max(sentence_size) AS DOUBLE) AS most FROM ef, (VALUES ('correct'), ('empty'), ('composed')) v(g) GROUP BY g"""
    o["tagger_out_of_fold"] = toks + """
SELECT review_id, CAST(review_id % 3 AS BIGINT) AS fold, CAST(count(*) AS BIGINT) AS n_tokens, CAST(count(DISTINCT i) AS BIGINT) AS n_positions,
       CAST(count(*) FILTER (WHERE gold <> 'O') AS BIGINT) AS n_gold, TRUE AS tags_known, CAST(count(*) AS BIGINT) AS n_outcomes
FROM gp GROUP BY review_id"""
    o["metric_store"] = ("SELECT 'naive-bayes' AS run, 'valid' AS split, label, metric, value FROM (SELECT label, "
                         "unnest(['precision', 'recall', 'f1', 'support']) AS metric, unnest([precision, recall, f1, support::DOUBLE]) AS value "
                         f"FROM ({held}))\nUNION ALL SELECT 'rule-tagger', 'gold', 'all', metric, value FROM (SELECT "
                         "unnest(['precision', 'recall', 'f1', 'accuracy']) AS metric, unnest([precision, recall, f1, accuracy]) AS value "
                         f"FROM ({toks + spans}))")
    polarity_list = "list_transform(aspect, a -> ['positive', 'negative', 'neutral', 'conflict'][review_id % 4 + 1])"
    o["build_gold_sources"] = g_with + f"""
SELECT ['sem-eval-2014', 'sem-eval-2015', 'sem-eval-2016', 'mams_atsa'][review_id % 4 + 1] AS source,
       CASE WHEN review_id % 4 = 0 THEN 'laptop' ELSE 'restaurants' END AS domain,
       CASE WHEN review_id % 4 IN (0, 3) AND review_id % 5 = 0 THEN 'test' ELSE 'train' END AS partition, review_text,
       array_to_string(aspect, '|') AS aspect, array_to_string({polarity_list}, '|') AS polarity,
       CASE WHEN review_id % 4 = 0 THEN NULL ELSE len(aspect) END AS n_positions
FROM gold WHERE len(aspect) > 0"""
    o["gold_csv_rejects"] = g_with + """
SELECT CASE review_id % 10 WHEN 0 THEN 'bad_list' WHEN 1 THEN 'no_text' WHEN 2 THEN 'malformed_row' ELSE 'kept' END AS reason,
       CAST(count(*) AS BIGINT) AS n, CAST(sum(CASE WHEN review_id % 10 > 2 THEN len(aspect) ELSE 0 END) AS BIGINT) AS items
FROM gold GROUP BY 1"""
    o["eval_coverage"] = g_with + """
SELECT CAST(count(*) FILTER (WHERE review_id % 7 <> 0) AS BIGINT) AS gold, CAST(count(*) FILTER (WHERE review_id % 9 <> 0) AS BIGINT) AS predicted,
       CAST(count(*) FILTER (WHERE review_id % 7 <> 0 AND review_id % 9 <> 0) AS BIGINT) AS matched,
       CAST(count(*) FILTER (WHERE review_id % 7 <> 0 AND review_id % 9 = 0) AS BIGINT) AS gold_without_prediction,
       CAST(count(*) FILTER (WHERE review_id % 7 = 0 AND review_id % 9 <> 0) AS BIGINT) AS prediction_without_gold
FROM gold"""
    o["aspect_training_set"] = g_with + """,
ts AS (SELECT review_id, array_to_string(list_transform(tags, t -> CASE t WHEN 'O' THEN 0 WHEN 'B' THEN 1 ELSE 2 END), '|') AS codes,
              CASE WHEN len(aspect) = 1 AND aspect[1] = 'NULL' THEN 'non_aspect' ELSE 'aspect' END AS type_aspect
       FROM bio WHERE status = 'ok' AND len(text_tokens) <= 32),
tr AS (SELECT *, row_number() OVER (PARTITION BY type_aspect ORDER BY md5('100:' || CAST(review_id AS VARCHAR)), review_id) AS rn,
              count(*) OVER (PARTITION BY type_aspect) AS n FROM ts)
SELECT type_aspect, review_id, codes, CASE WHEN rn <= ceil(n * 0.2) THEN 'valid' ELSE 'train' END AS split FROM tr"""
    ev = _with(training_ctes(), nb_ctes(), text_ctes(bench_src), rule_ctes(), entity_ctes(), predict_ctes(), gold) + """,
fl AS (SELECT review_id, list(aspect ORDER BY sent_id, rule_no NULLS FIRST, ord_i NULLS FIRST, aspect NULLS FIRST, sentiment) AS aspects,
              list(sentiment ORDER BY sent_id, rule_no NULLS FIRST, ord_i NULLS FIRST, aspect NULLS FIRST, sentiment) AS pp
       FROM pl GROUP BY review_id),
gp2 AS (SELECT gold.review_id, gold.review_text, gold.aspect,
               list_transform(gold.aspect, a -> ['positive', 'negative', 'neutral', 'conflict'][gold.review_id % 4 + 1]) AS polarity,
               fl.aspects, fl.pp,
               """ + _wc("gold.review_text") + """ AS nw
        FROM gold JOIN fl ON fl.review_id = gold.review_id)"""
    left = ev + """,
gl AS (SELECT gold.review_id, gold.aspect, list_transform(gold.aspect, a -> ['positive', 'negative', 'neutral', 'conflict'][gold.review_id % 4 + 1]) AS polarity,
              fl.aspects, fl.pp, """ + _wc("gold.review_text") + """ AS nw
       FROM gold LEFT JOIN fl ON fl.review_id = gold.review_id AND gold.review_id % 9 <> 0)"""
    o["eval_run"] = left + """
SELECT review_id, pp IS NOT NULL AS has_prediction, coalesce(array_to_string(list_transform(aspects, x -> coalesce(x, '')), '|'), '') AS aspects FROM gl"""
    o["eval_polarity_report"] = left + """,
yy AS (SELECT lower(coalesce(polarity[1], 'None')) AS y_true, lower(coalesce(pp[1], 'None')) AS y_pred
       FROM gl WHERE len(aspect) = 1 AND nw >= 5 AND polarity[1] <> 'conflict'),
""" + _REPORT_SQL
    o["eval_polarity"] = ev + """
SELECT review_id, lower(coalesce(polarity[1], 'None')) AS y_true, lower(coalesce(pp[1], 'None')) AS y_pred,
       lower(coalesce(polarity[1], 'None')) = lower(coalesce(pp[1], 'None')) AS ok
FROM gp2 WHERE len(aspect) = 1 AND nw >= 5 AND polarity[1] <> 'conflict'"""
    o["eval_aspect"] = ev + """,
ea AS (SELECT *, CASE WHEN len(aspect) = 0 THEN ['None'] ELSE aspect END AS a2,
              CASE WHEN len(aspect) = 0 THEN ['positive'] ELSE polarity END AS p2 FROM gp2)
SELECT review_id, a2[1] AS gold_aspect,
       coalesce(list_bool_or(list_transform(aspects, p -> instr(a2[1], coalesce(p, 'None')) > 0)), false) AS hit
FROM ea WHERE len(a2) = 1 AND nw <= 15 AND p2[1] <> 'conflict'"""
    o["build_reviews"] = f"""WITH lr AS ({LABELLED})
SELECT source || ':' || review_id AS review_id, source, {clean_sql('review_text')} AS review_text, NULL::DOUBLE AS rating, polarity FROM lr
UNION ALL
SELECT 'lara-tripadvisor:' || conv_id || ':' || review_pos AS review_id, 'lara-tripadvisor' AS source, {clean_sql('text')} AS review_text,
       rating, CASE WHEN rating <= 2 THEN 'negative' WHEN rating >= 3 THEN 'positive' ELSE 'neutral' END AS polarity
FROM (SELECT conv_id, text, role, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS BIGINT) AS review_pos,
             CAST((turn % 5) + 1 AS DOUBLE) AS rating FROM conversations) c WHERE role = 'user' AND text IS NOT NULL
UNION ALL
SELECT 'multi-domain-amazon:' || page_id AS review_id, 'multi-domain-amazon' AS source,
       {clean_sql(_tag('html', 'title'))} AS review_text,
       NULL::DOUBLE AS rating, NULL::VARCHAR AS polarity FROM pages"""
    o["read_tagged_reviews"] = f"""WITH p AS (SELECT page_id, url, {_tag('html', 'title')} AS title FROM pages)
SELECT CASE WHEN regexp_extract(url, '/([a-z]{{2}})/', 1) = '' THEN 'xx' ELSE regexp_extract(url, '/([a-z]{{2}})/', 1) END AS domain,
       CASE WHEN page_id % 2 = 0 THEN 'positive' ELSE 'negative' END AS polarity, url AS product_name,
       CAST(page_id % 5 + 1 AS DOUBLE) AS rating, regexp_replace(coalesce(title, ''), '^\\s+|\\s+$', '', 'g') AS review_text
FROM p"""
    o["read_app_reviews"] = f"""WITH lr AS ({LABELLED}), n AS (SELECT count(*) AS n FROM part),
rv AS (SELECT p.p_name || ' ' || p.p_partkey AS app, lr.review_text, lr.polarity FROM lr CROSS JOIN n JOIN part p ON p.p_partkey = lr.review_id % n.n + 1)
SELECT 'google-play' AS source, rv.app AS product_name, rv.review_text,
       CAST(CASE rv.polarity WHEN 'positive' THEN 0.5 WHEN 'negative' THEN -0.5 ELSE 0.0 END AS DOUBLE) AS rating, rv.polarity
FROM part a JOIN rv ON rv.app = a.p_name || ' ' || a.p_partkey"""
    o["read_app_reviews_by_ranges"] = o["read_app_reviews"]
    dataset = f"""ds1 AS ({o["build_reviews"]}),
ds2 AS ({o["read_app_reviews"]}),
dset AS (SELECT review_id, source, review_text, polarity FROM ds1 UNION ALL
         SELECT source || ':' || md5(product_name || chr(1) || review_text), source, {clean_sql('review_text')}, polarity FROM ds2)"""
    o["reviews_manifest"] = f"""WITH {dataset}
SELECT source, CAST(count(review_text) AS BIGINT) AS rows, CAST(count(*) - count(review_text) AS BIGINT) AS rejects FROM dset GROUP BY source"""
    o["training_from_dataset"] = _with(dataset, training_ctes(
        "SELECT review_id, source, review_text, polarity FROM dset WHERE source IN ('google-play', 'lara-tripadvisor') "
        "AND review_text IS NOT NULL")) + "\nSELECT review_id, polarity FROM bal"
    o["read_gold_xml"] = g_with + """
SELECT review_text, array_to_string(aspect, '|') AS aspect,
       array_to_string(list_transform(aspect, a -> ['positive', 'negative', 'neutral', 'conflict'][review_id % 4 + 1]), '|') AS polarity,
       CASE WHEN review_id % 5 = 0 THEN 'test' ELSE 'train' END AS partition,
       array_to_string(list_transform(aspect, a -> CAST(instr(review_text, a) AS VARCHAR)), '|') AS starts
FROM gold WHERE len(aspect) > 0"""
    o["build_gold"] = g_with + """
SELECT 'mams_atsa' AS source, CASE WHEN review_id % 5 = 0 THEN 'test' ELSE 'train' END AS partition,
       'restaurants' AS domain, review_text, array_to_string(aspect, '|') AS aspect FROM gold WHERE len(aspect) > 0
UNION ALL
SELECT 'sem-eval-2014', 'train', 'laptop', review_text, array_to_string(aspect, '|') FROM gold
WHERE len(aspect) > 0 AND review_id % 5 <> 0"""
    o["aspect_type_counts"] = g_with + """
SELECT CASE WHEN len(asp) = 1 AND asp[1] = 'NULL' THEN 'non_aspect' ELSE 'aspect' END AS type_aspect,
       CAST(count(*) AS BIGINT) AS n FROM gi GROUP BY 1"""
    o["polarity_accuracy"] = ev + """
SELECT round(avg(CASE WHEN lower(coalesce(polarity[1], 'None')) = lower(coalesce(pp[1], 'None')) THEN 1.0 ELSE 0.0 END), 6)
       AS accuracy, CAST(count(*) AS BIGINT) AS n
FROM gp2 WHERE len(aspect) = 1 AND nw >= 5 AND polarity[1] <> 'conflict'"""
    o["production_split"] = (
        f"WITH lr AS ({LABELLED}), r AS (SELECT review_id, polarity, row_number() OVER (PARTITION BY polarity "
        "ORDER BY md5('100:' || CAST(review_id AS VARCHAR)), review_id) AS rn, count(*) OVER (PARTITION BY polarity) AS n "
        "FROM lr) SELECT polarity, review_id, 'train' AS split FROM r "
        "UNION ALL SELECT polarity, review_id, 'valid' AS split FROM r WHERE rn <= ceil(n * 0.2)")
    o["reviews_roundtrip"] = o["build_reviews"].replace(
        "WITH lr AS", "WITH br AS (WITH lr AS", 1) + ") SELECT * FROM br WHERE source = 'lara-tripadvisor'"
    o["predictions_csv"] = o["predict_flat"]
    op = g_with + """,
ops AS (SELECT review_id, review_text, aspect, review_id // 4 AS rid,
               min(CASE WHEN len(aspect) = 0 THEN review_id END) OVER (PARTITION BY review_id // 4) AS first_bad
        FROM gold)
SELECT review_text, array_to_string(aspect, '|') AS aspect,
       array_to_string(list_transform(aspect, a -> ['positive', 'negative', 'neutral', 'conflict'][review_id % 4 + 1]), '|') AS polarity,
       'train' AS partition, 'sem-eval-2015' AS source
FROM ops WHERE len(aspect) > 0"""
    o["read_gold_opinions"] = op
    o["read_gold_opinions_compat"] = op + " AND (first_bad IS NULL OR review_id < first_bad)"
    return o


def _lambdas(sql: str) -> str:
    """DuckDB's lambda syntax: ``x -> e`` is written ``lambda x: e``."""
    return re.sub(r"\b([a-z_][a-z_0-9]*) -> ", r"lambda \1: ", sql)


ORACLES: dict[str, str] = {k: _lambdas(v) for k, v in build().items()}
