"""Annotation and extraction over Arrow batches of reviews.

The same sentences, tokens, links, rules and windows as ``annotate`` / ``rules`` / ``spans`` and
``inrow``.  The tokens of many reviews are flat arrays (one number per distinct word, sentence
after sentence), and every step is a handful of numpy operations over them, so a token costs
about a microsecond; only distinct words, sentences and findings are looked at one by one.  Each
step is linear in the tokens; a chunk holds ``CHUNK`` characters, or one review.

Plans stay one narrow stage: (id, text) in, rows out, on batches and streams alike.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .. import schema as S
from ..functions import text as TX
from ..session import ship_package
from . import annotate as A

K = A.SENT_KEYS
INPUT = ("review_id", "review_text")
CHUNK = 1 << 20             # characters of text that are looked at together
OUT_ROWS = 1 << 16          # rows of an Arrow batch handed back

KINDS = ["noun", "pron", "be", "verb", "intj", "adj", "adv", "det", "neg", "modal", "punct", "clitic", "num"]
DEPS = ["dep", "ROOT", "nsubj", "nsubjpass", "attr", "dobj", "det", "amod", "acomp", "advmod", "neg", "aux", "auxpass", "punct", "cop"]
_K = {k: i for i, k in enumerate(KINDS)}
_D = {d: i for i, d in enumerate(DEPS)}


# ---------------------------------------------------------------------------------------
# sentences and tokens
# ---------------------------------------------------------------------------------------
class _Clean(dict):
    """T2 and T3 of one character, for ``str.translate``."""

    def __missing__(self, cp: int) -> str:
        folded = unicodedata.normalize("NFKD", chr(cp)).encode("ascii", "ignore").decode() if cp > 127 else chr(cp)
        self[cp] = x = "".join(c if _WHITE.match(c) else " " for c in folded)
        return x


_WHITE = re.compile(TX.NON_WHITELIST.replace("[^", "["))
_CLEAN = _Clean()
_BLANK = " \t\n\x0b\f\r"
_BOUNDARY = re.compile(TX.SENTENCE_BOUNDARY)
_NT = re.compile(r"n't\b", re.A)
_TOKEN = re.compile(TX.TOKEN_PATTERN.replace("(", "(?:", 1) + "|\n", re.A)


def clean(piece: str) -> str:
    """T1."""
    return " ".join(piece.translate(_CLEAN).split())


def kind_of(low: str) -> str:
    """N1 of a lower-cased word."""
    for words, kind in ((S.LEX_DET, "det"), (S.LEX_BE, "be"), (S.LEX_MODAL, "modal"),
                        (S.LEX_NEG, "neg"), (S.LEX_PRON, "pron"), (S.LEX_INTJ, "intj")):
        if low in words:
            return kind
    if len(low) == 1 and low in S.PUNCT_CHARS:
        return "punct"
    if low.startswith("'"):
        return "clitic"
    if low.isdigit():
        return "num"
    if low.endswith(S.ADV_SUFFIX):
        return "adv"
    if low.endswith(tuple(S.ADJ_SUFFIXES)):
        return "adj"
    return "verb" if low.endswith(S.VERB_SUFFIX) else "noun"


_STOP = frozenset(S.STOP_WORDS)


class Words:
    """The sentences of some texts and their tokens.

    Per sentence: ``rev`` (number of its text), ``sent_id``, ``sentences``, ``first`` (number of its
    first token; one more at the end).  Per token: ``code`` (number in ``vocab``), ``idx``, ``sent``
    and ``i``.  Per distinct word: ``vocab``, ``low``, ``kind``, ``stop``."""

    def __init__(self, texts: list[str | None], split: bool = True):
        """Without ``split`` a text is one sentence."""
        rev, sent_id, sentences = [], [], []
        for r, t in enumerate(texts):
            if t is None:
                continue
            for k, piece in enumerate(_BOUNDARY.sub("\\1" + TX.SENT_MARK, t).split(TX.SENT_MARK) if split else [t]):
                if piece.strip(_BLANK):
                    rev.append(r)
                    sent_id.append(k)
                    sentences.append(clean(piece))
        self.sentences = sentences
        self.rev, self.sent_id = np.array(rev, dtype=np.int64), np.array(sent_id, dtype=np.int32)
        text = "\n".join([*sentences, ""])
        if "n't" in text:
            text = _NT.sub(TX.NT_MARK + "n't", text)
        found = pa.array(_TOKEN.findall(text), pa.string()).dictionary_encode()
        codes, numbers, width, end = found.indices.to_numpy(), {}, [], -1
        for j, x in enumerate(found.dictionary.to_pylist()):
            x = x.replace(TX.NT_MARK, "")
            width.append((len(x), numbers.setdefault(x.strip(" "), len(numbers)) if x != "\n" else 0))
            end = j if x == "\n" else end
        width, number = np.array(width or [(0, 0)], dtype=np.int64).T
        ends = np.flatnonzero(codes == end)
        count = np.diff(np.r_[-1, ends]) - 1
        codes = codes[codes != end]
        self.first = np.r_[0, np.cumsum(count)].astype(np.int64)
        self.n = count                                          # tokens per sentence
        self.sent = np.repeat(np.arange(len(count)), count)
        self.i = (np.arange(len(codes)) - self.first[self.sent]).astype(np.int32)
        before = np.r_[0, np.cumsum(width[codes])]
        self.idx = (before[:-1] - before[self.first[self.sent]]).astype(np.int32)
        self.code = number[codes]
        self.vocab = list(numbers)
        self.low = [x.lower() for x in self.vocab]
        self.kind = np.array([_K[kind_of(x)] for x in self.low], dtype=np.int8)
        self.stop = np.array([x in _STOP for x in self.low], dtype=bool)

    def flag(self, test: Callable[[str], bool]) -> np.ndarray:
        """Per token whether its text passes."""
        return np.array([test(x) for x in self.vocab], dtype=bool)[self.code]


# ---------------------------------------------------------------------------------------
# links (N2)
# ---------------------------------------------------------------------------------------
def _first_of(groups: int, of: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Per group the least of the (sorted) tokens ``at``, or -1."""
    out = np.full(groups, -1, dtype=np.int64)
    out[of[at[::-1]]] = at[::-1]
    return out


def _last_of(groups: int, of: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = np.full(groups, -1, dtype=np.int64)
    out[of[at]] = at
    return out


def _next(at: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Per token the least of the (sorted) tokens ``at`` after it up to ``hi``, or -1."""
    at = np.r_[at, len(hi)]
    x = at[np.searchsorted(at, np.arange(len(hi)), side="right").clip(max=len(at) - 1)]
    return np.where(x <= hi, x, -1)


def link(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Per token ``dep`` (number in ``DEPS``) and the number of its head."""
    n = len(w.code)
    at, kind = np.arange(n), w.kind[w.code]
    if not n:
        return np.empty(0, dtype=np.int8), at
    sep = w.flag(lambda x: x in tuple(S.CLAUSE_CHARS))
    start = (w.i == 0) | np.r_[True, sep[:-1]]
    cl = np.cumsum(start) - 1
    m = int(cl[-1]) + 1
    hi = (np.r_[np.flatnonzero(start)[1:], n] - 1)[cl]
    of = lambda *names: np.isin(kind, [_K[k] for k in names])
    every = lambda mask: np.flatnonzero(mask)
    be = _first_of(m, cl, every(of("be")))
    pred = _first_of(m, cl, every(of("verb")))
    for other in (be, _first_of(m, cl, every(of("intj")))):
        pred = np.where(pred < 0, other, pred)
    pk = np.where(pred >= 0, kind[pred], -1)
    passive = (pk == _K["verb"]) & (be >= 0) & (be < pred)
    p, pk = pred[cl], pk[cl]
    ahead, behind = (p >= 0) & (at > p), at < p
    nouns = of("noun")
    subj = _last_of(m, cl, every(of("noun", "pron") & behind))[cl]
    after = _first_of(m, cl, every(nouns & ahead))[cl]
    next_noun = _next(every(nouns), hi)
    next_head = _next(every(~of("adv", "adj")), hi)
    by_be, by_verb = pk == _K["be"], pk == _K["verb"]
    adj, isbe = of("adj"), of("be")
    d = _D
    dep = np.select(
        [at == p, at == subj, nouns & (at == after) & by_be, nouns & (at == after) & by_verb, nouns, of("det"),
         adj & (next_head >= 0) & (kind[next_head] == _K["noun"]), adj & ahead & by_be, adj & ahead & by_verb,
         of("adv"), of("neg"), of("modal"), isbe & by_verb & behind, isbe, of("punct")],
        [d["ROOT"], np.where(passive[cl], d["nsubjpass"], d["nsubj"]), d["attr"], d["dobj"], d["dep"], d["det"],
         d["amod"], d["acomp"], d["dobj"], d["advmod"], d["neg"], d["aux"], d["auxpass"], d["aux"], d["punct"]], d["dep"]).astype(np.int8)
    to = np.where(p >= 0, p, at)
    joins = (dep == d["advmod"]) & (at < hi) & np.r_[of("adj", "adv")[1:], False]
    head = np.select([dep == d["det"], dep == d["amod"], joins],
                     [np.where(next_noun >= 0, next_noun, to), next_head, at + 1], to)
    return dep, head


# ---------------------------------------------------------------------------------------
# rules, entities, windows
# ---------------------------------------------------------------------------------------
def findings(w: Words, compat_rule_ids: bool = False) -> dict[str, list]:
    """The findings of the seven rules: token numbers ``at`` (aspect) and ``ord`` and the
    columns of a finding, pronouns and entities settled."""
    dep, head = link(w)
    n, at, kind, stop = len(w.code), np.arange(len(w.code)), w.kind[w.code], w.stop[w.code]
    child = head != at
    live = child & ~stop
    is_ = lambda *names: np.isin(dep, [_D[x] for x in names])
    last = lambda mask: _last_of(n, head, np.flatnonzero(mask))
    nsubj, subj_any = last(live & is_("nsubj")), last(live & is_("nsubj", "nsubjpass"))
    dobj_adj, acomp = last(live & is_("dobj") & (kind == _K["adj"])), last(live & is_("acomp"))
    advmod, attr, cop = last(live & is_("advmod")), last(live & is_("attr")), last(live & is_("cop"))
    first_adv = _first_of(n, head, np.flatnonzero(child & is_("advmod")))
    neg = last(child & is_("neg"))
    modal = last(child & (is_("neg") | (is_("aux") & (kind == _K["modal"]))))
    no_det = last(child & is_("det") & w.flag(lambda x: x == "no")) >= 0
    code, vocab = w.code, w.vocab
    word = lambda i: vocab[code[i]] if i >= 0 else None
    joined = lambda *parts: " ".join([x for x in parts if x is not None])

    out = {c: [] for c in ("at", "ord", "rule_no", "aspect", "modifier", "rule")}
    capital = (w.i > 0) & w.flag(lambda x: "A" <= x[:1] <= "Z")

    def add(rule_no, h, aspect_at, modifier, rule):
        i, aspect = int(aspect_at), word(aspect_at)
        if aspect in S.PRODUCT_PRONOUNS:
            aspect = S.PRODUCT_ASPECT
        if capital[i] and not (i + 1 < n and w.sent[i + 1] == w.sent[i] and capital[i + 1]):
            lo = i
            while capital[lo - 1]:              # the first token of a sentence is in no run
                lo -= 1
            aspect = " ".join([word(j) for j in range(lo, i + 1)])
        for c, v in zip(out.values(), (i, int(h), rule_no, aspect, modifier, rule)):
            c.append(v)

    for i in np.flatnonzero(is_("amod") & ~stop).tolist():
        h = head[i]
        add(1, i, h, joined("not" if no_det[h] else None, word(first_adv[i]), word(i)), "r1")
    ns = nsubj >= 0
    for h in np.flatnonzero(ns & (dobj_adj >= 0)).tolist():
        add(2, h, nsubj[h], joined(word(neg[h]), word(dobj_adj[h])), "r2")
    for h in np.flatnonzero(ns & (acomp >= 0)).tolist():
        m = modal[h]
        add(3, h, nsubj[h], joined(None if m < 0 else word(m) if dep[m] == _D["neg"] else "not", word(acomp[h])), "r3")
    for h in np.flatnonzero((subj_any >= 0) & (advmod >= 0)).tolist():
        a = advmod[h]
        add(4, h, subj_any[h], joined(word(neg[h]), word(first_adv[a]), word(a)), "r4")
    for h in np.flatnonzero(ns & (cop >= 0)).tolist():
        add(5, h, nsubj[h], word(h), "r5")
    for h in np.flatnonzero(ns & (kind == _K["intj"]) & ~stop).tolist():
        add(6, h, nsubj[h], word(h), S.COMPAT_RULE6_ID if compat_rule_ids else "r6")
    for h in np.flatnonzero(ns & (attr >= 0)).tolist():
        add(7, h, nsubj[h], joined(word(neg[h]), word(attr[h])), "r7")
    return out


def bounds(pos: np.ndarray, group: np.ndarray, n: np.ndarray, window: int, keep_duplicates: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """``spans.bounds_from_neighbours`` for positions ``pos`` in groups of ``n`` tokens."""
    base = int(n.max(initial=0)) + 1
    key = group * base + pos
    spots = np.sort(key) if keep_duplicates else np.unique(key)
    k = np.searchsorted(spots, key)
    cnt = np.searchsorted(spots, (group + 1) * base) - np.searchsorted(spots, group * base)
    around = np.r_[-1, spots, -1]
    prv, nxt = around[k], around[k + 2]
    no_prv, no_nxt = (prv < 0) | (prv // base != group), (nxt < 0) | (nxt // base != group)
    prv, nxt = prv % base, nxt % base
    r0, l0 = np.minimum(pos + window, n), np.maximum(pos - window, 0)
    right = np.where((cnt == 1) | no_nxt, n, np.where(r0 < nxt, r0, nxt - 1))
    left = np.where((cnt == 1) | no_prv, 0, np.where(l0 > prv, l0, prv + 1))
    right = np.where(right < 0, right + n, right)
    return left, np.minimum(n, np.maximum(left, right))


def span_sums(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Sums of ``values[lo:hi]``, each span for itself (0 for an empty one)."""
    if not len(lo):
        return np.empty(0)
    sums = np.add.reduceat(np.r_[values, 0.0], np.stack([lo, np.maximum(lo, hi)], axis=1).ravel())[::2]
    return np.where(hi > lo, sums, 0.0)


# ---------------------------------------------------------------------------------------
# log-odds of words
# ---------------------------------------------------------------------------------------
class Odds:
    """The log-odds of the frequent words of a model, for Python workers: as many bytes as the
    head of the vocabulary that is broadcast to joins."""

    def __init__(self, head: DataFrame):
        rows = head.toArrow()
        self.words = rows.column("word").combine_chunks()
        self.lo = pc.fill_null(rows.column("lo"), 0.0).to_numpy()

    def of(self, low: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(log-odds or 0, whether known) of lower-cased words."""
        at = pc.index_in(pa.array(low, self.words.type), value_set=self.words)
        known = at.is_valid().to_numpy(zero_copy_only=False)
        lo = np.zeros(len(low))
        if known.any():
            lo[known] = self.lo[at.drop_null().to_numpy()]
        return lo, known


def unknown_words(w: Words, known: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pa.Array:
    """Per span of tokens [lo, hi) its lower-cased words that are not ``known``."""
    unknown = np.flatnonzero(~known[w.code])
    a, z = np.searchsorted(unknown, lo), np.searchsorted(unknown, np.maximum(lo, hi))
    return pa.array([[w.low[c] for c in w.code[unknown[x:y]].tolist()] for x, y in zip(a.tolist(), z.tolist())], pa.list_(pa.string()))


# ---------------------------------------------------------------------------------------
# DataFrames
# ---------------------------------------------------------------------------------------
def chunks(batches: Iterator[pa.RecordBatch], text: int = 1) -> Iterator[pa.RecordBatch]:
    """Slices of the batches of about ``CHUNK`` characters of text, a review at least."""
    for b in batches:
        lengths = pc.fill_null(pc.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False).cumsum()
        lo = 0
        while lo < b.num_rows:
            hi = max(lo + 1, int(np.searchsorted(lengths, (lengths[lo - 1] if lo else 0) + CHUNK, side="right")))
            yield b.slice(lo, hi - lo)
            lo = hi


def rows_out(columns: list, names: list[str]) -> Iterator[pa.RecordBatch]:
    out = pa.RecordBatch.from_arrays(columns, names=names)
    for lo in range(0, out.num_rows, OUT_ROWS):
        yield out.slice(lo, OUT_ROWS)


def _strings(names: list[str], codes: np.ndarray) -> pa.Array:
    return pa.array(names, pa.string()).take(pa.array(codes))


def map_reviews(reviews: DataFrame, run, columns: str) -> DataFrame:
    """``run`` over Arrow batches of (review_id, review_text, any other column) -> review_id and ``columns``."""
    ship_package(reviews.sparkSession)
    return reviews.mapInArrow(run, f"review_id {reviews.schema['review_id'].dataType.simpleString()}, {columns}")


_TOKEN_TYPES = {"i": "int", "idx": "int", "text": "string", "lemma": "string", "pos": "string", "tag": "string",
                "dep": "string", "head_i": "int", "is_stop": "boolean"}


def token_rows(reviews: DataFrame, columns: tuple[str, ...] = tuple(_TOKEN_TYPES)) -> DataFrame:
    """(review_id, review_text) -> the token table: ``SENT_KEYS`` and those of its ``columns``."""
    def run(batches):
        for b in chunks(batches):
            w = Words(b.column(1).to_pylist())
            dep, head = link(w) if {"dep", "head_i"} & set(columns) else (None, None)
            kinds = w.kind[w.code]
            make = {
                "i": lambda: pa.array(w.i), "idx": lambda: pa.array(w.idx), "text": lambda: _strings(w.vocab, w.code),
                "lemma": lambda: _strings(w.low, w.code), "pos": lambda: _strings([A._POS_TAG[k][0] for k in KINDS], kinds),
                "tag": lambda: _strings([A._POS_TAG[KINDS[k]][1] or x for x, k in zip(w.vocab, w.kind)], w.code),
                "dep": lambda: _strings(DEPS, dep), "head_i": lambda: pa.array((head - w.first[w.sent]).astype(np.int32)),
                "is_stop": lambda: pa.array(w.stop[w.code])}
            ids = b.column(0).take(pa.array(w.rev[w.sent]))
            yield from rows_out([ids, pa.array(w.sent_id[w.sent]), *[make[c]() for c in columns]], [*K, *columns])

    return map_reviews(reviews.select(*INPUT), run, "sent_id int, " + ", ".join(f"{c} {_TOKEN_TYPES[c]}" for c in columns))


def sentence_words(reviews: DataFrame) -> DataFrame:
    """(review_id, review_text) -> ``SENT_KEYS`` and the ``words`` of each sentence."""
    def run(batches):
        for b in chunks(batches):
            w = Words(b.column(1).to_pylist())
            words = pa.ListArray.from_arrays(pa.array(w.first.astype(np.int32)), _strings(w.vocab, w.code))
            yield from rows_out([b.column(0).take(pa.array(w.rev)), pa.array(w.sent_id), words], [*K, "words"])

    return map_reviews(reviews.select(*INPUT), run, "sent_id int, words array<string>")


def word_counts(labelled: DataFrame) -> DataFrame:
    """(positive: boolean, text) -> (word, n_pos, n_neg), added up within each chunk."""
    def run(batches):
        for b in chunks(batches):
            w = Words(b.column(1).to_pylist(), split=False)
            low = {x: j for j, x in enumerate(dict.fromkeys(w.low))}
            word = np.array([low[x] for x in w.low], dtype=np.int64)[w.code]
            positive = b.column(0).to_numpy(zero_copy_only=False).astype(bool)[w.rev[w.sent]]
            counts = [np.bincount(word[part], minlength=len(low)) for part in (positive, ~positive)]
            yield from rows_out([pa.array(list(low), pa.string()), *map(pa.array, counts)], ["word", "n_pos", "n_neg"])

    ship_package(labelled.sparkSession)
    return labelled.mapInArrow(run, "word string, n_pos long, n_neg long")


FOUND = [("rule_no", "int"), ("ord_i", "int"), ("aspect", "string"), ("modifier", "string"), ("rule", "string"),
         ("aspect_idx", "int"), ("aspect_i", "int"), ("win_left", "int"), ("win_right", "int"), ("aspect_sentence", "string")]


def extract(reviews: DataFrame, window: int = S.WINDOW_MAIN, compat_rule_ids: bool = False,
            keep_duplicates: bool = False, odds: Odds | None = None, with_rest: bool = False) -> DataFrame:
    """(review_id, review_text) -> the rows of ``rules.extract_aspects``.  With ``odds`` also
    ``win_lo``, the sum of the log-odds of each window's words; ``with_rest`` adds ``win_rest``,
    those of them (lower-cased) that ``odds`` does not know."""
    more = ([("win_lo", "double")] if odds is not None else []) + ([("win_rest", "array<string>")] if with_rest else [])
    shared = None if odds is None else reviews.sparkSession.sparkContext.broadcast(odds)

    def run(batches):
        for b in chunks(batches):
            w = Words(b.column(1).to_pylist())
            f = findings(w, compat_rule_ids)
            at = np.array(f["at"], dtype=np.int64)
            sent = w.sent[at]
            left, right = bounds(w.i[at].astype(np.int64), sent, w.n[sent], window, keep_duplicates)
            # sentences without a finding: one row, the whole sentence
            rest = np.setdiff1d(np.arange(len(w.sentences)), sent)
            none, zero = pa.nulls, np.zeros(len(rest), dtype=np.int64)
            lo, hi = np.r_[left, zero], np.r_[right, w.n[rest]]
            sents = np.r_[sent, rest]
            a, z = w.first[sents] + lo, w.first[sents] + hi
            texts = []
            size = np.array([len(x) for x in w.vocab] or [0], dtype=np.int64)
            for s, l, r in zip(sents.tolist(), a.tolist(), z.tolist()):
                texts.append(w.sentences[s][w.idx[l]:w.idx[r - 1] + size[w.code[r - 1]]] if r > l else "")
            whole = lambda values, kind: pa.concat_arrays([pa.array(values, kind), none(len(rest), kind)])
            first = w.first[sent]
            columns = [
                b.column(0).take(pa.array(w.rev[sents])), pa.array(w.sent_id[sents]), whole(f["rule_no"], pa.int32()),
                whole((np.array(f["ord"], dtype=np.int64) - first).astype(np.int32), pa.int32()), whole(f["aspect"], pa.string()),
                whole(f["modifier"], pa.string()), whole(f["rule"], pa.string()), whole(w.idx[at], pa.int32()),
                whole(w.i[at], pa.int32()), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)), pa.array(texts, pa.string())]
            if shared is not None:
                value, known = shared.value.of(w.low)
                columns.append(pa.array(span_sums(value[w.code], a, z)))
                if with_rest:
                    columns.append(unknown_words(w, known, a, z))
            yield from rows_out(columns, [*K, *[c for c, _ in FOUND + more]])

    return map_reviews(reviews.select(*INPUT), run, "sent_id int, " + ", ".join(f"{c} {t}" for c, t in FOUND + more))
