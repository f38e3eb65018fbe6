"""Language identification by prediction by partial matching (PPM).

Per language, a variable-order byte context tree (orders 0 to ``ORDER``, escape method C)
is counted over lower-cased words; a context starts anew at each white-space character, so
the exact code length of a word under the frozen statistics depends on the word alone.  A
document's code length is the sum over all its words; the language with the shortest one
wins, and the score is its share of the likelihoods at equal priors.

The trees are counted as Spark sums over n-grams of bytes, from all texts that have a language:
first their words are counted, then the n-grams of each distinct word, by the word's count.  The
frozen tables (one row per context and symbol, with the
blended log-probability of every language) are made for a group of languages at a time: a group
holds as many languages as its tables fit in ``TABLE_BYTES``, and the texts pass by one group
after another.  So the order of the contexts is the same however many languages there are, and
what goes to the executors at once is bounded.

A language also has a range: how many bits a byte its own texts take.  A text far above the
range of the language that codes it shortest is in none of the languages (``told``).
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketstream.llm.common import arrow_map, fold, table, texts, written

ORDER = 4
TABLE_BYTES = 160_000_000 # frozen tables that go to the executors at once, about
RANGE_DIGITS = 3          # of the bits a byte that ranges are taken from
WORDS_KEPT = 200_000      # words whose code lengths a task remembers
SLICE_CHARS = 2_000_000   # text scored in one go inside a task
LEAST_SPREAD = 0.5        # bits a byte that a spread counts as at least
CHANCE_BITS = 12.0        # bits a byte that chance adds to a text, by the root of its bytes
END = 0x20                # stands before and after every word


def _symbols(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The words' bytes, each between two END symbols, and the index of each word's end."""
    raw = np.frombuffer((" " + "  ".join(words) + " ").encode(), np.uint8).astype(np.int64)
    # words hold no space, so the (2k+1)-th space ends the k-th word
    return raw, np.flatnonzero(raw == END)[1::2]


def _contexts(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """How many symbols stand before each position in its word (0: the opening END, which
    is not coded), and per order the packed context."""
    starts = np.concatenate([[0], ends[:-1] + 1])
    before = np.arange(len(raw)) - np.repeat(starts, ends - starts + 1)
    ctx, packed = [np.zeros(len(raw), np.int64)], np.zeros(len(raw), np.int64)
    for k in range(1, ORDER + 1):
        shifted = np.zeros_like(raw)
        shifted[k:] = raw[:-k]
        packed = packed | shifted << (8 * (k - 1))
        ctx.append(packed)
    return before, ctx


@dataclass
class Trees:
    """Frozen context trees of all languages.  Per order: sorted (context, symbol) keys with
    blended natural log-probabilities [key, language]; sorted contexts with log escapes."""

    langs: list[str]
    keys: list[np.ndarray]
    logp: list[np.ndarray]
    ctxs: list[np.ndarray]
    esc: list[np.ndarray]

    @classmethod
    def freeze(cls, langs: list[str], order: np.ndarray, key: np.ndarray, lang: np.ndarray,
               count: np.ndarray) -> Trees:
        t = cls(langs, [], [], [], [])
        for k in range(ORDER + 1):
            own = order == k
            keys, at = np.unique(key[own], return_inverse=True)
            c = np.zeros((len(keys), len(langs)))
            np.add.at(c, (at, lang[own]), count[own])
            ctxs, of = np.unique(keys >> 8, return_inverse=True)
            total = np.zeros((len(ctxs), len(langs)))
            kinds = np.zeros((len(ctxs), len(langs)))
            np.add.at(total, of, c)
            np.add.at(kinds, of, c > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                esc = np.where(total > 0, np.log(kinds / (total + kinds)), 0.0)
                seen = np.log(c / (total + kinds)[of])
            # the context less its oldest symbol, for the same symbol
            drop = (1 << 8 * k) - 1 if k else 0
            lower = t._blend(keys & drop, k - 1) if k else np.full(c.shape, -np.log(256.0))
            t.keys.append(keys)
            t.ctxs.append(ctxs)
            t.esc.append(esc.astype(np.float32))
            t.logp.append(np.where(c > 0, seen, esc[of] + lower).astype(np.float32))
        return t

    def _blend(self, key: np.ndarray, k: int) -> np.ndarray:
        """Blended log-probabilities of packed (context << 8 | symbol) keys of order k."""
        out = np.zeros((len(key), len(self.langs)), np.float32)
        left = np.arange(len(key))
        while k >= 0 and len(left):
            at = np.minimum(np.searchsorted(self.keys[k], key), max(0, len(self.keys[k]) - 1))
            hit = self.keys[k][at] == key if len(self.keys[k]) else np.zeros(len(key), bool)
            out[left[hit]] += self.logp[k][at[hit]]
            left, key = left[~hit], key[~hit]
            ctx = key >> 8
            if len(left) and len(self.ctxs[k]):
                at = np.minimum(np.searchsorted(self.ctxs[k], ctx), len(self.ctxs[k]) - 1)
                hit = self.ctxs[k][at] == ctx
                out[left[hit]] += self.esc[k][at[hit]]
            key = key & ((1 << 8 * k) - 1)      # drop the oldest symbol
            k -= 1
        if len(left):
            out[left] -= np.log(256.0)
        return out

    def words(self, words: list[str]) -> np.ndarray:
        """Log-likelihood [word, language] of whole words."""
        raw, ends = _symbols(words)
        before, ctx = _contexts(raw, ends)
        out = np.zeros((len(raw), len(self.langs)), np.float32)
        for k in range(1, ORDER + 1):
            # positions with fewer symbols before them use a shorter context
            at = np.flatnonzero(before >= k if k == ORDER else before == k)
            out[at] = self._blend(ctx[k][at] << 8 | raw[at], k)
        starts = np.concatenate([[0], ends[:-1] + 1])
        return np.add.reduceat(out, starts, axis=0)


@dataclass
class Languages:
    """The frozen trees, for groups of languages in the order of their names, and the range of
    each language: the median of its texts' bits a byte, and the spread above it."""

    groups: list[Trees]
    ranges: dict[str, tuple[float, float]]


def _sampled(docs: DataFrame, sample_docs: int | None) -> tuple[DataFrame, list[str]]:
    """The rows of ``docs`` that have a language, and all languages by name.  Where the caller
    asks for ``sample_docs``, about so many documents per language, chosen by a hash of the id."""
    named = docs.where(F.col("lang").isNotNull())
    sizes = {r["lang"]: r["n"] for r in named.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(sizes)
    if not langs or sample_docs is None:
        return named, langs
    rate = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(min(1.0, sample_docs / sizes[k])))])
    draw = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(10)), F.lit(1 << 20)) / (1 << 20)
    return named.where(draw < rate[F.col("lang")]), langs


def _word_counts(chosen: DataFrame) -> DataFrame:
    """(lang, word, n): how often each lower-cased word comes in the texts of each language."""
    def make():
        def step(b: pa.RecordBatch):
            counts: dict[str, Counter] = {}
            for lang, text in zip(b.column("lang").to_pylist(), texts(b, "text"), strict=True):
                counts.setdefault(lang, Counter()).update(text.lower().split())
            return [[x for lang, c in counts.items() for x in [lang] * len(c)],
                    [w for c in counts.values() for w in c],
                    [n for c in counts.values() for n in c.values()]]

        return step

    return (arrow_map(chosen.select("lang", "text"), make, "lang string, word string, n long")
            .groupBy("lang", "word").agg(F.sum("n").alias("n")))


def _grouped(langs: list[str], entries: dict[str, int]) -> list[list[str]]:
    """Languages by name, cut where the tables of a group would outgrow TABLE_BYTES; a row of
    the tables has a key and a number for every language."""
    out: list[list[str]] = [[]]
    for lang in langs:
        more = [*out[-1], lang]
        if out[-1] and sum(entries.get(k, 0) for k in more) * (8 + 4 * len(more)) > TABLE_BYTES:
            out.append([lang])
        else:
            out[-1] = more
    return out


def fit(docs: DataFrame, sample_docs: int | None = None) -> Languages | None:
    """Context trees and ranges from all rows of ``docs`` (id, lang, text) that have a language;
    with ``sample_docs`` from about so many whole documents per language, chosen by a hash of
    the id.  None if no row has a language."""
    chosen, langs = _sampled(docs, sample_docs)
    if not langs:
        return None

    def make():
        def step(b: pa.RecordBatch):
            rows = {}
            for lang, word, n in zip(*(b.column(c).to_pylist() for c in ("lang", "word", "n")),
                                     strict=True):
                words, counts = rows.setdefault(lang, ([], []))
                words.append(word)
                counts.append(n)
            out = []
            for lang, (words, counts) in rows.items():
                raw, ends = _symbols(words)
                before, ctx = _contexts(raw, ends)
                times = np.repeat(counts, np.diff(np.concatenate([[-1], ends])))
                for k in range(ORDER + 1):
                    at = np.flatnonzero(before >= max(k, 1))
                    key, of = np.unique(ctx[k][at] << 8 | raw[at], return_inverse=True)
                    n = np.zeros(len(key), np.int64)
                    np.add.at(n, of, times[at])
                    out.append(([lang] * len(key), np.full(len(key), k), key, n))
            return [[x for col in out for x in col[0]],
                    *(np.concatenate(x) for x in list(zip(*out, strict=True))[1:])]

        return step

    grams = written(arrow_map(_word_counts(chosen), make, "lang string, k int, gram long, n long")
                    .groupBy("lang", "k", "gram").agg(F.sum("n").alias("n")))
    entries = {r["lang"]: r["c"] for r in grams.groupBy("lang")
               .agg(F.count(F.lit(1)).alias("c")).collect()}
    groups = []
    for names in _grouped(langs, entries):
        # bounded by TABLE_BYTES, or by the distinct n-grams of one language
        number = F.create_map(*[x for j, k in enumerate(names) for x in (F.lit(k), F.lit(j))])
        t = (grams.where(F.col("lang").isin(names))
             .select("k", "gram", number[F.col("lang")].alias("lang"), "n").toArrow())
        groups.append(Trees.freeze(names, *(t.column(c).to_numpy() for c in ("k", "gram", "lang", "n"))))
        del t
    out = Languages(groups, {})
    bits = _coded(chosen.select("lang", "text"), out, "text", ["lang"]).where(
        (F.col("best") == F.col("lang")) & (F.col("size") > 0))
    # rounded, so that what a percentile keeps of a language is bounded
    bits = bits.groupBy("lang", F.round(-F.col("top") / F.col("size") / float(np.log(2)),
                                        RANGE_DIGITS).alias("x")).agg(F.count(F.lit(1)).alias("n"))
    out.ranges = {r["lang"]: (r["q"][0], r["q"][1] - r["q"][0]) for r in bits.groupBy("lang").agg(
        F.percentile("x", F.array(F.lit(0.5), F.lit(0.95)), F.col("n")).alias("q")).collect()}
    return out


def _letters(text: str) -> bool:
    return any(map(str.isalpha, text))


class Scorer:
    """Sums of word code lengths over whole texts, remembering a bounded number of words."""

    def __init__(self, trees: Trees):
        self.trees, self.at = trees, {}
        self.rows = np.zeros((0, len(trees.langs)), np.float32)

    def _learn(self, docs: list[list[str]]) -> None:
        new = {w for d in docs for w in d} - self.at.keys()
        if len(self.at) + len(new) > WORDS_KEPT:
            self.at.clear()
            self.rows = self.rows[:0]
            new = {w for d in docs for w in d}
        new = sorted(new)
        parts = [self.rows]
        for k in range(0, len(new), 20_000):
            parts.append(self.trees.words(new[k:k + 20_000]))
        n = len(self.rows)
        self.at.update(zip(new, range(n, n + len(new)), strict=True))
        self.rows = np.concatenate(parts)

    def loglik(self, docs: list[str]) -> np.ndarray:
        """[document, language]: natural log-likelihood of each whole text."""
        out, k = np.zeros((len(docs), len(self.trees.langs))), 0
        while k < len(docs):
            e, size = k, 0
            while e < len(docs) and (e == k or size + len(docs[e]) <= SLICE_CHARS):
                size += len(docs[e])
                e += 1
            words = [d.lower().split() for d in docs[k:e]]
            self._learn(words)
            for j, w in enumerate(words):
                if w:
                    at = np.fromiter(map(self.at.__getitem__, w), np.int64, len(w))
                    out[k + j] = self.rows[at].sum(axis=0, dtype=np.float64)
            k = e
        return out


_CODED = "best string, top double, every double, size long"


def _coded(docs: DataFrame, languages: Languages, text_col: str, back: list[str]) -> DataFrame:
    """The columns ``back`` of every row with ``best`` (the language that codes the text
    shortest; null without a letter), ``top`` (its log-likelihood), ``every`` (the logarithm of
    all likelihoods' sum) and ``size`` (the bytes of its words).  One pass per group of
    languages; the text goes on to the next one only."""
    out = docs.select(*dict.fromkeys([*back, text_col]))
    first, last = languages.groups[0], languages.groups[-1]
    for trees in languages.groups:
        if trees is not first:
            out = written(out)
        keep = back if trees is last else list(dict.fromkeys([*back, text_col]))
        out = _one_group(out, docs.sparkSession.sparkContext.broadcast(trees), text_col, keep,
                         trees is first)
    return out


def _one_group(docs: DataFrame, shared, text_col: str, keep: list[str], first: bool) -> DataFrame:
    def make():
        trees = shared.value
        scorer = Scorer(trees)

        def before(b: pa.RecordBatch, name: str) -> np.ndarray:
            if first:
                return np.full(b.num_rows, -np.inf)
            return np.array([-np.inf if x is None else x for x in b.column(name).to_pylist()])

        def step(b: pa.RecordBatch):
            rows = texts(b, text_col)
            ll = scorer.loglik(rows)
            has = np.fromiter(map(_letters, rows), bool, len(rows))
            at = ll.argmax(axis=1)
            here, top = ll[np.arange(len(rows)), at], before(b, "top")
            old = [None] * len(rows) if first else b.column("best").to_pylist()
            best = [(trees.langs[k] if h > t else o) if ok else None
                    for k, h, t, o, ok in zip(at, here, top, old, has, strict=True)]
            every = np.logaddexp(before(b, "every"), np.logaddexp.reduce(ll, axis=1))
            size = [len("".join(t.lower().split()).encode()) for t in rows]
            return [*(b.column(c) for c in keep), best, np.maximum(top, here), every, size]

        return step

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return arrow_map(docs, make, f"{kinds}, {_CODED}")


def _share() -> Column:
    return F.when(F.col("best").isNotNull(), F.exp(F.col("top") - F.col("every"))).otherwise(F.lit(0.0))


def predict(docs: DataFrame, languages: Languages | None, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: the id, ``lang_pred`` and ``score``.

    A text that is null or has no letter gives ``und`` with score 0, as do all texts when
    there are no trees (nothing to learn from).  Ties go to the first language by name.
    Repeated rows repeat, null ids stay null, other columns are left aside."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    if languages is None:
        return rows.select(F.col("id").alias(id_col), F.lit("und").alias("lang_pred"),
                           F.lit(0.0).alias("score"))
    return _coded(rows, languages, "text", ["id"]).select(
        F.col("id").alias(id_col), F.coalesce("best", F.lit("und")).alias("lang_pred"),
        _share().alias("score"))


def told(docs: DataFrame, languages: Languages | None, least: float, spreads: float | None = None,
         text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose language is told: with a letter, at least
    ``least`` of the likelihoods for one language, and (with ``spreads``) not more bits a byte
    than that language's median and so many of its spreads.  A text of few bytes is given the
    bits that chance adds to it.  All rows without trees."""
    if languages is None:
        return docs
    # by place, as a column may be called like one of ours
    places = [f"_{k}" for k in range(len(docs.columns))]
    coded = _coded(docs.toDF(*places), languages, places[docs.columns.index(text_col)], places)
    kept = F.col("best").isNotNull() & (_share() >= least)
    if spreads is not None and languages.ranges:
        limit = F.create_map(*[x for k, (m, d) in languages.ranges.items()
                               for x in (F.lit(k), F.lit(m + spreads * max(d, LEAST_SPREAD)))])
        bits = -F.col("top") / F.col("size") / float(np.log(2))
        chance = CHANCE_BITS / F.sqrt(F.col("size"))
        kept = kept & F.coalesce(bits <= limit[F.col("best")] + chance, F.lit(True))
    return coded.where(kept).select(*places).toDF(*docs.columns)


def learn_rows(docs: DataFrame) -> DataFrame:
    """The rows that op10 may learn from: (id, lang, text) outside the held-out fold."""
    return (docs.where(fold(F.col("doc_id"), 4) != 2)
            .select(F.col("doc_id").alias("id"), "lang", F.col("text").cast("string")))


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    """Every document's language under trees learnt outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    return predict(docs, fit(learn_rows(docs))).select(
        "doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")
