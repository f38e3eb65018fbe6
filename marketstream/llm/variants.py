"""Spelling variants: words that differ by one code point, grouped under the frequent form.

Every word gets a terminator and stands in the table of rotations once per place where it can
be cut (``w[i:] $ w[:i]``).  Two words of one length that differ at one place have rotations
that agree in all but their last code point, the edited one; a word and the same word with
one code point more meet where the longer one's rotation, but for its last code point, is the
shorter one's whole rotation.  So each rotation is filed under itself (the word could take a
code point there) and under itself without its last code point (that one could be replaced or
dropped).  The rows are sorted by this key and scanned once: the rows of one key are each
other's neighbours.  A key holds at most one row per code point of the alphabet and one
whole rotation, however frequent the words are.

A scan gives each row of a group the number of its neighbours there and the best of them, so
it yields as many rows as it reads, and no pairs.  A neighbour by a dropped code point counts
at the first of equal code points only, so a pair meets in exactly one group.

Rotations of a long word would be quadratic, so words are cut into blocks of BLOCK places: for
an edit inside a block, the texts before and behind it must agree, and stand as digests before
the rotations of the block.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from hashlib import blake2b
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketstream.llm.common import arrow_map, table, written

END = "$"                # the terminator; no letter
BLOCK = 64               # places of a word that are rotated together
LEAST_CHARS = 7
LEAST_COUNT = 2
FORM_TIMES = 10          # a form is so many times as frequent as its variant
MISSPELT = 31            # of so many runs, one loses a code point
_RUN = re.compile("[a-zÀ-ÿ]+")
_WHOLE, _FIRST, _LATER = 0, 1, 2    # whole rotation; edited code point: first of its kind, or not


# ---------------------------------------------------------------- words
def corpus_words(docs: DataFrame) -> DataFrame:
    """(word, n): the words of all texts and how often they stand there, with at least
    LEAST_CHARS code points and LEAST_COUNT occurrences.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF with A-Z in lower case; by a
    checksum of id and run, every 31st loses one code point.  A null text has none, a null id
    counts as the empty text."""

    def make():
        def step(b: pa.RecordBatch):
            seen: Counter = Counter()
            ids, texts = b.column("id").to_pylist(), b.column("text").to_pylist()
            for i, raw in zip(ids, texts, strict=True):
                start = crc32(f"{i or ''}:".encode())
                # lower() of bytes changes A-Z only
                for run, n in Counter(_RUN.findall(raw.lower().decode())).items():
                    if len(run) < LEAST_CHARS:
                        continue
                    h = crc32(run.encode(), start)
                    if h % MISSPELT == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1:]
                        if len(run) < LEAST_CHARS:
                            continue
                    seen[run] += n
            return list(seen), list(seen.values())

        return step

    rows = docs.select(F.col("doc_id").cast("string").alias("id"),
                       F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    return (arrow_map(rows, make, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= LEAST_COUNT))


# ---------------------------------------------------------------- rotations
def _digest(text: str) -> str:
    return blake2b(text.encode(), digest_size=16).hexdigest()


def _digests(text: str, step: int, first: int = 0) -> list[str]:
    """Digests of the first 0, ``first``, ``first`` + ``step``, ... code points (``first`` 0:
    ``step``)."""
    h, out, at = blake2b(digest_size=16), [], 0
    while True:
        out.append(h.hexdigest())
        to = at + (step if at or not first else first)
        if to > len(text):
            return out
        h.update(text[at:to].encode())
        at = to


def identity(word: str) -> str:
    """The word, or a digest of a long one (which no word can equal)."""
    return word if len(word) <= BLOCK else END + _digest(word)


def _blocks(word: str, longest: int) -> Iterator[tuple[str, int, str]]:
    """(context, start, middle) of a word's blocks, as one of a pair whose longer word has
    ``longest`` code points."""
    if longest <= BLOCK:
        yield "", 0, word
        return
    # the last block takes what BLOCK leaves over, so texts behind blocks end BLOCK apart too
    over = longest % BLOCK
    before, after = _digests(word, BLOCK), _digests(word[::-1], BLOCK, over)
    for s in range(0, longest, BLOCK):
        behind = max(0, longest - s - BLOCK)
        yield (f"{longest}:{s}:{before[s // BLOCK]}:{after[-(-behind // BLOCK)]}:", s,
               word[s:len(word) - behind])


def rotations(word: str) -> Iterator[tuple[str, str, int]]:
    """(key, edited code point, kind) of all places of a word."""
    for context, s, mid in _blocks(word, len(word)):
        for j, c in enumerate(mid):
            at = s + j
            yield (context + mid[j + 1:] + END + mid[:j], c,
                   _FIRST if at == 0 or word[at - 1] != c else _LATER)
    for context, _, mid in _blocks(word, len(word) + 1):
        for j in range(len(mid) + 1):
            yield context + mid[j:] + END + mid[:j], "", _WHOLE


def _rotated():
    def step(b: pa.RecordBatch):
        keys, edited, kinds, ns, refs = [], [], [], [], []
        for word, n in zip(b.column("word").to_pylist(), b.column("n").to_pylist(), strict=True):
            ref = identity(word)
            for key, c, kind in rotations(word):
                keys.append(key)
                edited.append(c)
                kinds.append(kind)
                # a short word can be read off its key
                refs.append(ref if ":" in key else None)
            ns += [n] * (len(keys) - len(ns))
        return keys, edited, kinds, ns, refs

    return step


# ---------------------------------------------------------------- scan
def _neighbours(key: str, rows: list[tuple]) -> Iterator[tuple[str, int, int, str]]:
    """(word, neighbours, n of the best, the best) for the rows (n, code point, kind, word or
    None) of one key."""
    tail, head = key.split(END, 1) if ":" not in key else ("", "")
    # code points order the replacements of one place; only one row is whole
    group = sorted(((-n, c, kind, ref or head + c + tail) for n, c, kind, ref in rows))
    edits = [g for g in group if g[2] != _WHOLE]
    whole = [g for g in group if g[2] == _WHOLE]
    if len(edits) > 1:
        for j, g in enumerate(edits):
            best = edits[1] if j == 0 else edits[0]
            yield g[3], len(edits) - 1, -best[0], best[3]
    firsts = [g for g in edits if g[2] == _FIRST]
    for w in whole:
        if firsts:
            yield w[3], len(firsts), -firsts[0][0], firsts[0][3]
        for g in firsts:
            yield g[3], 1, -w[0], w[3]


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of equal keys in a sorted stream; a group may go over the end of a batch."""
    schema = pa.schema([("id", pa.string()), ("near", pa.int64()), ("best_n", pa.int64()),
                        ("best", pa.string())])
    key: str | None = None
    rows: list[tuple] = []
    out: list[tuple] = []
    for b in batches:
        if not b.num_rows:
            continue
        keys = b.column("key")
        same = np.zeros(len(keys) + 1, bool)
        same[1:-1] = pc.equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)
        same[0] = keys[0].as_py() == key
        same[-1] = True                      # the last row may go on in the next batch
        some = pa.Table.from_batches([b]).take(pa.array(np.flatnonzero(same[:-1] | same[1:])))
        cols = [some[c].to_pylist() for c in ("key", "n", "edited", "kind", "ref")]
        for k, *row in zip(*cols, strict=True):
            if k != key:
                if len(rows) > 1:
                    out += _neighbours(key, rows)
                key, rows = k, []
            rows.append(tuple(row))
        if len(out) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(
                zip(*out, strict=True), schema, strict=True)], schema=schema)
            out = []
    if len(rows) > 1:
        out += _neighbours(key, rows)
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(
            zip(*out, strict=True), schema, strict=True)], schema=schema)


def forms(words: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n) of distinct words with their counts (word, n): the
    number of words one code point away, and the most frequent of them (ties: the smallest)
    where it is FORM_TIMES as frequent."""
    rotated = arrow_map(words.select("word", "n"), _rotated,
                        "key string, edited string, kind int, n long, ref string")
    near = written(rotated.repartition("key").sortWithinPartitions("key")
                   .mapInArrow(_scan, "id string, near long, best_n long, best string"))

    def named():
        def step(b: pa.RecordBatch):
            return [identity(w) for w in b.column("word").to_pylist()], b.column("word")

        return step

    # long words go by a digest; their text is looked up again for ties
    long = arrow_map(words.where(F.length("word") > BLOCK), named, "id string, word string")
    short = ~F.col("best").startswith(END)
    told = near.where(short).unionByName(
        near.where(~short).join(long.select(F.col("id").alias("best"), "word"), "best")
        .select("id", "near", "best_n", F.col("word").alias("best")))
    told = told.where(~F.col("id").startswith(END)).withColumnRenamed("id", "word").unionByName(
        told.where(F.col("id").startswith(END)).join(long, "id").select("word", "near", "best_n", "best"))
    none = F.lit(None)
    every = told.withColumn("n", none.cast("long")).unionByName(words.select(
        "word", F.lit(0).cast("long").alias("near"), none.cast("long").alias("best_n"),
        none.cast("string").alias("best"), "n"))
    rows = every.groupBy("word").agg(
        F.max("n").alias("n"), F.sum("near").alias("n_near"),
        F.min(F.when(F.col("best").isNotNull(),
                     F.struct((-F.col("best_n")).alias("m"), F.col("best")))).alias("top"))
    is_form = -F.col("top.m") >= FORM_TIMES * F.col("n")
    return rows.select("word", "n", "n_near", F.when(is_form, F.col("top.best")).alias("form"),
                       F.when(is_form, -F.col("top.m")).alias("form_n"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) for (word, form): the last word when forms are followed.  Each turn
    doubles the steps taken; forms are ten times as frequent as their words, so there are
    19 words in a row at most, and five turns."""
    found = written(links.select("word", F.col("form").alias("root")))
    while True:
        on = found.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = written(found.join(on, "root", "left")
                       .select("word", F.coalesce("further", "root").alias("root"),
                               F.col("further").isNotNull().alias("moved")))
        found = step.select("word", "root")
        if step.where("moved").isEmpty():
            return found


def variant_groups(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of all words of the texts (see ``corpus_words``).

    ``form`` is the near word with the largest n (ties: smallest in code-point order), if
    that is at least 10 times the word's, else null, as ``form_n``; ``root`` is where the
    forms of forms end, the word itself if it has none.  Repeated rows count each time; null
    texts have no words; other columns are left aside; an empty table gives no rows."""
    rows = written(forms(written(corpus_words(docs.select("doc_id", "text")))))
    root = roots(rows.where(F.col("form").isNotNull()))
    return (rows.join(root, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near",
                    "form_n"))


def op12_spelling_variants(spark, sf_dir: str) -> DataFrame:
    """The words of all documents with their forms and roots."""
    return variant_groups(table(spark, sf_dir, "documents"))


SQL = """WITH RECURSIVE crc AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k:
              CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)),
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[a-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL),
bytes AS (
  SELECT run, n, flatten(list_transform(string_split(concat(doc_id, ':', run), ''), lambda ch:
         CASE WHEN unicode(ch) < 128 THEN [CAST(unicode(ch) AS BIGINT)]
              ELSE [195, CAST(unicode(ch) AS BIGINT) - 64] END)) AS b FROM runs),
sums AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, b), lambda c, x:
         xor(c >> 8, t[(xor(c, x) & 255) + 1]))) AS h FROM bytes, crc),
words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substring(run, h % length(run) + 2)
                ELSE run END AS word, n FROM sums)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
dropped AS MATERIALIZED (
  SELECT word, n, p, left(word, p) || substring(word, p + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS p FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM dropped a JOIN dropped b
  ON a.p = b.p AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT d.word, w.word, w.n FROM dropped d JOIN words w ON w.word = d.rest
  UNION SELECT w.word, d.word, d.n FROM dropped d JOIN words w ON w.word = d.rest),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS top,
         max(other_n) AS top_n FROM near GROUP BY word),
forms AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN top_n >= 10 * w.n THEN top END AS form,
         CASE WHEN top_n >= 10 * w.n THEN top_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word),
chain AS (
  SELECT word, word AS at, form AS next FROM forms
  UNION ALL
  SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.next)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain c ON c.word = f.word AND c.next IS NULL"""
