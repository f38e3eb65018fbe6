"""Filter interaction audit over a sparse document-term matrix.

The matrix is built in three steps.  One pass over the texts cuts the documents into shards of
a bounded size; each shard numbers its own words and keeps compressed sparse rows (row ends,
column numbers, counts) beside its word list.  The word lists of all shards, sorted by word,
give one dictionary with gapless numbers; each partition sends a shard the numbers of the
shard's words in packed form, and these take the place of the shard's own.  Then the rows of
the matrix answer the length filter (row sum) and the repetition filter (number of columns);
the remaining flags come from marks of the text and from the smallest id of every text, and
what is left is a count per part and set of flags.

Documents meet in small groups only: counts are aggregated per (text, part, id) before any
text or id is looked up, so a text or an id with a third of all rows is no large group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from hashlib import sha256
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketstream.llm.common import arrow_map, table, written
from marketstream.session import cut

SHARD_BYTES = 1 << 22      # bytes of text in a shard; a longer text is one of its own
PIECE_ROWS = 1 << 19       # words of all shards that are numbered together
FILTERS = "ABCDE"
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Columns that a pass over the texts can add: their schema, and texts -> columns.
Marks = tuple[str, Callable[[pa.StringArray], list[pa.Array]]]


# ---------------------------------------------------------------- cells
def packed(ends: np.ndarray, cols: np.ndarray, counts: np.ndarray) -> bytes:
    """The cells of a shard as little-endian integers: two lengths and the bytes of a column
    number, 8 bytes each, then row ends (8 bytes), column numbers (4 or 8) and counts (4)."""
    width = 4 if not len(cols) or cols.max() < 1 << 31 else 8
    head = np.concatenate([[len(ends), len(cols), width], ends]).astype("<i8")
    return head.tobytes() + cols.astype(f"<i{width}").tobytes() + counts.astype("<i4").tobytes()


def unpacked(cells: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row ends, column numbers, counts) of a shard."""
    n, m, width = np.frombuffer(cells, "<i8", 3).tolist()
    at = 24 + 8 * n
    return (np.frombuffer(cells, "<i8", n, 24), np.frombuffer(cells, f"<i{width}", m, at),
            np.frombuffer(cells, "<i4", m, at + width * m))


def _pairs(codes: np.ndarray, ids: np.ndarray) -> bytes:
    """The number of a piece's first word, then a shard's own word numbers and the steps from
    each of the dictionary's to the next, which ascend."""
    return ids[:1].astype("<i8").tobytes() + np.concatenate(
        [codes, np.diff(ids, prepend=ids[0])]).astype("<i4").tobytes()


def _of_pairs(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = (len(data) - 8) // 8
    steps = np.frombuffer(data, "<i4", n, 8 + 4 * n)
    return np.frombuffer(data, "<i4", n, 8), np.cumsum(steps, dtype=np.int64) + \
        np.frombuffer(data, "<i8", 1)


# ---------------------------------------------------------------- the matrix
def _joined(words: pa.StringArray) -> bytes | None:
    """Words with a space between them; null for none."""
    if not len(words):
        return None
    one = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)
    return pc.binary_join(one, " ").cast(pa.binary())[0].as_py()


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def _pieces(text: pa.StringArray) -> Iterator[tuple[int, int]]:
    """Row ranges of at most SHARD_BYTES (or one row)."""
    start = size = 0
    for j, n in enumerate(pc.binary_length(text).to_pylist()):
        if size and size + n > SHARD_BYTES:
            yield start, j
            start, size = j, 0
        size += n
    if len(text) > start:
        yield start, len(text)


def _counted(text: pa.StringArray) -> tuple[bytes | None, bytes]:
    """(the words with a space between them, cells) of some texts."""
    words = pc.ascii_split_whitespace(text)        # at space and \t to \r
    row = np.repeat(np.arange(len(text), dtype=np.int64), pc.list_value_length(words).to_numpy())
    flat = words.flatten()
    some = pc.not_equal(flat, "")                  # white space at the ends of a text
    codes = flat.filter(some).dictionary_encode()
    key = row[some.to_numpy(zero_copy_only=False)] << 32 | codes.indices.to_numpy().astype(np.int64)
    cells, counts = np.unique(key, return_counts=True)
    ends = np.searchsorted(cells >> 32, np.arange(len(text)), side="right")
    return _joined(codes.dictionary), packed(ends, cells & 0xFFFFFFFF, counts)


def _shards(docs: DataFrame, text_col: str, kept: list[str], marks: Marks | None) -> DataFrame:
    """One row per shard: its number, ``rows`` (the kept columns and the marks of its
    documents), ``words`` (its own words with a space between them) and ``cells``."""
    fields = ", ".join([f"`{c}`: {docs.schema[c].dataType.simpleString()}" for c in kept]
                       + ([marks[0]] if marks else []))
    schema = f"shard long, rows array<struct<{fields}>>, words binary, cells binary"
    out = _arrow(schema)
    kind = out.field("rows").type.value_type

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33      # told apart between tasks
        for b in batches:
            texts = b.column("text")
            for start, end in _pieces(texts):
                text = texts.slice(start, end - start)
                columns = [b.column(c).slice(start, end - start) for c in kept]
                columns += marks[1](text) if marks else []
                rows = pa.StructArray.from_arrays(
                    [c.cast(f.type) for c, f in zip(columns, kind, strict=True)], fields=list(kind))
                words, cells = _counted(text)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()),
                     pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)
                     .cast(out.field("rows").type),
                     pa.array([words], pa.binary()), pa.array([cells], pa.binary())], schema=out)
                number += 1

    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    return docs.select(*kept, text).mapInArrow(run, schema)


def _numbered(uses: DataFrame) -> DataFrame:
    """Two kinds of rows from (shard, code, word), each with its partition ``part``: pieces of
    the dictionary (``first``: the partition's words before, ``n``, ``words``), and for each
    shard the numbers of its words in the partition (``shard``, ``pairs``)."""
    schema = "part int, first long, n long, words binary, shard long, pairs binary"
    out = _arrow(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, seen = None, 0
        held: list[pa.RecordBatch] = []

        def piece() -> pa.RecordBatch:
            nonlocal last, seen
            t = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            word = t["word"].chunk(0)
            new = np.ones(len(word), bool)
            new[1:] = pc.not_equal(word[1:], word[:-1]).to_numpy(zero_copy_only=False)
            new[0] = word[0].as_py() != last
            ids = seen - 1 + np.cumsum(new)
            fresh = word.filter(pa.array(new))
            rows = [(part, seen, len(fresh), _joined(fresh), None, None)] if len(fresh) else []
            shard, code = t["shard"].to_numpy(), t["code"].to_numpy()
            order = np.argsort(shard, kind="stable")
            cuts = np.flatnonzero(np.diff(shard[order])) + 1
            for at in np.split(order, cuts):
                rows.append((part, None, None, None, int(shard[at[0]]), _pairs(code[at], ids[at])))
            last, seen = word[-1].as_py(), seen + len(fresh)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), out, strict=True)],
                schema=out)

        for b in batches:
            if b.num_rows:
                held.append(b)
            if sum(h.num_rows for h in held) >= PIECE_ROWS:
                yield piece()
        if held:
            yield piece()

    return uses.repartition("word").sortWithinPartitions("word").mapInArrow(run, schema)


def document_term_matrix(docs: DataFrame, text_col: str, kept: list[str],
                         marks: Marks | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(matrix, documents, dictionary) of all texts.

    ``matrix`` has a row per shard: its number and ``cells``, packed row ends, word ids
    (ascending within a document) and counts.  ``documents`` is (shard, ``rows``): the ``kept``
    columns of the shard's documents in the order of its rows, and what ``marks`` makes of
    their texts.  ``dictionary`` is (word, word_id), gapless from 0.  Words are maximal runs without white space (space and \\t to \\r); a null text
    has none.  Every row of ``docs`` is a row of the matrix; an empty table gives empty ones.
    No kept column may be called ``text``.

    The driver sees one size per partition; a task holds one shard, or PIECE_ROWS words."""
    shards = written(_shards(docs, text_col, kept, marks))
    uses = shards.select("shard", F.posexplode(F.split(F.col("words").cast("string"), " "))
                         .alias("code", "word"))
    numbers = written(_numbered(uses))
    sizes = {r["part"]: r["n"] for r in numbers.where(F.col("n").isNotNull()).groupBy("part")
             .agg(F.sum("n").alias("n")).collect()}
    starts = [0]
    for p in range(max(sizes, default=0)):
        starts.append(starts[-1] + sizes.get(p, 0))
    offset = F.get(F.lit(starts).cast("array<long>"), F.col("part"))
    dictionary = (numbers.where(F.col("n").isNotNull())
                  .select((offset + F.col("first")).alias("first"),
                          F.posexplode(F.split(F.col("words").cast("string"), " ")).alias("at", "word"))
                  .select("word", (F.col("first") + F.col("at")).alias("word_id")))

    none = F.lit(None)
    dealt = (numbers.where(F.col("shard").isNotNull()).select("shard", "part", F.col("pairs").alias("data"))
             .union(shards.select("shard", none.cast("int"), "cells"))
             .repartition("shard").sortWithinPartitions("shard", F.col("part").asc_nulls_last()))
    schema = "shard long, cells binary"
    out = _arrow(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to: list[tuple[np.ndarray, np.ndarray]] = []
        for b in batches:
            for j, (shard, part) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(),
                                                  strict=True)):
                data = b.column(2)[j].as_py()
                if part is not None:            # a shard's numbers come before its cells
                    codes, ids = _of_pairs(data)
                    to.append((codes, ids + starts[part]))
                    continue
                end, col, count = unpacked(data)
                number = np.zeros(sum(len(c) for c, _ in to), np.int64)
                for codes, ids in to:
                    number[codes] = ids
                to = []
                row = np.repeat(np.arange(len(end)), np.diff(end, prepend=0))
                order = np.lexsort((number[col], row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard], pa.int64()),
                     pa.array([packed(end, number[col][order], count[order])], pa.binary())], schema=out)

    return dealt.mapInArrow(run, schema), shards.select("shard", "rows"), dictionary


def word_counts(matrix: DataFrame, documents: DataFrame) -> DataFrame:
    """The columns of every document with ``n_words`` (its row sum) and ``n_distinct`` (its
    number of columns)."""

    def make():
        def step(b: pa.RecordBatch):
            sums, sizes = [], []
            for j in range(b.num_rows):
                end, col, count = unpacked(b.column("cells")[j].as_py())
                start = np.concatenate([[0], end[:-1]])
                total = np.concatenate([[0], np.cumsum(count, dtype=np.int64)])
                # columns ascend within a row: one that equals the one before is no new word
                new = np.ones(len(col), np.int64)
                new[1:] = col[1:] != col[:-1]
                new[start[start < len(col)]] = 1
                seen = np.concatenate([[0], np.cumsum(new)])
                sums.append(total[end] - total[start])
                sizes.append(seen[end] - seen[start])
            return b.column("shard"), pa.array(sums), pa.array(sizes)

        return step

    counts = arrow_map(matrix, make, "shard long, n_words array<long>, n_distinct array<long>")
    return (documents.join(counts, "shard")
            .select(F.explode(F.arrays_zip("rows", "n_words", "n_distinct")).alias("d"))
            .select("d.rows.*", "d.n_words", "d.n_distinct"))


# ---------------------------------------------------------------- flags and counts
def _flags(text: pa.StringArray) -> list[pa.Array]:
    """A digest of each text, whether more than 2 % of it are capitals, and whether it holds
    one of ``#$%&*|``."""
    raw = [t.encode() for t in text.to_pylist()]
    capitals = [len(r) - len(r.translate(None, _UPPER)) for r in raw]
    many = [100 * c > 2 * n for c, n in zip(capitals, pc.utf8_length(text).to_pylist(), strict=True)]
    return [pa.array([sha256(r).digest() for r in raw], pa.binary()), pa.array(many),
            pc.match_substring_regex(text, "[#$%&*|]")]


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents per part and set of failed filters; bit j of
    ``mask`` is the j-th filter of FILTERS, ``good`` and ``toxic`` count labelled ones."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       F.col("text").alias("body"))
    matrix, documents, _ = document_term_matrix(
        rows, "body", ["doc_id", "part"], ("digest: binary, c: boolean, d: boolean", _flags))
    counted = word_counts(matrix, documents)
    flags = [F.col("n_words") < 200, 100 * F.col("n_distinct") < 50 * F.col("n_words"),
             F.col("c"), F.col("d")]
    mask = sum((f.cast("int") * (1 << j) for j, f in enumerate(flags)), F.lit(0))

    # copies with one id and part become one row before anything is looked up by id; written,
    # as two branches read it
    same = cut(counted.select("doc_id", "part", "digest", mask.alias("mask"))
               .groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n")))
    told = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic")
            .where(F.col("doc_id").isNotNull()).groupBy("doc_id")
            .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"),
                 F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    known = same.join(told, "doc_id", "left").select(
        "doc_id", "part", "digest", "mask", "n",
        *[(F.coalesce(c, F.lit(0)) * F.col("n")).alias(c) for c in ("good", "toxic")])
    # per text and part: all rows, and those of the smallest id; rows without an id are
    # copies of nothing
    counts = F.struct("n", "good", "toxic")
    sums = [F.sum(c).alias(c) for c in ("n", "good", "toxic")]
    per_id = known.groupBy("digest", "part", "mask", "doc_id").agg(*sums)
    per_part = (per_id.where(F.col("doc_id").isNotNull()).groupBy("digest", "part", "mask")
                .agg(F.min("doc_id").alias("least"), F.min_by(counts, "doc_id").alias("first"), *sums)
                .withColumn("smallest", F.min("least").over(Window.partitionBy("digest"))))
    own = F.col("least") == F.col("smallest")
    none = F.struct(*[F.lit(0).cast("long").alias(c) for c in ("n", "good", "toxic")])
    first = F.when(own, F.col("first")).otherwise(none)
    copy = F.struct(*[(F.col(c) - first[c]).alias(c) for c in ("n", "good", "toxic")])
    split = per_part.select("part", F.inline(F.array(
        F.struct(F.col("mask"), first.alias("s")),
        F.struct((F.col("mask") + 16).alias("mask"), copy.alias("s")))))
    unnamed = per_id.where(F.col("doc_id").isNull()).select("part", "mask", counts.alias("s"))
    return (split.select("part", "mask", "s.*").unionByName(unnamed.select("part", "mask", "s.*"))
            .groupBy("part", "mask").agg(*sums))


def _total(cells: Column, where, what: str) -> Column:
    return F.aggregate(F.filter(cells, where), F.lit(0).cast("long"), lambda s, x: s + x[what])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What each filter removes, in all 120 orders of the five filters: per part (the source;
    null: empty string), ``filter_order`` and ``step`` the document counts ``kept``,
    ``removed``, ``redundant``, ``unique_fails``, ``good_lost``, ``toxic_lost`` and
    ``shapley``.

    Null texts are empty, and so identical to other empty ones.  A row without an id is a
    copy of nothing, no row is a copy of it, and it has no label; equal rows with equal ids
    are not copies of each other.  A document is good or toxic if any of its labels says so;
    null labels say nothing.  Columns beyond doc_id, source and text are left aside; an empty
    table gives no rows."""
    cells = (failures(docs, labels).groupBy("part")
             # 32 sets of flags at most
             .agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")))
    steps = []
    for order in permutations(FILTERS):
        before = 0
        for j, f in enumerate(order):
            bit = 1 << FILTERS.index(f)
            steps.append(("".join(order), j + 1, bit, before))
            before |= bit
    # a fixed list of 600 steps, for every part
    fixed = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"),
                               F.lit(b).alias("bit"), F.lit(e).alias("before"))
                      for o, s, b, e in steps])
    rows = cells.select("part", "cells", F.inline(fixed))
    bit, before = F.col("bit"), F.col("before")

    def has(x, bits):
        return x["mask"].bitwiseAND(bits) != 0

    def here(x):
        return has(x, bit) & ~has(x, before)

    c = F.col("cells")
    rows = rows.select(
        "part", "filter_order", "step", "bit",
        _total(c, lambda x: ~has(x, before.bitwiseOR(bit)), "n").alias("kept"),
        _total(c, here, "n").alias("removed"),
        _total(c, lambda x: has(x, bit) & has(x, before), "n").alias("redundant"),
        _total(c, lambda x: x["mask"] == bit, "n").alias("unique_fails"),
        _total(c, here, "good").alias("good_lost"),
        _total(c, here, "toxic").alias("toxic_lost"))
    return (rows.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "bit")))
            .drop("bit"))


def op13_filter_audit(spark, sf_dir: str) -> DataFrame:
    """The audit of all documents, by source."""
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SQL = r"""WITH f AS MATERIALIZED (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
labelled AS (
  SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic
  FROM labels GROUP BY doc_id),
least AS (SELECT text, min(doc_id) AS least FROM f GROUP BY text),
flags AS (
  SELECT f.part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
         len(words) < 200 AS a, 100 * len(list_distinct(words)) < 50 * len(words) AS b,
         100 * len(regexp_replace(f.text, '[^A-Z]', '', 'g')) > 2 * len(f.text) AS c,
         regexp_matches(f.text, '[#$%&*|]') AS d,
         coalesce(f.doc_id > m.least, false) AS e
  FROM f JOIN least m ON m.text = f.text LEFT JOIN labelled l ON l.doc_id = f.doc_id),
masks AS (
  SELECT part, CAST(a AS INT) + 2 * CAST(b AS INT) + 4 * CAST(c AS INT) + 8 * CAST(d AS INT)
               + 16 * CAST(e AS INT) AS mask,
         count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
  FROM flags GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS o, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
  SELECT o, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0) AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
counted AS (
  SELECT part, o AS filter_order, step, bit,
         CAST(sum(CASE WHEN mask & (before + bit) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
         CAST(sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN n ELSE 0 END) AS BIGINT)
           AS removed,
         CAST(sum(CASE WHEN mask & bit > 0 AND mask & before > 0 THEN n ELSE 0 END) AS BIGINT)
           AS redundant,
         CAST(sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
         CAST(sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN good ELSE 0 END) AS BIGINT)
           AS good_lost,
         CAST(sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS BIGINT)
           AS toxic_lost
  FROM masks, steps GROUP BY part, o, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted"""
