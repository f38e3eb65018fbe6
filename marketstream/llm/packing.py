"""Best-fit packing of token pieces into sequences, certified by lower bounds.

1. ``tokenised``: every text's ids and the end id; texts over the capacity are cut from
   the back into full pieces, so that only the first piece can be shorter.
2. ``pack``: the pieces are dealt by hash to partitions of bounded size.  Each partition
   is packed by best-fit decreasing, and dual feasible functions over its histogram of
   lengths give a lower bound of the sequences that any packing of it needs.  A partition
   whose count equals its bound is certified and never touched again.
3. Partitions with a gap give up their emptiest sequences; the documents in these are
   dealt anew, mixed across partitions, and packed again; a round is kept if it needs
   fewer sequences.  Rounds end when no gap is left, or nothing was gained.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketstream.llm.common import arrow_map, table, texts
from marketstream.session import cut

CAPACITY = 2048
PER_PARTITION = 40_000     # pieces that one packing task holds, about
ROUNDS = 3                 # exchanges at most
RELEASED = 256             # sequences that a partition gives up for each one over its bound
# White space that tiktoken is not given in one run: its pattern fails on about a million
# characters.  Shorter runs than 64 are left out of the search for it.
LONG_RUN = 100_000
_RUNS = re.compile(r"\s{64,}")


# ---------------------------------------------------------------- one partition
def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Sequences that ``sizes`` need at least, by dual feasible functions.

    For a threshold k, lengths over capacity - k count as whole sequences, lengths below k
    as nothing and the others as their share; k = 0 is the plain volume.  A second family
    counts floor(x * j / capacity) of the j + 1 shares that fit nowhere together."""
    if not len(sizes):
        return 0
    count = np.bincount(sizes, minlength=capacity + 1)
    x = np.arange(capacity + 1)
    upto, volume = np.cumsum(count), np.cumsum(count * x)
    k = np.arange(capacity // 2 + 1)
    big = upto[capacity] - upto[capacity - k]
    middle = volume[capacity - k] - np.where(k > 0, volume[np.maximum(k - 1, 0)], 0)
    best = int((big + -(-middle // capacity)).max())
    for j in range(1, 65):
        # u_j(x) = x/C where x(j+1)/C is whole, else floor(x(j+1)/C)/j; in units of 1/(jC)
        whole = x * (j + 1) % capacity == 0
        share = np.where(whole, x * j, x * (j + 1) // capacity * capacity)
        best = max(best, int(-(-(count * share).sum() // (j * capacity))))
    return best


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: (sequence, offset) of every length and the room left in each
    sequence.  Sequences with equal room lie on one stack; a bit mask over the rooms finds
    the tightest that fits, so a piece costs constant time."""
    order = np.argsort(-sizes, kind="stable")
    seq = np.empty(len(sizes), np.int64)
    off = np.empty(len(sizes), np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, room = 0, []
    for i, n in zip(order.tolist(), sizes[order].tolist(), strict=True):
        fits = mask >> n
        if fits:
            r = n + (fits & -fits).bit_length() - 1
            s = stacks[r].pop()
            if not stacks[r]:
                mask ^= 1 << r
        else:
            r, s = capacity, len(room)
            room.append(capacity)
        seq[i], off[i] = s, capacity - r
        r -= n
        room[s] = r
        if r:
            if not stacks[r]:
                mask |= 1 << r
            stacks[r].append(s)
    return seq, off, np.asarray(room, np.int64)


def _pack_partition(capacity: int):
    import pandas as pd

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("uid", ignore_index=True)     # the same packing on a retry
        sizes = pdf["length"].to_numpy(np.int64)
        seq, off, room = best_fit(sizes, capacity)
        gap = len(room) - lower_bound(sizes, capacity)
        give = np.zeros(len(room), bool)
        if gap > 0:
            worst = np.argsort(-room, kind="stable")[:RELEASED * gap]
            give[worst[room[worst] > 0]] = True
        return pd.DataFrame({"uid": pdf["uid"], "length": pdf["length"], "part": pdf["part"],
                             "seq": seq, "offset": off, "open": give[seq],
                             "gap": np.full(len(pdf), gap)})

    return run


_PACKED = "uid long, length long, part long, seq long, offset long, open boolean, gap long"


def _packed(pieces: DataFrame, parts: int, salt: int, capacity: int) -> DataFrame:
    dealt = pieces.select("uid", "length", F.pmod(F.xxhash64("uid", F.lit(salt)), F.lit(parts))
                          .alias("part"))
    return cut(dealt.groupBy("part").applyInPandas(_pack_partition(capacity), _PACKED))


def _sequences(df: DataFrame) -> int:
    return df.groupBy("part", "seq").agg(F.lit(1)).count()


def pack(pieces: DataFrame, capacity: int = CAPACITY,
         per_partition: int = PER_PARTITION) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to ``pieces`` (column ``length`` of 1 to
    ``capacity``; other columns stay).

    Offsets are gapless from 0 in each sequence.  Repeated rows are packed one by one, an
    empty table gives an empty one, and a length that is null or out of range raises.
    ``pieces`` is numbered and written once, so every later step reads the same numbers
    also after an executor was lost; a task holds about ``per_partition`` lengths, however
    often a document id occurs."""
    bad = F.col("length").isNull() | ~F.col("length").between(1, capacity)
    named = pieces.withColumn("length", F.when(bad, F.raise_error(F.lit("length out of range")))
                              .otherwise(F.col("length")).cast("long"))
    named = cut(named.drop("uid", "sequence_id", "offset"))
    named = named.withColumn("uid", F.monotonically_increasing_id())
    n = named.count()
    left, done, salt = named.select("uid", "length"), None, 0
    parts = max(1, -(-n // per_partition))
    now = _packed(left, parts, salt, capacity)
    rounds = [now]
    while salt < ROUNDS and parts > 1:
        opened = now.where("open")
        m = opened.count()
        if not m:
            break
        salt, before = salt + 1, _sequences(opened)
        parts = max(1, -(-m // per_partition))
        again = _packed(opened.select("uid", "length"), parts, salt, capacity)
        if _sequences(again) >= before:
            break
        rounds[-1] = now.where("NOT open")
        rounds.append(again)
        now = again
    for k, r in enumerate(rounds):
        r = r.select("uid", (F.lit(k) * F.lit(1 << 58) + F.col("part") * F.lit(1 << 32)
                             + F.col("seq")).alias("sequence_id"), "offset")
        done = r if done is None else done.unionByName(r)
    return named.join(done, "uid").drop("uid")


# ---------------------------------------------------------------- tokens
def _runs_long(text: str) -> bool:
    return len(text) >= LONG_RUN and any(
        m.end() - m.start() >= LONG_RUN for m in _RUNS.finditer(text))


def encoder(ranks_file: str, json_file: str, pattern: str):
    """A function from a text to its ids, those of the tokenizers library's ``json_file``.

    They are computed by tiktoken over ``ranks_file``, the ranks of the same vocabulary, with
    the JSON's added tokens, in a quarter of the time; texts with a white-space run that
    tiktoken can not split go to the library itself."""
    import base64
    import json

    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks_file, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    with open(json_file, encoding="utf-8") as f:
        added = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
    fast = tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)
    library = None

    def encode(text: str) -> list[int]:
        nonlocal library
        if not _runs_long(text):
            return fast.encode(text, allowed_special="all")
        library = library or Tokenizer.from_file(json_file)
        return library.encode(text, add_special_tokens=False).ids

    return encode


def tokenised(df: DataFrame, ranks_file: str, pattern: str, end_id: int = 0,
              capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
              keep_ids: bool = False, json_file: str | None = None) -> DataFrame:
    """The pieces of every text: id, ``piece`` from 0, ``start``, ``length``,
    ``ids_crc32`` and, with ``keep_ids``, ``ids`` (array<int>).

    ``ranks_file`` holds a byte-level BPE vocabulary as ranks, ``json_file`` (by default
    beside it) the same vocabulary for the tokenizers library, whose ids these are (see
    ``encoder``).  A null or empty text has the end id alone.
    Null ids stay null, repeated rows repeat, other columns are left aside."""
    json_file = json_file or ranks_file.removesuffix(".tiktoken") + ".json"

    def make():
        encode = encoder(ranks_file, json_file, pattern)

        def step(b: pa.RecordBatch):
            ids_of, rows = b.column("id").to_pylist(), []
            for i, t in zip(ids_of, texts(b, "text"), strict=True):
                ids = encode(t)
                ids.append(end_id)
                raw = np.asarray(ids, "<u4")
                first = (len(ids) - 1) % capacity + 1
                a, e, k = 0, first, 0
                while a < len(ids):
                    rows.append((i, k, a, e - a, zlib.crc32(raw[a:e].tobytes()), ids[a:e]
                                 if keep_ids else None))
                    a, e, k = e, e + capacity, k + 1
            cols = list(zip(*rows, strict=True))
            return cols if keep_ids else cols[:5]

        return step

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = arrow_map(rows, make, f"id {rows.schema['id'].dataType.simpleString()}, piece int, "
                    "start long, length long, ids_crc32 long"
                    + (", ids array<int>" if keep_ids else ""))
    return out.withColumnRenamed("id", id_col)


def packed_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of ``docs`` (doc_id, text) under the public 50k byte-level vocabulary,
    with their places in the packed sequences."""
    import public_tokenizers

    pieces = tokenised(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"),
                       public_tokenizers.PATTERN, capacity=capacity)
    return pack(pieces, capacity)


def op5_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
