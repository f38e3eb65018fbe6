"""Near duplicates by an exact Jaccard join on word n-grams, vertically partitioned.

Two texts link when ``PER_CENT`` per cent of their joint n-grams are common.  The global
order of n-grams is cut into fragments; what two texts share is counted per fragment and
summed per pair.

1. Texts with equal sets form one class; only classes are compared.
2. In each fragment, n-grams that only one class holds are found.  Their partial counts,
   summed per class, leave only classes that can reach the threshold with anyone.
3. The shared n-grams of the rest are ordered, rarest first; two classes can link only if
   they share one of the first few (prefix filter).  Those are the candidates' tokens.
4. Candidates are compared with the fullest class of their token first (a star, linear in
   the group); classes that are already connected need no comparison, so a large group of
   near copies never becomes all its pairs.  What no star has settled is compared pair by
   pair, under the positional filter, so no link between two components is lost.
5. A comparison counts common n-grams per fragment (segments of the two sets) and sums.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketstream.llm.common import arrow_map, table, texts, written
from marketstream.session import cut

WORDS = 5                      # words in an n-gram
PER_CENT = 80                  # similarity from which two texts link
FRAGMENT_ENTRIES = 2_000_000   # n-grams that one fragment holds, about
LEAST_FRAGMENTS = 32
SEGMENTS = 8                   # fragments that a comparison is summed over
SLICE_BYTES = 6_000_000        # text hashed in one go inside a task
BROADCAST_CLASSES = 300_000    # classes whose ids are broadcast to fetch their texts
STARS = 2                      # rounds of stars at most before pairs are compared
FEW = 4                        # pairs per token row that are compared without another star

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


# ---------------------------------------------------------------- n-grams
def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """The sorted set of 64-bit hashes of a text's word n-grams; with fewer words the whole
    sequence is one; none without words.  A-Z are lowered, words part at white space."""
    import xxhash

    parts = text.encode().lower().split()      # of bytes: ASCII letters and spaces alone
    if not parts:
        return np.empty(0, np.uint64)
    h = xxhash.xxh3_64_intdigest
    w = np.fromiter(map(h, parts), np.uint64, len(parts))
    n = min(words, len(w))
    with np.errstate(over="ignore"):
        acc = np.full(len(w) - n + 1, n, np.uint64)
        for k in range(n):
            acc = _mix(acc + _STEP + w[k:len(w) - n + 1 + k])
    return np.unique(acc)


def _print(u: np.ndarray) -> tuple[int, int]:
    import xxhash

    d = np.frombuffer(xxhash.xxh3_128_digest(u.tobytes()), np.int64)
    return int(d[0]), int(d[1])


def _sets(rows: DataFrame) -> DataFrame:
    """(id, mark, n, fp1, fp2) of every row (id, mark, text): size and fingerprint of its set."""

    def make():
        def step(b: pa.RecordBatch):
            got = [shingles(t) for t in texts(b, "text")]
            prints = [_print(u) for u in got]
            return (b.column("id"), b.column("mark"), [len(u) for u in got],
                    [p[0] for p in prints], [p[1] for p in prints])

        return step

    return arrow_map(rows, make, "id long, mark binary, n long, fp1 long, fp2 long")


# ---------------------------------------------------------------- shared n-grams
def _slices(rows: list[str]):
    k = 0
    while k < len(rows):
        e, size = k, 0
        while e < len(rows) and (e == k or size + len(rows[e]) <= SLICE_BYTES):
            size += len(rows[e])
            e += 1
        yield rows[k:e]
        k = e


_BLOB = "fragment int, part long, owners binary, counts binary, grams binary, known binary"


def _fragmented(rows: DataFrame, fragments: int) -> DataFrame:
    """Per slice of texts and fragment, one row: the owners (fingerprints), how many n-grams
    each has here, these n-grams, and ``known``: n-grams that two owners of this slice
    share, sent once however many have them; their counts go out as fragments beyond the
    last, so that a very common n-gram costs a slice one entry."""

    def make():
        task = TaskContext.get()
        serial = [(task.partitionId() if task else 0) << 24]

        def step(b: pa.RecordBatch):
            out = []
            for part in _slices(texts(b, "text")):
                sets = {}
                for t in part:
                    u = shingles(t)
                    if len(u):
                        sets.setdefault(_print(u)[0], u)
                if not sets:
                    continue
                serial[0] += 1
                owners = np.fromiter(sets, np.int64, len(sets))
                grams = np.concatenate(list(sets.values()))
                who = np.repeat(np.arange(len(owners)), [len(u) for u in sets.values()])
                order = np.argsort(grams, kind="stable")
                run = grams[order]
                twin = np.zeros(len(run), bool)
                same = run[1:] == run[:-1]
                twin[1:] |= same
                twin[:-1] |= same
                first = twin.copy()
                first[1:] &= ~same
                shared = np.zeros(len(run), bool)
                shared[order] = twin
                local = np.bincount(who[shared], minlength=len(owners))
                out.append((fragments + serial[0] % fragments, serial[0], owners.tobytes(),
                            local.astype(np.int64).tobytes(), b"", b""))
                known = run[first]
                own, who = grams[~shared], who[~shared]
                at = ((own >> np.uint64(32)) % np.uint64(fragments)).astype(np.int64)
                order = np.argsort(at, kind="stable")
                ends = np.searchsorted(at[order], np.arange(fragments + 1))
                kat = ((known >> np.uint64(32)) % np.uint64(fragments)).astype(np.int64)
                for f in range(fragments):
                    mine = order[ends[f]:ends[f + 1]]
                    k = known[kat == f].astype(np.uint32)
                    if len(mine) or len(k):
                        has = np.bincount(who[mine], minlength=len(owners))
                        keep = has > 0
                        out.append((f, serial[0], owners[keep].tobytes(),
                                    has[keep].astype(np.int64).tobytes(),
                                    own[mine].astype(np.uint32).tobytes(), k.tobytes()))
            return list(zip(*out, strict=True)) if out else None

        return step

    return arrow_map(rows, make, _BLOB)


def _count_shared(group: pa.Table) -> pa.Table:
    """Of one fragment: per owner and slice, how many of its n-grams another class has too."""
    def cat(name, dtype):
        return np.frombuffer(b"".join(group[name].to_pylist()), dtype)

    part = np.repeat(group["part"].to_numpy(), [len(x) >> 3 for x in group["owners"].to_pylist()])
    owners, counts = cat("owners", np.int64), cat("counts", np.int64)
    grams, known = cat("grams", np.uint32), cat("known", np.uint32)
    if len(grams):
        who = np.repeat(np.arange(len(owners), dtype=np.int32), counts)
        order = np.argsort(grams, kind="stable")
        run, who = grams[order], who[order]
        starts = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
        of = owners[who]
        several = np.minimum.reduceat(of, starts) != np.maximum.reduceat(of, starts)
        # a sorted list of few entries: what two owners of one slice share
        several |= np.isin(run[starts], known)
        hit = np.repeat(several, np.diff(np.append(starts, len(run))))
        counts = np.bincount(who[hit], minlength=len(owners))
    return pa.table({"fp1": pa.array(owners, pa.int64()), "part": pa.array(part, pa.int64()),
                     "s": pa.array(counts.astype(np.int64), pa.int64())})


def _hopeful(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """The classes that share enough n-grams with others to link with anyone."""
    total = classes.agg(F.sum("n")).first()[0] or 0
    fragments = max(LEAST_FRAGMENTS, -(-int(total) // FRAGMENT_ENTRIES))
    per = (_fragmented(rows, fragments).groupBy("fragment")
           .applyInArrow(_count_shared, "fp1 long, part long, s long")
           .groupBy("fp1", "part").agg(F.sum("s").alias("s"))
           .groupBy("fp1").agg(F.max("s").alias("s")))
    return classes.join(per, "fp1").where(100 * F.col("s") >= PER_CENT * F.col("n")).drop("s")


# ---------------------------------------------------------------- candidates
def _ordered(rows: DataFrame, hopeful: DataFrame) -> DataFrame:
    """Per hopeful class with enough shared n-grams left: cid, n, s (shared n-grams) and
    ``grams``, these in the global order, rarest first."""
    wanted = hopeful.select(F.col("rep").alias("id"), "fp1", "fp2", "cid", "n")
    if hopeful.count() <= BROADCAST_CLASSES:
        wanted = F.broadcast(wanted)
    fetched = rows.join(wanted, "id").select("cid", "n", "fp1", "fp2", "text")

    def make():
        def step(b: pa.RecordBatch):
            out = []
            for cid, n, a, c, t in zip(*[b.column(k).to_pylist() for k in ("cid", "n", "fp1",
                                                                           "fp2")],
                                       texts(b, "text"), strict=True):
                u = shingles(t)
                if _print(u) == (a, c):      # an id may have several texts
                    out.append((cid, n, u.view(np.int64)))
            return list(zip(*out, strict=True)) if out else None

        return step

    sets = written(arrow_map(fetched, make, "cid long, n long, grams array<long>")
               .dropDuplicates(["cid"]))
    pairs = sets.select("cid", "n", F.explode("grams").alias("gram"))
    df = pairs.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    return written(pairs.join(df, "gram").groupBy("cid", "n")
               .agg(F.sort_array(F.collect_list(F.struct("df", "gram"))).alias("g"))
               .select("cid", "n", F.size("g").cast("long").alias("s"),
                       F.col("g")["gram"].alias("grams"))
               .where(100 * F.col("s") >= PER_CENT * F.col("n")))


def _tokens(ordered: DataFrame) -> DataFrame:
    """Candidate tokens: each class's first shared n-grams, as many as the prefix filter
    asks for after those that it has alone; ``at`` is the place, from 0."""
    least = F.ceil(F.col("n") * PER_CENT / 100)
    return (ordered.select("cid", "n", "s", F.posexplode(
        F.slice("grams", F.lit(1), (F.col("s") - least + 1).cast("int"))).alias("at", "gram")))


def _segments(ordered: DataFrame) -> DataFrame:
    """(cid, n, segment, grams): each class's shared n-grams by fragment."""
    return (ordered.select("cid", "n", F.explode("grams").alias("gram"))
            .groupBy("cid", "n", F.pmod("gram", F.lit(SEGMENTS)).cast("int").alias("segment"))
            .agg(F.collect_list("gram").alias("grams")))


def _links(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """The pairs (a, b) that link: partial overlaps of segments, summed."""
    left = segments.select(F.col("cid").alias("a"), F.col("n").alias("na"), "segment",
                           F.col("grams").alias("ga"))
    right = segments.select(F.col("cid").alias("b"), F.col("n").alias("nb"), "segment",
                            F.col("grams").alias("gb"))
    part = (pairs.join(left, "a").join(right, ["b", "segment"])
            .select("a", "b", "na", "nb", F.size(F.array_intersect("ga", "gb")).alias("c")))
    common = F.sum("c").alias("c")
    return (part.groupBy("a", "b", "na", "nb").agg(common)
            .where(100 * F.col("c") >= PER_CENT * (F.col("na") + F.col("nb") - F.col("c")))
            .select("a", "b"))


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(cid, label): the smallest cid that links reach from each of ``nodes``.  Labels go
    along links and then jump to the label of the label, until none changes."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        links.select(F.col("b").alias("u"), F.col("a").alias("v"))).distinct()
    both = written(both)
    touched = written(both.select(F.col("u").alias("cid")).distinct()
                  .withColumn("label", F.col("cid")))
    while True:
        near = (both.join(touched.withColumnRenamed("cid", "u"), "u")
                .groupBy(F.col("v").alias("cid")).agg(F.min("label").alias("near")))
        step = (touched.join(near, "cid")
                .select("cid", F.col("label").alias("old"), F.least("label", "near").alias("label")))
        of = step.select(F.col("cid").alias("label"), F.col("label").alias("jump"))
        step = written(step.join(of, "label").select("cid", "old", F.col("jump").alias("label")))
        changed = step.where("old <> label").limit(1).count()
        touched = step.drop("old")
        if not changed:
            break
    return nodes.join(touched, "cid", "left").select(
        "cid", F.coalesce("label", "cid").alias("label"))


def _fits(a: str, b: str):
    """Sizes that can link."""
    return ((100 * F.least(a, b) >= PER_CENT * F.greatest(a, b)))


def _connected(ordered: DataFrame) -> DataFrame:
    """(cid, label) of all classes of ``ordered``: components under links."""
    tokens = written(_tokens(ordered))
    segments = written(_segments(ordered))
    nodes = ordered.select("cid")
    label = nodes.withColumn("label", F.col("cid"))
    tried = None
    for turn in range(STARS):
        members = tokens.join(label, "cid")
        # first the class with the least text of its own, later any other
        first = F.col("s") / F.col("n") if not turn else F.xxhash64("cid", F.lit(turn))
        # groups of one token that still hold several components
        open_ = (members.groupBy("gram").agg(
            F.count(F.lit(1)).alias("m"), F.min("label").alias("lo"), F.max("label").alias("hi"),
            F.max(F.struct(first.alias("first"), (-F.col("cid")).alias("cid"), "label", "n"))
            .alias("p"))
            .where("lo <> hi")
            .select("gram", "m", (-F.col("p")["cid"]).alias("a"), F.col("p")["label"].alias("la"),
                    F.col("p")["n"].alias("na")))
        star = (members.join(open_, "gram").where("label <> la").where(_fits("n", "na"))
                .select(F.least("a", "cid").alias("a"), F.greatest("a", "cid").alias("b"))
                .distinct())
        if tried is not None:
            star = star.join(tried, ["a", "b"], "left_anti")
        star = written(star)
        n_star = star.count()
        if not n_star:
            break
        tried = star if tried is None else tried.unionByName(star)
        new = _links(star, segments)
        old = label.where("cid <> label").select(F.col("label").alias("a"), F.col("cid").alias("b"))
        label = written(components(nodes, old.unionByName(new)))
        left = (tokens.join(label, "cid").groupBy("gram", "label").agg(F.count(F.lit(1)).alias("c"))
                .groupBy("gram").agg(F.sum("c").alias("m"),
                                     F.sum(F.col("c") * F.col("c")).alias("q"))
                .agg(F.sum(F.col("m") * F.col("m") - F.col("q")) / 2, F.sum("m")).first())
        if not left[0] or left[0] <= FEW * left[1]:
            break
    # what no star has settled, pair by pair
    members = tokens.join(label, "cid")
    mixed = (members.groupBy("gram").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
             .where("lo <> hi").select("gram"))
    side = written(members.join(mixed, "gram"))
    x = side.select("gram", *[F.col(c).alias(f"{c}a") for c in ("cid", "n", "s", "at", "label")])
    y = side.select("gram", *[F.col(c).alias(f"{c}b") for c in ("cid", "n", "s", "at", "label")])
    # from their first common n-gram on, so many can be common (positional filter)
    room = F.least(F.col("sa") - F.col("ata"), F.col("sb") - F.col("atb"))
    need = F.ceil((F.col("na") + F.col("nb")) * PER_CENT / (100 + PER_CENT))
    rest = (x.join(y, "gram").where("cida < cidb AND labela <> labelb").where(_fits("na", "nb"))
            .where(room >= need)
            .select(F.col("cida").alias("a"), F.col("cidb").alias("b")).distinct())
    if tried is not None:
        rest = rest.join(tried, ["a", "b"], "left_anti")
    new = _links(rest, segments)
    old = label.where("cid <> label").select(F.col("label").alias("a"), F.col("cid").alias("b"))
    return components(nodes, old.unionByName(new))


def _placed(rows: DataFrame) -> DataFrame:
    """(id, mark, n, rep, label, component_id) of every row (id, mark, text): the smallest id
    with the row's set, the component's label and its smallest id.  The last three are null
    for rows without an id or without words."""
    sets = written(_sets(rows))
    real = F.col("id").isNotNull() & (F.col("n") > 0)
    classes = cut(sets.where(real).groupBy("fp1", "fp2")
                  .agg(F.min("id").alias("rep"), F.max("n").alias("n")))
    classes = classes.withColumn("cid", F.monotonically_increasing_id())   # of written rows
    hopeful = written(_hopeful(rows.where(F.col("id").isNotNull()), classes))
    label = _connected(_ordered(rows, hopeful))
    named = classes.join(label, "cid", "left").select(
        "fp1", "fp2", "rep", F.coalesce("label", "cid").alias("label"))
    least = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "label")
    # classes are fewer than rows; a class with very many copies is split by AQE
    return (sets.join(named, (sets["fp1"] == named["fp1"]) & (sets["fp2"] == named["fp2"])
                      & real, "left")
            .select("id", "mark", "n", "rep", "label", "component_id"))


def joined(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: the id, ``n_shingles``, ``class_id`` (the smallest id with the
    same set) and ``component_id`` (the smallest id reachable by links, its own included).

    A null, empty or blank text has the empty set, which links with nothing.  A null id
    has no component and takes no part.  Repeated rows have one class; an id with several
    texts has a row for each, each in the component of its text.  Other columns are left
    aside; an empty table gives no rows."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.lit(None).cast("binary").alias("mark"),
                       F.col(text_col).cast("string").alias("text"))
    return _placed(rows).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("rep")).otherwise(F.col("id")).alias("class_id"),
        F.coalesce("component_id", "id").alias("component_id"))


def first_of_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of every group of near duplicates: of the rows that links join,
    the one with the smallest id (of several texts under it, the one of the smallest digest).

    Rows are told apart by all their columns, so an id with several texts keeps each text that
    nothing links; equal rows count as one.  A row without words is a group with the rows of
    its id without words; rows without an id all stay.  An empty table gives no rows."""
    cols = docs.columns
    named = docs.where(F.col(id_col).isNotNull())
    # every column with its nulls, so equal marks are equal rows
    mark = F.unhex(F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256))
    rows = named.select(F.col(id_col).cast("long").alias("id"), mark.alias("mark"),
                        F.col(text_col).cast("string").alias("text"))
    empty = F.when(F.col("label").isNull(), F.col("id"))
    keep = (_placed(rows).groupBy("label", empty.alias("_own"))
            .agg(F.min(F.struct("id", "mark")).alias("k"))
            .select(F.col("k.mark").alias("_mark")))
    # equal rows meet as one row of every task before they are shuffled
    once = named.withColumn("_mark", mark).dropDuplicates(["_mark"])
    return (once.join(keep, "_mark").select(*cols)
            .unionByName(docs.where(F.col(id_col).isNull())))


def op6_ngram_join(spark, sf_dir: str) -> DataFrame:
    return joined(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles",
                                                            "component_id")
