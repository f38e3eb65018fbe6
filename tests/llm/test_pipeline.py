from __future__ import annotations

import corpus_pipeline as C
import pyarrow as pa
from .conftest import SF
from .test_ngram_join import brute
from .test_packing import places

from marketstream.llm.common import _BATCH_CONF, BATCH_BYTES, written
from marketstream.llm.langid import fit as fit_languages
from marketstream.llm.langid import learn_rows, predict
from marketstream.llm.pii import DEMO_KEY, Pseudonyms
from marketstream.llm.quality import fit, score


def test_stages_against_their_operators(spark, documents):
    docs = documents
    kept = written(C.quality(spark, docs, SF))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = {r.doc_id for r in score(docs, fit(docs, labels)).where("score >= 0.3").collect()}
    assert {r.doc_id for r in kept.collect()} == good and kept.columns == C.COLUMNS
    docs, kept = kept, written(C.language(spark, kept, SF))
    told = predict(docs, fit_languages(learn_rows(docs))).where("lang_pred <> 'und' AND score >= 0.5")
    # no document of these tables is in a language that was not learnt
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in told.collect())
    docs, kept = kept, written(C.near_duplicates(spark, kept, SF))
    groups = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in groups})
    docs, kept = kept, written(C.personal_data(spark, kept, SF))
    names = Pseudonyms(DEMO_KEY)
    want = {r.doc_id: names.replace(r.text)[0] for r in docs.collect()}
    assert {r.doc_id: r.text for r in kept.collect()} == want
    assert all(r.n_chars == len(r.text) for r in kept.collect())
    last = C.packing(spark, kept, SF).collect()
    assert {r.doc_id for r in last} == set(want) and places(last, 2048)


def test_odd_rows_and_none(spark, odd, none):
    for df in (odd, none):
        for name, stage in C.STAGES[:-1]:
            out = stage(spark, df, SF)
            assert out.columns == C.COLUMNS, name
            assert out.count() <= df.count()
        assert C.packing(spark, df, SF).count() >= df.count()
    same = C.near_duplicates(spark, odd, SF).collect()
    assert sorted(r.doc_id for r in same if r.doc_id is not None) == [1, 3, 4, 5, 6, 7, 8]
    assert sum(r.doc_id is None for r in same) == 2


def test_repeated_ids_lose_no_text_that_nothing_links(spark):
    """Ids with one copy of another text and one text of their own, ids with two texts, rows
    that stand twice, texts without words, null ids; against the pairs of all texts."""
    def words(k, n=40):
        return " ".join(f"w{k}x{j}" for j in range(n))
    rows = [(k, words(k % 3)) for k in range(10, 20)] + [(k, words(100 + k)) for k in range(10, 20)]
    rows += [(30, words(7)), (30, words(8)), (31, words(7) + " more"), (32, words(8)), (30, words(7))]
    rows += [(40, ""), (40, None), (41, ""), (None, words(7)), (None, words(7)), (5, words(200))] * 2
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows],
                               "doc_id long, text string, lang string, source string, n_chars long")
    kept = [(r.doc_id, r.text) for r in C.near_duplicates(spark, df.repartition(4), SF).collect()]
    named = sorted({(i, t or "") for i, t in rows if i is not None})
    # rows (id, text): equal texts, or 80 % of their n-grams, link
    of = {x: x for x in named}
    sets = {x: set(zip(*[x[1].split()[k:] for k in range(5)], strict=False)) for x in named}
    for _ in named:
        for x in named:
            for y in named:
                a, b = sets[x], sets[y]
                if a and b and 100 * len(a & b) >= 80 * len(a | b):
                    of[x] = of[y] = min(of[x], of[y])
    groups = {}
    for x in named:
        groups.setdefault(of[x] if sets[x] else ("empty", x[0]), []).append(x)
    got = [x for x in kept if x[0] is not None]
    assert len(got) == len(groups)
    for members in groups.values():
        mine = [x for x in got if (x[0], x[1] or "") in members]
        assert len(mine) == 1 and mine[0][0] == min(i for i, _ in members)
    assert sum(i is None for i, _ in kept) == 4


def test_workers_get_batches_of_bounded_bytes(spark):
    """The stages' session hands workers batches bounded in bytes, whatever the rows hold."""
    own = spark.newSession()
    docs = own.range(2000).selectExpr("id AS doc_id", "repeat('ab cd ', 2000) AS text",
                                      "cast(null AS string) AS lang", "'s' AS source", "12000L AS n_chars").coalesce(1)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.nbytes]})

    kept = C.language(own, docs, SF)
    found = [r.n for r in kept.mapInArrow(sizes, "n long").collect()]
    assert sum(found) > 20 << 20 and max(found) < 2 * BATCH_BYTES
    own.conf.set(_BATCH_CONF, "1000000")            # a bound of the session's own stays
    C.language(own, docs, SF)
    assert own.conf.get(_BATCH_CONF) == "1000000"
