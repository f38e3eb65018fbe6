from __future__ import annotations

import zlib
from itertools import pairwise

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from marketstream.llm.packing import (best_fit, encoder, lower_bound, pack, packed_documents,
                                      tokenised)

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def optimum(sizes, cap):
    best = [len(sizes)]

    def go(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(sizes):
            best[0] = len(bins)
            return
        for j in range(len(bins)):
            if bins[j] + sizes[k] <= cap:
                go(k + 1, bins[:j] + [bins[j] + sizes[k]] + bins[j + 1:])
        go(k + 1, [*bins, sizes[k]])

    go(0, [])
    return best[0]


def test_bound_and_packing_against_brute_force():
    rnd = np.random.default_rng(2)
    for _ in range(150):
        cap = int(rnd.integers(5, 40))
        sizes = rnd.integers(1, cap + 1, int(rnd.integers(0, 8)))
        sizes = np.sort(sizes)[::-1]
        low = lower_bound(sizes, cap)
        seq, off, room = best_fit(sizes, cap)
        assert low <= optimum(list(sizes), cap) <= len(room)
        used = np.zeros(len(room), int)
        np.add.at(used, seq, sizes)
        assert (cap - used == room).all() and (room >= 0).all()


def places(rows, cap):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for v in by.values():
        v.sort()
        assert v[0][0] == 0 and all(a + n == b for (a, n), (b, _) in pairwise(v))
        assert sum(v[-1]) <= cap
    return len(by)


def test_exchange_between_partitions(spark):
    sizes = [int(x) for x in np.random.default_rng(1).integers(1, 2049, 3000)]
    df = spark.createDataFrame([(7, n) for n in sizes], "doc_id long, length long").repartition(4)
    rows = pack(df, per_partition=500).collect()
    assert sorted(r.length for r in rows) == sorted(sizes)
    alone = sum(len(best_fit(np.array(sizes[k::6]), 2048)[2]) for k in range(6))
    assert lower_bound(np.array(sizes), 2048) <= places(rows, 2048) <= alone + 6
    with pytest.raises(Exception, match="out of range"):
        pack(spark.createDataFrame([(1, 9)], "doc_id long, length long"), 8).collect()


def test_pieces_equal_the_tokenizers_library(documents, odd, none):
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    lib.encode_special_tokens = True
    for df in (documents.limit(60), odd):
        want = []
        for r in df.select("doc_id", "text").collect():
            ids = [*lib.encode(r.text or "", add_special_tokens=False).ids, 0]
            cut = [0, *range((len(ids) - 1) % 2048 + 1, len(ids) + 1, 2048)]
            for k, (a, b) in enumerate(pairwise(cut)):
                want.append((r.doc_id or -1, k, a, b - a,
                             zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
        rows = packed_documents(df).collect()
        assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32)
                      for r in rows) == sorted(want)
        places(rows, 2048)
    assert packed_documents(none).collect() == []
    kept = tokenised(odd, RANKS, public_tokenizers.PATTERN, keep_ids=True).collect()
    assert all(len(r.ids) == r.length for r in kept)


def test_ids_of_special_strings_and_long_white_space(spark):
    """As the tokenizers library has them with its own settings."""
    name = public_tokenizers.path("byte_bpe_50k.json")
    lib, encode = Tokenizer.from_file(name), encoder(RANKS, name, public_tokenizers.PATTERN)
    end = "<|endoftext|>"
    odd = ["", end, f"a {end} b  {end}{end}\n", f"  {end}  ", "<|endoftext|", f"{end}s'{end}s"]
    runs = [c * n for c in (" ", "\n", "\u3000") for n in (99_999, 100_000, 1_100_000)]
    for t in [*odd, *runs, f"a{runs[2]}b {end}", f"{runs[5]}\x1c{end}", "x" * 1_100_000]:
        assert encode(t) == lib.encode(t, add_special_tokens=False).ids
    df = spark.createDataFrame([(1, f"a{end}b"), (2, f"a{runs[2]}b")], "doc_id long, text string")
    for r in tokenised(df, RANKS, public_tokenizers.PATTERN, keep_ids=True).where("piece = 0").collect():
        if r.doc_id == 1:
            assert r.ids == [64, 50256, 65, 0]
