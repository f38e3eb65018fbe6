from __future__ import annotations

import random

import public_tokenizers
import sentencepiece

from marketstream.llm.sentencepiece import MergePieces, encode_decode

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_random_texts_equal_the_library():
    mine = MergePieces(MODEL)
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rnd = random.Random(5)
    parts = ["a", "b", "t", "he", "in", " ", "  ", "\n", "\t", "▁", "é", "漢", "😀", "\x00", "1", ".",
             "tion", "́", "ß", "\r\n", "<s>", "﻿", "\xa0", " the", " " * 17]
    for _ in range(3000):
        text = "".join(rnd.choices(parts, k=rnd.randint(0, 24)))
        ids = mine.encode(text)
        assert ids == lib.encode(text), repr(text)
        assert mine.decode(ids) == lib.decode(ids)
    for text in (" " * 100 + "t" + " " * 33, " " * 112 + "the", "th" * 3000, "a" * 5000, "漢" * 50):
        assert mine.encode(text) == lib.encode(text)


def test_documents_and_odd_rows(documents, odd, none):
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for df in (documents, odd):
        rows = {(r.doc_id, tuple(r.ids), r.decoded) for r in encode_decode(df, MODEL).collect()}
        want = {(r.doc_id, tuple(i := lib.encode(r.text or "")), lib.decode(i))
                for r in df.select("doc_id", "text").collect()}
        assert rows == want
    assert encode_decode(odd, MODEL).count() == odd.count()
    assert encode_decode(none, MODEL).collect() == []
