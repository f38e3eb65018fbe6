"""Exact merge-type (BPE) SentencePiece encoding by backtracking, and decoding.

A sequence of pieces is the BPE encoding of its text exactly if every two neighbours are:
merging the two pieces' characters again, best score first, leftmost on ties, must give
back the same two pieces.  So the encoder walks the text once: at each position it takes
the longest piece that an Aho-Corasick automaton found there, goes to the next shorter
one while the pair with the piece before is incompatible, and steps back when none is
left, marking the position in a bitfield so that no path tries it again.  Where the longest
pieces alone are compatible, the first path through is the encoding; the automaton gives it in
one pass.

The piece list never has a blank mark after another character (checked when the model is
read), so no merge crosses the start of a word and words can be encoded one by one; each
worker remembers a bounded number of words and of pair checks.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketstream.llm.common import arrow_map, int_lists, texts

BLANK = "▁"
WORDS_KEPT = 240_000    # encoded words that a worker remembers, in each of two generations
PAIRS_KEPT = 400_000    # pair checks that a worker remembers
_CHUNK = re.compile(f"{BLANK}+[^{BLANK}]*")


class _Words(dict):
    """Encoded words by their text without the first blank mark: encodes what it misses, and
    keeps two generations of a bounded number of words."""

    def __init__(self, chunk):
        super().__init__()
        self.chunk, self.before = chunk, {}

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = self.before.get(word) or self.chunk(BLANK + word)
        if len(word) < 64:
            if len(self) >= WORDS_KEPT:
                self.before = dict(self)
                self.clear()
            self[word] = ids
        return ids


class MergePieces:
    """The pieces of one BPE model: encode and decode whole texts."""

    def __init__(self, model_file: str):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=model_file)
        n = sp.get_piece_size()
        # only the piece list and its scores are taken from the library
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i)
                                             or sp.is_byte(i) or sp.is_unused(i))]
        self.piece = {i: sp.id_to_piece(i) for i in plain}
        self.id = {p: i for i, p in self.piece.items()}
        self.score = {p: sp.get_score(i) for i, p in self.piece.items()}
        self.byte = {int(sp.id_to_piece(i)[1:-1], 16): i for i in range(n) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte.items()}
        self.size = n
        if len(self.byte) != 256:
            raise ValueError("the model has no byte fallback")
        if sp.normalize("ﬁ  é ") != f"{BLANK}ﬁ{BLANK}{BLANK}é{BLANK}":
            raise ValueError("only models without text normalisation are supported")
        single = {p for p in self.id if len(p) == 1}
        for p in self.id:
            if BLANK in p.lstrip(BLANK) or (p[0] == BLANK and p[1:2] == BLANK and p.strip(BLANK)):
                raise ValueError(f"piece {p!r} spans words")
            if not single.issuperset(p):
                raise ValueError(f"piece {p!r} has a character that is no piece")
        self.unknown = re.compile("[^" + "".join(map(re.escape, sorted(single))) + "]+")
        self.automaton = ahocorasick.Automaton()
        for p, i in self.id.items():
            self.automaton.add_word(p, i)
        self.automaton.make_automaton()
        self.length = [len(self.piece.get(i, "")) for i in range(n)]
        # a byte of 0x80 or more stands as its escape until its character is whole
        self.text = [self.piece[i].replace(BLANK, " ") if i in self.piece
                     else bytes([self.byte_of[i]]).decode("utf-8", "surrogateescape")
                     if i in self.byte_of else "" for i in range(n)]
        self.pairs: dict[int, bool] = {}
        self.words = _Words(self.chunk)

    # ------------------------------------------------------------ merging again
    def merged(self, text: str) -> list[str]:
        """``text`` merged from characters, best score first, leftmost on ties."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = self.score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, a: int, b: int) -> bool:
        key = a * self.size + b
        ok = self.pairs.get(key)
        if ok is None:
            x, y = self.piece[a], self.piece[b]
            ok = self.merged(x + y) == [x, y]
            if len(self.pairs) >= PAIRS_KEPT:
                self.pairs.clear()
            self.pairs[key] = ok
        return ok

    # ------------------------------------------------------------ encoding
    def _known(self, text: str) -> list[int]:
        """The ids of a text of known characters only, by backtracking."""
        n = len(text)
        length, pairs, size = self.length, self.pairs, self.size
        ids = [i for _, i in self.automaton.iter_long(text)]
        last = -1
        for i in ids:                              # the path of longest pieces
            if last >= 0:
                ok = pairs.get(last * size + i)
                if not (ok or (ok is None and self.compatible(last, i))):
                    break
            last = i
        else:
            return ids
        at: list[list[int]] = [[] for _ in range(n)]
        for end, i in self.automaton.iter(text):
            at[end - length[i] + 1].append(i)      # shorter ones come first
        failed = bytearray((n >> 3) + 1)           # one bit per position
        ids: list[int] = []
        ranks: list[int] = []
        pos, rank, last = 0, len(at[0]) - 1, -1
        while pos < n:
            found = at[pos]
            while rank >= 0:
                i = found[rank]
                end = pos + length[i]
                if not failed[end >> 3] >> (end & 7) & 1:
                    ok = last < 0 or pairs.get(last * size + i)
                    if ok or (ok is None and self.compatible(last, i)):
                        break
                rank -= 1
            if rank >= 0:
                ids.append(i)
                ranks.append(rank)
                pos, last = end, i
                if pos < n:
                    rank = len(at[pos]) - 1
            else:                                  # no way on from here
                failed[pos >> 3] |= 1 << (pos & 7)
                pos -= length[ids.pop()]
                rank = ranks.pop()
                last = ids[-1] if ids else -1
        return ids

    def chunk(self, text: str) -> tuple[int, ...]:
        """The ids of one word with its blank marks; characters that are no piece become
        their UTF-8 bytes and part the word, for nothing merges with them."""
        ids: list[int] = []
        pos = 0
        for m in self.unknown.finditer(text):
            if m.start() > pos:
                ids += self._known(text[pos:m.start()])
            ids += [self.byte[b] for b in m[0].encode()]
            pos = m.end()
        if pos < len(text):
            ids += self._known(text[pos:])
        return tuple(ids)

    def encode(self, text: str) -> list[int]:
        """The ids of a whole text, without begin or end ids."""
        if not text:
            return []
        if BLANK in text or "  " in text or text[0] == " " or text[-1] == " ":
            # a word has all the blank marks before it
            words = (w[1:] for w in _CHUNK.findall((BLANK + text).replace(" ", BLANK)))
        else:
            words = text.split(" ")
        return list(chain.from_iterable(map(self.words.__getitem__, words)))

    # ------------------------------------------------------------ decoding
    def decode(self, ids) -> str:
        """Pieces as text: runs of bytes read as UTF-8, blank marks as spaces, without the
        one blank that encoding puts first."""
        text = self.text
        out = "".join(map(text.__getitem__, ids))
        try:
            out.encode()
        except UnicodeEncodeError:                 # holds escaped bytes
            out = out.encode("utf-8", "surrogateescape").decode("utf-8", "replace")
        return out[1:] if out[:1] == " " else out


@lru_cache(maxsize=1)
def pieces_of(model_file: str) -> MergePieces:
    """The model and what it remembers, kept by a Python worker from task to task."""
    return MergePieces(model_file)


def encode_decode(df: DataFrame, model_file: str, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: the id, ``ids`` (array<int>) of the whole text without
    begin or end ids, and ``decoded``, the text of these ids.

    A null text counts as empty (no ids, empty text); a null id stays null; repeated rows
    give repeated rows; other columns are left aside; an empty table gives no rows.
    Memory: one Arrow batch (bounded in bytes by Spark) and the bounded word memory."""

    def make():
        pieces = pieces_of(model_file)

        def step(b: pa.RecordBatch):
            got = [pieces.encode(t) for t in texts(b, "text")]
            return b.column("id"), int_lists(got), [pieces.decode(i) for i in got]

        return step

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = arrow_map(rows, make, f"id {rows.schema['id'].dataType.simpleString()}, "
                                "ids array<int>, decoded string")
    return out.withColumnRenamed("id", id_col)


def op3_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and decoded text under ``piece_bpe_32k.model``."""
    import public_tokenizers

    from marketstream.llm.common import table

    out = encode_decode(table(spark, sf_dir, "documents"),
                        public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256)
                      .alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
