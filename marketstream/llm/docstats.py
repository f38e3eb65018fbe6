"""Statistics of one text, shared by the quality classifier and the quality rules."""

from __future__ import annotations

import numpy as np

from marketstream.llm.common import SPACES

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SHARES = ["log_words", "mean_word", "mean_line", "symbol_share", "bar_share", "bang_share",
          "upper_share", "digit_share", "stop_share", "comma_share", "unique_share",
          "twin_share", "repeat_share", "top_share", "dup_line_share", "ended_share",
          "entropy", "word_spread", "short_share"]


def _repeats(ids: np.ndarray, kinds: int) -> int:
    """Words inside 3-word windows that stand twice or more in the text."""
    n = len(ids)
    if n < 4:
        return 0
    key = (ids[:-2] * kinds + ids[1:-1]) * kinds + ids[2:]
    order = np.argsort(key, kind="stable")
    run = key[order]
    twin = run[1:] == run[:-1]
    again = np.zeros(n - 2, bool)
    again[order[1:][twin]] = True
    again[order[:-1][twin]] = True
    hit = np.zeros(n, bool)
    hit[:-2] |= again
    hit[1:-1] |= again
    hit[2:] |= again
    return int(hit.sum())


def _dup_lines(raw: bytes) -> tuple[int, int]:
    """Lines equal to an earlier one, and lines; only lines with a word count."""
    lines = [x for x in raw.split(b"\n") if x.split(None, 1)]
    return len(lines) - len(set(lines)), len(lines)


def statistics(text: str) -> tuple[list[int], list[float]]:
    """(COUNTS, SHARES) of a whole text; an empty text has zeros throughout."""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    if not n:
        return [0, 0, 0, 0, 0], [0.0] * len(SHARES)
    kinds: dict[bytes, int] = {}
    ids = np.fromiter((kinds.setdefault(w, len(kinds)) for w in words), np.int64, n)
    by = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    chars = len(text)
    word_chars = chars - int(sum(by[ord(c)] for c in SPACES))
    symbols = int(sum(by[ord(c)] for c in SYMBOLS))
    dup, lines = _dup_lines(raw)
    repeat = _repeats(ids, len(kinds))
    upper, lower = int(by[65:91].sum()), int(by[97:123].sum())
    sizes = np.fromiter(map(len, words), np.int64, n)
    p = by[by > 0] / len(raw)
    ended = sum(1 for x in raw.split(b"\n") if x.rstrip()[-1:] in (b".", b"!", b"?"))
    shares = [
        float(np.log1p(n)), word_chars / n, float(np.log1p(chars / max(lines, 1))),
        symbols / chars, int(by[124]) / n, int(by[33]) / n, upper / max(upper + lower, 1),
        int(by[48:58].sum()) / chars, (int(by[46]) + int(by[63])) / n, int(by[44]) / n,
        len(kinds) / n, float((ids[1:] == ids[:-1]).mean()) if n > 1 else 0.0, repeat / n,
        float(np.bincount(ids).max()) / n, dup / max(lines, 1), ended / max(lines, 1),
        float(-(p * np.log2(p)).sum()), float(sizes.std()), float((sizes <= 2).mean())]
    return [n, word_chars, symbols, dup, repeat], shares
