"""Format-preserving pseudonyms for personal data.

Values that look like personal data and pass their check (Luhn, mod 97, calendar, octet
range, number plan) are replaced by a keyed permutation of the same format: a Feistel
network over the digits and letters of the value, so equal values get equal pseudonyms in
every document and different values different ones.  Check digits are computed anew, dates
stay dates, and a walk along the permutation's cycle skips results outside the format.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketstream.llm.common import arrow_map, arrow_rows, table

#: Key of the registered query; real runs pass their own.
DEMO_KEY = b"corpus pseudonyms"
FEISTEL_ROUNDS = 8
#: Dates of this span (years) are permuted among themselves.
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()

_DIGITS = "0123456789"
_LOWER = "abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()
_HEX = "0123456789abcdef"

KINDS = ["email", "secret", "iban", "card", "phone", "ssn", "ip", "date"]

# Only texts with one of these can hold a match of _ANY: an e-mail has its @, a named secret
# its = or :, a key its prefix, and the other kinds have digits.
_MAYBE = re.compile(r"[0-9@=:]|AKIA|ASIA|gh[pousr]_|sk-|xox[abprs]-")
# What a value of each kind looks like, tried in this order where one starts.
_LOOKS = [
    ("email", r"(?<![A-Za-z0-9._%+-])[\w.%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24}"
              r"(?![A-Za-z0-9])"),
    ("secret", r"(?<![A-Za-z0-9_])(?:[A-Za-z0-9]{1,32}[_-])?"
               r"(?i:token|password|passwd|pwd|secret|api[_-]?key|access[_-]?key)"
               r"(?:[\"'][ ]?)?[ ]?[=:][ ]?[\"']?(?P<value>[A-Za-z0-9+/_.-]{6,}[A-Za-z0-9+/_-])"),
    ("secret", r"(?<![A-Za-z0-9_])(?:(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])"
               r"|gh[pousr]_[A-Za-z0-9]{36,}|sk-[A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{10,})"),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?"
             r"(?![A-Za-z0-9])"),
    # an ISO date may be followed by its time
    ("date", r"(?<![\w./-])(?:[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}(?=[Tt][0-9]{2}(?::?[0-9]{2}|(?!\w)))"
             r"|(?:[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}"
             r"|[0-9]{1,2}[./-][0-9]{1,2}[./-][0-9]{4})(?![\w/-])(?!\.[0-9]))"),
    ("ip", r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w]|\.[0-9])"),
    ("card", r"(?<![\w.+-])[0-9]{13,19}(?![\w-]|\.[0-9])"),
    ("card", r"(?<![\w.+-])[0-9]{4}(?:[ -][0-9]{4}){3}(?![\w-]|\.[0-9])"),
    ("card", r"(?<![\w.+-])[0-9](?:[ -]?[0-9]){12,18}(?![\w-]|\.[0-9])"),
    ("ssn", r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"),
    ("phone", r"(?<![\w.+-])(?:\+[0-9]{1,3}(?:[ .-]?\([0-9]{1,4}\)|[ .-]?[0-9]{1,4})"
              r"(?:[ .-]?[0-9]{2,4}){1,4}"
              r"|(?:1[ .-])?(?:\([2-9][0-9]{2}\)[ ]?|[2-9][0-9]{2}[ .-])[0-9]{3}[ .-][0-9]{4})"
              r"(?![\w-])"),
]
_EACH = [(k, re.compile(p)) for k, p in _LOOKS]
_ANY = re.compile("|".join(f"(?:{p})" for _, p in _LOOKS))


# ---------------------------------------------------------------- permutations
class Feistel:
    """Keyed permutations of 0 .. a*b-1, by alternating additions in the two halves."""

    def __init__(self, key: bytes, rounds: int = FEISTEL_ROUNDS):
        if not key:
            raise ValueError("an empty key")
        self.key = hashlib.blake2b(key, digest_size=32).digest()
        self.rounds = rounds

    def _f(self, tweak: str, n: int, half: int) -> int:
        d = hashlib.blake2b(f"{tweak}|{n}|{half}".encode(), key=self.key, digest_size=32)
        return int.from_bytes(d.digest(), "big")

    def permute(self, x: int, a: int, b: int, tweak: str) -> int:
        left, right = divmod(x, b)
        for n in range(self.rounds):
            if n & 1:
                right = (right + self._f(tweak, n, left)) % b
            else:
                left = (left + self._f(tweak, n, right)) % a
        return left * b + right

    def restore(self, y: int, a: int, b: int, tweak: str) -> int:
        left, right = divmod(y, b)
        for n in reversed(range(self.rounds)):
            if n & 1:
                right = (right - self._f(tweak, n, left)) % b
            else:
                left = (left - self._f(tweak, n, right)) % a
        return left * b + right

    def below(self, x: int, n: int, tweak: str) -> int:
        """A permutation of 0 .. n-1 for any n: walks on while the result is not below n."""
        a = int(n ** 0.5) + 1
        b = -(-n // a)
        while True:
            x = self.permute(x, a, b, tweak)
            if x < n:
                return x

    def characters(self, text: str, alphabets: list[str], tweak: str,
                   valid: Callable[[str], bool] = lambda _: True) -> str:
        """``text`` with the character at each place permuted within its alphabet; ``text``
        is valid, and so is the result (the permutation is walked on until it is)."""
        m = len(text) // 2
        a = b = 1
        x = y = 0
        for c, al in zip(text[:m], alphabets[:m], strict=True):
            a, x = a * len(al), x * len(al) + al.index(c)
        for c, al in zip(text[m:], alphabets[m:], strict=True):
            b, y = b * len(al), y * len(al) + al.index(c)
        n = x * b + y
        while True:
            n = self.permute(n, a, b, tweak)
            rest, out = n, []
            for al in reversed(alphabets):
                rest, k = divmod(rest, len(al))
                out.append(al[k])
            got = "".join(reversed(out))
            if valid(got):
                return got


# ---------------------------------------------------------------- checks
def luhn_digit(payload: str) -> int:
    total = 0
    for k, c in enumerate(reversed(payload)):
        d = int(c) * (2 - k % 2)
        total += d - 9 if d > 9 else d
    return -total % 10


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def _classes(text: str, digits: str = _DIGITS) -> list[str]:
    return [digits if c in digits else _LOWER if c in _LOWER else _UPPER for c in text]


def _refill(shape: str, chars: str, is_slot: Callable[[str], bool]) -> str:
    it = iter(chars)
    return "".join(next(it) if is_slot(c) else c for c in shape)


def _alnum(c: str) -> bool:
    return c in _DIGITS or c in _LOWER or c in _UPPER


class Pseudonyms:
    """Finds and replaces personal data in texts."""

    def __init__(self, key: bytes):
        self.feistel = Feistel(key)
        self.kinds = {k: getattr(self, f"_{k}") for k in KINDS}

    # each returns the pseudonym, or None if the value does not pass its check
    def _chars(self, kind: str, value: str, valid=lambda _: True) -> str:
        """All ASCII letters and digits of a value permuted in their classes."""
        slots = "".join(filter(_alnum, value))
        if not slots:
            return value
        hexes = kind == "secret" and all(c in _HEX for c in slots)
        alphabets = [_HEX] * len(slots) if hexes else _classes(slots)
        tweak = f"{kind}|{len(slots)}|{'h' * hexes}" + "".join(a[0] for a in alphabets)
        return _refill(value, self.feistel.characters(slots, alphabets, tweak, valid), _alnum)

    def _email(self, value: str, m) -> str:
        local, domain = value.split("@")
        name, _, top = domain.rpartition(".")
        return self._chars("email", f"{local}@{name}") + "." + top

    def _secret(self, value: str, m) -> str:
        if inner := m.groupdict().get("value"):
            at = m.start("value") - m.start()
            return value[:at] + self._chars("secret", inner)
        head = re.match(r"AKIA|ASIA|gh._|sk-|xox.-", value)[0]
        return head + self._chars("secret", value[len(head):])

    def _iban(self, value: str, m) -> str | None:
        flat = value.replace(" ", "")
        if not 15 <= len(flat) <= 34 or _mod97(flat[4:] + flat[:4]) != 1:
            return None
        body = self._chars("iban", flat[4:])
        check = 98 - _mod97(body + flat[:2] + "00")
        return _refill(value, f"{flat[:2]}{check:02d}{body}", lambda c: c != " ")

    def _card(self, value: str, m) -> str | None:
        digits = "".join(c for c in value if c in _DIGITS)
        if luhn_digit(digits[:-1]) != int(digits[-1]) or len(set(digits)) == 1:
            return None
        body = self.feistel.characters(digits[:-1], [_DIGITS] * (len(digits) - 1),
                                       f"card|{len(digits)}", lambda t: len(set(t)) > 1)
        return _refill(value, body + str(luhn_digit(body)), _DIGITS.__contains__)

    def _phone(self, value: str, m) -> str | None:
        plus = re.match(r"\+([0-9]{1,3})(?=[^0-9]|$)", value)
        digits = "".join(c for c in value if c in _DIGITS)
        if not 8 <= len(digits) <= 15:
            return None
        if plus:
            kept = len(plus[1])
        else:
            kept = len(digits) - 10 if len(digits) in (10, 11) and value[0] != "+" else 1
        national = digits[kept:]
        american = len(national) == 10 and digits[:kept] in ("", "1")

        def valid(t: str) -> bool:
            return not american or (t[0] not in "01" and t[3] not in "01")

        if not valid(national):
            american = False
        new = self.feistel.characters(national, [_DIGITS] * len(national),
                                      f"phone|{len(national)}|{american}", valid)
        return _refill(value, digits[:kept] + new, _DIGITS.__contains__)

    def _ssn(self, value: str, m) -> str | None:
        def valid(t: str) -> bool:
            return (t[:3] not in ("000", "666") and t[0] != "9" and t[3:5] != "00"
                    and t[5:] != "0000")

        digits = value.replace("-", "")
        if not valid(digits):
            return None
        new = self.feistel.characters(digits, [_DIGITS] * 9, "ssn", valid)
        return f"{new[:3]}-{new[3:5]}-{new[5:]}"

    def _ip(self, value: str, m) -> str | None:
        parts = [int(x) for x in value.split(".")]
        if max(parts) > 255 or any(len(x) > 1 and x[0] == "0" for x in value.split(".")):
            return None
        n = int.from_bytes(bytes(parts), "big")
        return ".".join(map(str, self.feistel.permute(n, 1 << 16, 1 << 16, "ip")
                            .to_bytes(4, "big")))

    def _date(self, value: str, m) -> str | None:
        sep = re.search(r"[^0-9]", value)[0]
        if value.count(sep) != 2:
            return None
        p = [int(x) for x in value.split(sep)]
        first = len(value.split(sep)[0]) == 4
        day = None
        # day first, or month first where only that is a date
        for order in ((0, 1, 2),) if first else ((2, 1, 0), (2, 0, 1)):
            try:
                day = dt.date(p[order[0]], p[order[1]], p[order[2]])
                break
            except ValueError:
                continue
        if day is None or not FIRST_DAY <= day.toordinal() <= LAST_DAY:
            return None
        wide = any(x.startswith("0") for x in value.split(sep)) or not any(
            len(x) == 1 for x in value.split(sep))
        span = LAST_DAY - FIRST_DAY + 1
        new = dt.date.fromordinal(
            FIRST_DAY + self.feistel.below(day.toordinal() - FIRST_DAY, span, "date"))
        got = {order[0]: f"{new.year}", order[1]: f"{new.month:02d}" if wide else f"{new.month}",
               order[2]: f"{new.day:02d}" if wide else f"{new.day}"}
        return sep.join(got[k] for k in range(3))

    def replace(self, text: str) -> tuple[str, list[tuple[str, int, int, str]]]:
        """The text with pseudonyms, and what was replaced: kind, start, end (of the old
        text, in characters) and the pseudonym."""
        if not _MAYBE.search(text):
            return text, []
        found, out, pos, at = [], [], 0, 0
        while start := _ANY.search(text, at):
            at = start.start()
            for kind, look in _EACH:
                m = look.match(text, at)
                new = self.kinds[kind](m[0], m) if m else None
                if new is not None:
                    found.append((kind, at, m.end(), new))
                    out += [text[pos:at], new]
                    pos = at = m.end()
                    break
            else:              # valid as no kind; a value may start further on
                at += 1
        if not found:
            return text, []
        return "".join([*out, text[pos:]]), found


def pseudonymised(docs: DataFrame, key: bytes = DEMO_KEY, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: the id, ``text`` with pseudonyms, and ``found``, an array of
    (kind, start, end, pseudonym) by place.

    A null text stays null with nothing found; repeated rows repeat and get the same
    pseudonyms; null ids stay null; other columns are left aside; an empty table gives none.
    Rows are independent: no shuffle, and a lost task is simply run again."""

    def make():
        names = Pseudonyms(key)

        def step(b: pa.RecordBatch):
            got = [(None, []) if t is None else names.replace(t)
                   for t in b.column("text").to_pylist()]
            return (b.column("id"), [g[0] for g in got],
                    [[{"kind": k, "start": s, "end": e, "pseudonym": p} for k, s, e, p in g[1]]
                     for g in got])

        return step

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = arrow_map(rows, make, f"id {rows.schema['id'].dataType.simpleString()}, text string, "
                    "found array<struct<kind string, start int, end int, pseudonym string>>")
    return out.withColumnRenamed("id", id_col)


def replaced(docs: DataFrame, key: bytes, text_col: str = "text",
             chars_col: str = "n_chars") -> DataFrame:
    """``docs``, all columns, with pseudonyms in the text and the new number of characters
    (a null text and its number stay)."""

    def make():
        names = Pseudonyms(key)

        def step(b: pa.RecordBatch):
            old = b.column(text_col).to_pylist()
            new = [None if t is None else names.replace(t)[0] for t in old]
            at, n = b.schema.get_field_index(text_col), b.schema.get_field_index(chars_col)
            b = b.set_column(at, b.schema.field(at), pa.array(new, b.schema.field(at).type))
            chars = [c if t is None else len(t)
                     for c, t in zip(b.column(n).to_pylist(), new, strict=True)]
            return b.set_column(n, b.schema.field(n), pa.array(chars, b.schema.field(n).type))

        return step

    return arrow_rows(docs, make)


def op9_pii(spark, sf_dir: str) -> DataFrame:
    """Every document with pseudonyms, and how many values of each kind were replaced."""
    out = pseudonymised(table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{k}") for k in KINDS]
    return out.select("doc_id", "text", F.size("found").cast("long").alias("n_found"), *counts)
