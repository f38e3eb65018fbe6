"""Scalar column helpers (all built-in, JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketstream.schemas import DEC, EXCHANGE, SYMBOLS


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dec(c: Column | str) -> Column:
    """decimal from a wire string (or number); null when unparsable."""
    return col(c).try_cast(DEC)


def number_text(c: Column | str) -> Column:
    """a decimal as the text of a JSON number or key: plain digits without trailing zeros,
    at least one after the point."""
    plain = F.regexp_replace(col(c).cast(DEC).cast("string"), "0+$", "")
    return F.regexp_replace(plain, r"\.$", ".0")


def parse_time(c: Column | str) -> Column:
    """ISO-8601 (``...Z``) to TIMESTAMP; null when absent or unparsable."""
    return F.try_to_timestamp(col(c))


def to_ns(ts: Column | str) -> Column:
    """TIMESTAMP to integer nanoseconds since the epoch, exact (no float step)."""
    return F.unix_micros(col(ts).cast("timestamp")) * F.lit(1000)


def iso_time(ts: Column | str) -> Column:
    """TIMESTAMP to the venue's ISO-8601 text (UTC, microseconds, ``Z``)."""
    return F.date_format(col(ts).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def event_ts_ns(time_text: Column | str, receipt: Column | str) -> Column:
    """P5: event time in ns, or the receipt time when the event time is absent or 0."""
    t = to_ns(parse_time(time_text))
    return F.coalesce(F.nullif(t, F.lit(0)), to_ns(receipt))


def taker_side(maker_side: Column | str) -> Column:
    """The trade side is the taker's, the opposite of the maker side on the message."""
    return F.when(col(maker_side) == "buy", F.lit("sell")).otherwise(F.lit("buy"))


def book_side(side: Column | str) -> Column:
    """P17 (orders): ``sell`` rests on the ask, anything else on the bid."""
    return F.when(col(side) == "sell", F.lit("ask")).otherwise(F.lit("bid"))


def l2_side(side: Column | str) -> Column:
    """P17 (level-2 changes): ``buy`` is the bid, anything else the ask."""
    return F.when(col(side) == "buy", F.lit("bid")).otherwise(F.lit("ask"))


def symbol_of(n: Column | str) -> Column:
    """Symbol number 0..3 -> product id, as in the derived feeds."""
    return F.element_at(F.array(*[F.lit(s) for s in SYMBOLS]), (col(n) % 4 + 1).cast("int"))


def exchange() -> Column:
    return F.lit(EXCHANGE)


def split_product(product_id: Column | str) -> tuple[Column, Column, Column]:
    """``BASE-QUOTE`` -> (base, quote, ok); ok is false unless exactly two parts."""
    parts = F.split(col(product_id), "-")
    ok = F.size(parts) == 2
    return parts.getItem(0), parts.getItem(1), ok
