"""Newest row of a group by hash aggregation.

``max(struct(time, emission, values))`` picks the newest row exactly, but a struct can't be updated
in place, so Spark sorts every raw row to aggregate it. Here time and emission are packed into one
long that keeps their order, and ``max_by`` of each value by that long is a plain hash aggregate.

The packed key of a row in a span of time (a bucket) has, from the high bits down:

* the time since the span's start, in microseconds, in as many bits as the span needs;
* the emission delay (emission - time) in the remaining bits: a lower half in microseconds, from
  ``EARLY_US`` before the time on, and an upper half in seconds for longer delays.

So equal times are told apart by emission to the microsecond while the delay fits the lower half
(for a 15-minute span, 53 minutes), and to the second beyond. A missing emission is the oldest.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_BITS = 63
#: An emission may lie this long before its row's time (a quarter of the lower half at most).
EARLY_US = 1 << 30
SECOND_US = 1_000_000


def _delay_bits(span_us: int) -> int:
    bits = KEY_BITS - max(1, (span_us - 1).bit_length())
    if bits < 12:
        raise ValueError("the span is too long for a packed key")
    return bits


def newest_key(time_us: Column, emitted_us: Column, start_us: Column, span_us: int) -> Column:
    """Long that orders the rows of ``[start, start + span)`` by (time, emission)."""
    bits = _delay_bits(span_us)
    half = 1 << (bits - 1)
    early = min(EARLY_US, half // 4)
    delay = emitted_us - time_us + F.lit(early)
    late = F.least(F.lit(half) + F.floor((delay - F.lit(half)) / F.lit(SECOND_US)), F.lit(2 * half - 1))
    code = F.when(emitted_us.isNull() | (delay < 0), F.lit(0)).when(delay < F.lit(half), delay).otherwise(late)
    return F.shiftleft(time_us - start_us, bits) + code.cast("long")


def key_time(key: Column, start_us: Column, span_us: int) -> Column:
    """The time (micros) of a packed key."""
    return start_us + F.shiftright(key, _delay_bits(span_us))


def newest_aggs(key: Column, values: dict[str, Column], prefix: str, cond: Column | None = None) -> list[Column]:
    """Aggregates that :func:`newest_record` puts together: the largest key of the rows that match
    ``cond``, and each value of that row (its NULLs too)."""
    k = key if cond is None else F.when(cond, key)
    return [F.max(k).alias(f"{prefix}_key"), *(F.max_by(v, k).alias(f"{prefix}_{n}") for n, v in values.items())]


def newest_record(prefix: str, names: tuple[str, ...], start_us: Column, span_us: int) -> Column:
    """The newest row as a struct (``ts``, then ``names``), NULL for a group without one."""
    key = F.col(f"{prefix}_key")
    rec = F.struct(key_time(key, start_us, span_us).alias("ts"), *(F.col(f"{prefix}_{n}").alias(n) for n in names))
    return F.when(key.isNotNull(), rec)
