"""Mixed timestamp formats and time zones: one UTC instant per text, or the reason there is none.

Each text gives an array of all valid interpretations; among those the cheapest path over a source's records in their
order is chosen (Viterbi). A path remembers the date order last read with each separator: beginning with another than
the source's usual one, switching, and jumping back in time cost. Records are spread by range; what a partition makes of
each state at its edge goes along, so the path is the same however the records are cut.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from functools import lru_cache
from zoneinfo import ZoneInfo

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronopitch.session import cut

NONEXISTENT, AMBIGUOUS = "nonexistent", "ambiguous"

#: Zone abbreviations by their offset in minutes.
ABBREVIATIONS = {
    "z": 0, "ut": 0, "utc": 0, "gmt": 0, "wet": 0, "bst": 60, "ist": 60, "west": 60, "cet": 60, "cest": 120, "mez": 60, "mesz": 120, "eet": 120, "eest": 180,
    "msk": 180, "jst": 540, "kst": 540, "est": -300, "edt": -240, "cst": -360, "cdt": -300, "mst": -420, "mdt": -360, "pst": -480, "pdt": -420,
}

#: Months by the first three letters.
MONTHS = {m: i + 1 for i, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split())}

_WEEKDAY = r"(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,?\s+)?"
_YEAR_FIRST = re.compile(r"(\d{4})([-/.])(\d{1,2})\2(\d{1,2})(?!\d)")
_COMPACT = re.compile(r"(\d{4})(\d{2})(\d{2})(?!\d)")
_DAY_NAME_YEAR = re.compile(_WEEKDAY + r"(\d{1,2})(?:st|nd|rd|th)?[\s-]+([a-z]{3})[a-z]*\.?,?[\s-]+(\d{4}|\d{2})(?!\d)")
_NAME_DAY_YEAR = re.compile(_WEEKDAY + r"([a-z]{3})[a-z]*\.?\s+(\d{1,2})(?:st|nd|rd|th)?,?\s+(\d{4}|\d{2})(?!\d)")
_NUMERIC = re.compile(_WEEKDAY + r"(\d{1,2})([-/.])(\d{1,2})\2(\d{4}|\d{2})(?!\d)")
_ZONE = r"\s*(z|[+-]\d{1,2}(?::?\d{2})?|[a-z]{2,5}|[a-z]+(?:/[a-z_+-]+)+)?"
_CLOCK = re.compile(r"(\d{1,2})[:.](\d{2})(?:[:.](\d{2})(?:[.,](\d+))?)?\s*(?:(am|pm|a\.m\.|p\.m\.)(?![a-z]))?" + _ZONE + r"$")
_PLAIN = re.compile(r"(\d{2})(\d{2})(?:(\d{2})(?:[.,](\d+))?)?()" + _ZONE + r"$")
_HOUR = re.compile(r"(\d{1,2})()()()\s*(am|pm)(?![a-z])" + _ZONE + r"$")
_EPOCH = re.compile(r"-?\d{9,11}(?:\.\d+)?$|-?\d{12,14}$|-?\d{15,17}$|-?\d{18,19}$")
_ORIGIN = datetime(1970, 1, 1)


def full_year(text: str) -> int:
    """Two-digit years lie in 1990-2089."""
    return int(text) if len(text) == 4 else int(text) + (1900 if int(text) >= 90 else 2000)


@lru_cache(512)
def _zone(name: str):
    """An offset, a named zone, or None for no known zone."""
    if name in ABBREVIATIONS:
        return timezone(timedelta(minutes=ABBREVIATIONS[name]))
    if m := re.fullmatch(r"([+-])(\d{1,2}):?(\d{2})?", name):
        minutes = int(m[2]) * 60 + int(m[3] or 0)
        return timezone(timedelta(minutes=minutes if m[1] == "+" else -minutes)) if minutes <= 18 * 60 and int(m[3] or 0) < 60 else None
    parts = "/".join("_".join(w if w in ("of", "es") else w.capitalize() for w in p.split("_")) for p in name.split("/"))
    try:
        return ZoneInfo(parts)
    except Exception:  # noqa: BLE001 - no such zone
        return None


@lru_cache(512)
def home_zone(name: str | None):
    try:
        return ZoneInfo(name or "UTC")
    except Exception:  # noqa: BLE001 - no such zone
        return timezone.utc


def dates(text: str, orders: tuple[str, ...]) -> list[tuple[str, int, int, int, int]]:
    """All readings of a date at the start of the text: (format, year, month, day, end)."""
    if m := _YEAR_FIRST.match(text):
        return [("ymd", int(m[1]), int(m[3]), int(m[4]), m.end())]
    if m := _NUMERIC.match(text):
        a, b, y = int(m[1]), int(m[3]), full_year(m[4])
        return [(f"{o}{m[2]}", y, *((b, a) if o == "dmy" else (a, b)), m.end()) for o in orders]
    if m := _DAY_NAME_YEAR.match(text):
        return [("d-name-y", full_year(m[3]), MONTHS.get(m[2], 0), int(m[1]), m.end())]
    if m := _NAME_DAY_YEAR.match(text):
        return [("name-d-y", full_year(m[3]), MONTHS.get(m[1], 0), int(m[2]), m.end())]
    if m := _COMPACT.match(text):
        return [("compact", int(m[1]), int(m[2]), int(m[3]), m.end())]
    return []


def clock(text: str):
    """(hour, minute, second, microsecond, zone or None), or None if it is no time of day; digits beyond six are cut off."""
    m = _CLOCK.match(text) or _PLAIN.match(text) or _HOUR.match(text)
    if not m:
        return None
    hour, minute, second = int(m[1]), int(m[2] or 0), int(m[3] or 0)
    half = (m[5] or "").replace(".", "")
    if half:
        if not 1 <= hour <= 12:
            return None
        hour = hour % 12 + (12 if half == "pm" else 0)
    if hour > 23 or minute > 59 or second > 59:
        return None
    zone = None
    if m[6] and (zone := _zone(m[6])) is None:
        return None
    return hour, minute, second, int((m[4] or "")[:6].ljust(6, "0")), zone


def instant(local: datetime, zone) -> tuple[int, str | None]:
    """Microseconds of UTC, and `nonexistent` or `ambiguous` where the local reading is none or two."""
    if isinstance(zone, timezone):
        return (local - zone.utcoffset(None) - _ORIGIN) // timedelta(microseconds=1), None
    one, two = (local.replace(tzinfo=zone, fold=f).utcoffset() for f in (0, 1))
    at = (local - one - _ORIGIN) // timedelta(microseconds=1)
    if one == two:
        return at, None
    return at, AMBIGUOUS if one > two else NONEXISTENT


#: The separators of all-numeric dates, and the orders that each may be read in.
SEPARATORS = "/-."
BOTH = {by: ("dmy", "mdy") for by in SEPARATORS}


def readings(text: str | None, time: str | None, zone, orders: dict[str, tuple[str, ...]] = BOTH) -> list[tuple[str, int, str | None]]:
    """All valid interpretations of a text, or of a date's and a time's: (format, micros, reason there is no instant).

    orders gives the date orders to try by separator. Texts that hold no date and time of day give none.
    """
    if text is None:
        return []
    text = re.sub(r"[\s  ]+", " ", text).strip().lower()
    if time is None and _EPOCH.match(text):
        whole, _, part = text.partition(".")
        digits = len(whole.lstrip("-"))
        scale = 6 if digits <= 11 else 3 if digits <= 14 else 0 if digits <= 17 else -3
        micros = int(whole) * 10**scale + int(part[:6].ljust(6, "0")) if scale >= 0 else int(whole) // 1000
        return [(f"epoch{scale}", micros, None)]
    found = []
    numeric = _NUMERIC.match(text)
    for form, y, m, d, end in dates(text, orders.get(numeric[2], ("dmy",)) if numeric else ("dmy",)):
        rest = text[end:] if time is None else time
        at = clock(re.sub(r"[\s  ]+", " ", rest).strip().lower() if time is not None else rest.lstrip("t ,"))
        if at is None or (time is not None and text[end:].strip()):
            continue
        try:
            local = datetime(y, m, d, *at[:4])
            micros, reason = instant(local, at[4] or zone)
        except (ValueError, OverflowError):
            continue
        found.append((form, micros, reason))
    return list(dict.fromkeys(found))


def utc_text(micros: int) -> str:
    return (_ORIGIN + timedelta(microseconds=micros)).strftime("%Y-%m-%dT%H:%M:%S.%fZ").rjust(27, "0")


#: Costs of the path: for each separator to begin with another order than the source's usual one, to switch the order
#: read with a separator, and per doubling of the hours of a jump back in time.
START, SWITCH, BACK = 3.0, 8.0, 0.25

#: A state is a set of separators (by bit) that are read month first.
STATES = np.arange(1 << len(SEPARATORS))
_BIT = {f"{order}{by}": (i, order == "mdy") for i, by in enumerate(SEPARATORS) for order in ("dmy", "mdy")}
#: Readings of one text: an all-numeric date has two, everything else one.
MOST = 2


def beginning(order: str) -> np.ndarray:
    """Cost of each state where a source begins, by its usual order."""
    usual = len(STATES) - 1 if order == "mdy" else 0
    return START * np.array([int(s ^ usual).bit_count() for s in STATES], float)


def _step(cost: np.ndarray, before: list[tuple] | None, now: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One record on. cost: [..., state, reading before]; returns the costs [..., state, reading now] and, for each, the
    state and the reading that it comes from at the least cost."""
    shape = (*cost.shape[:-1], len(now))
    out, from_state, from_reading = np.full(shape, np.inf), np.zeros(shape, np.int8), np.zeros(shape, np.int8)
    for j, (form, micros, _) in enumerate(now):
        jump = [BACK * np.log2(1 + max(0, b[1] - micros) / 3.6e9) for b in before] if before else [0.0]
        by_reading = cost + np.array(jump)
        best = by_reading.argmin(-1)
        least = np.take_along_axis(by_reading, best[..., None], -1)[..., 0]
        if form in _BIT:
            i, month_first = _BIT[form]
            same = STATES[(STATES >> i & 1) == month_first]
            other = same ^ (1 << i)
            stay, turn = least[..., same], least[..., other] + SWITCH
            out[..., same, j] = np.minimum(stay, turn)
            from_state[..., same, j] = np.where(turn < stay, other, same)
        else:
            out[..., j] = least
            from_state[..., j] = STATES
        from_reading[..., j] = np.take_along_axis(best, from_state[..., j].astype(np.int64), -1)
    return out, from_state, from_reading


def _plain(before: list[tuple] | None, now: list[tuple]) -> bool:
    """Whether a record moves every path alike, so that nothing is to be weighed."""
    return before is not None and len(before) == 1 and len(now) == 1 and now[0][0] not in _BIT


def decide(records: list[list[tuple]], start: np.ndarray, first: int | None = None, end: tuple[int, int] | None = None) -> list[int]:
    """Viterbi over readable records in order: which reading of each lies on the cheapest path.

    start: cost of each state before the first record; first: its reading, and end: the last record's state and
    reading, where neighbours have settled them. Ties go to the earlier reading.
    """
    cost, before, trail = start[:, None], None, []
    for n, now in enumerate(records):
        if _plain(before, now):
            trail.append(None)
        else:
            cost, states, back = _step(cost, before, now)
            if n == 0 and first is not None:
                cost[:, [j for j in range(len(now)) if j != first]] = np.inf
            trail.append((states, back))
        before = now
    if not records:
        return []
    state, reading = end if end is not None else np.unravel_index(int(cost.argmin()), cost.shape)
    chosen = []
    for step in reversed(trail):
        chosen.append(int(reading))
        if step is None:
            reading = 0
        else:
            state, reading = int(step[0][state, reading]), int(step[1][state, reading])
    return chosen[::-1]


def transfer(records: list[list[tuple]]) -> np.ndarray:
    """The least cost from each state before and reading of the first record to each state and reading of the last:
    [state, reading, state, reading]."""
    size = len(STATES)
    cost = np.full((size, MOST, size, 1), np.inf)
    cost[STATES, :, STATES, 0] = 0.0
    before = None
    for n, now in enumerate(records):
        if not _plain(before, now):
            cost, _, _ = _step(cost, before, now)
        if n == 0:
            for f in range(MOST):
                cost[:, f, :, [j for j in range(len(now)) if j != f]] = np.inf
        before = now
    return np.pad(cost, [(0, 0)] * 3 + [(0, MOST - cost.shape[-1])], constant_values=np.inf)


def settle(runs: list[tuple[list, list, np.ndarray]], start: np.ndarray) -> list[tuple[int, int, int, int]]:
    """The cheapest path over the pieces of one source in order, each given by its first and last readings and its
    `transfer`: per piece the state before it, its first reading, and its last state and reading."""
    ahead, trail, last = start[:, None], [], None
    for first, end, through in runs:
        jump = np.zeros((ahead.shape[-1], MOST))
        for j, now in enumerate(first):
            for l, b in enumerate(last or []):  # noqa: E741
                jump[l, j] = BACK * np.log2(1 + max(0, b[1] - now[1]) / 3.6e9)
        # [state, reading before] and [reading before, first reading] to [state, first reading]
        into = ahead[:, :, None] + jump[None]
        from_reading = into.argmin(1)
        into = into.min(1)
        whole = into[:, :, None, None] + through
        flat = whole.reshape(-1, *whole.shape[2:])
        best = flat.argmin(0)
        trail.append((best, from_reading))
        ahead, last = flat.min(0), end
    state, reading = np.unravel_index(int(ahead.argmin()), ahead.shape) if runs else (0, 0)
    out = []
    for best, from_reading in reversed(trail):
        entry, first = divmod(int(best[state, reading]), MOST)
        out.append((entry, first, int(state), int(reading)))
        state, reading = entry, int(from_reading[entry, first])
    return out[::-1]


_READ = "row_key string, source string, part int, forms array<string>, micros array<long>, reasons array<string>"
_EDGE = "source string, part int, first_forms array<string>, first_micros array<long>, last_forms array<string>, last_micros array<long>, through array<double>"


def _interpret(zones: dict[str, str]):
    """All readings of each text, as arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part = context.partitionId() if context else 0
        for batch in batches:
            got = [readings(text, time, home_zone(zones.get(src or "", "UTC"))) for src, text, time in zip(*(batch.column(c).to_pylist() for c in ("source", "text", "time")))]
            columns = [pa.array([[o[i] for o in row] for row in got], pa.list_(t)) for i, t in enumerate((pa.string(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column("row_key"), batch.column("source"), pa.array([part] * len(got), pa.int32()), *columns], ["row_key", "source", "part", "forms", "micros", "reasons"])

    return run


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, str | None, list[list[tuple]], list]]:
    """The records of a partition by part and source: (part, source, readings of each, row keys)."""
    at, records, keys = None, [], []
    for batch in batches:
        for key, source, part, *read in zip(*(batch.column(i).to_pylist() for i in range(6))):
            if (part, source) != at:
                if at is not None:
                    yield *at, records, keys
                at, records, keys = (part, source), [], []
            records.append(list(zip(*read)))
            keys.append(key)
    if at is not None:
        yield *at, records, keys


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a partition makes of its first and its last source, which may go on beyond it; those within need nothing."""
    first = last = None
    for part, source, records, _ in _runs(batches):
        run = (part, source, [r for r in records if r])
        if first is None:
            first = run
        else:
            last = run
    rows = [(s, p, r[0], r[-1], transfer(r)) for p, s, r in filter(None, (first, last)) if r]
    pick = lambda k, i: [[o[i] for o in row[k]] for row in rows]
    values = [[r[0] for r in rows], [r[1] for r in rows], pick(2, 0), pick(2, 1), pick(3, 0), pick(3, 1), [np.minimum(r[4], 1e300).ravel().tolist() for r in rows]]
    texts, longs = pa.list_(pa.string()), pa.list_(pa.int64())
    kinds = (pa.string(), pa.int32(), texts, longs, texts, longs, pa.list_(pa.float64()))
    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], ["source", "part", "first_forms", "first_micros", "last_forms", "last_micros", "through"])


def _choose(orders: dict[str, str], settled: dict[tuple[int, str | None], tuple[int, int, int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, source, records, keys in _runs(batches):
            start, first, end = beginning(orders.get(source or "", "dmy")), None, None
            if (part, source) in settled:
                entry, first, *end = settled[part, source]
                start = np.where(STATES == entry, 0.0, np.inf)
            chosen = iter(decide([r for r in records if r], start, first, tuple(end) if end else None))
            got = [r[next(chosen)] if r else None for r in records]
            for at in range(0, len(got), 10_000):
                own = got[at : at + 10_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[at : at + 10_000], pa.string()), pa.array([o and (o[2] or utc_text(o[1])) for o in own], pa.string()),
                        pa.array([o and o[0] for o in own], pa.string()),
                    ],
                    ["row_key", "utc_text", "format"],
                )

    return run


#: Most sources of a manifest, which the driver takes.
SOURCES = 10_000


def to_utc(rows: DataFrame, manifest: DataFrame) -> DataFrame:
    """(row_key, utc_text, format): the instant of each text as yyyy-MM-ddTHH:mm:ss.SSSSSSZ, `nonexistent` or
    `ambiguous` where the local reading stands for no or for two instants, or null where the text is not readable.

    rows: row_key string, source string, text string, time string (null where the text holds the time of day), place
    (orders a source's records). Texts without a zone are in the manifest's zone of their source, UTC for sources not
    listed; the manifest's date order is the one a source begins with, day first for sources not listed. Null, empty
    and unreadable texts, impossible dates and times give null. Rows are range-partitioned by source and place, so a
    source of any size is spread; the path of a source that goes through several partitions is settled from what each
    makes of its edges (256 numbers for two runs a partition, all that reaches the driver). More than SOURCES sources
    in the manifest are an error.
    """
    listed = manifest.select("source", "source_timezone", "date_order").limit(SOURCES + 1).collect()
    if len(listed) > SOURCES:
        raise ValueError(f"more than {SOURCES} sources in the manifest")
    zones, orders = ({r["source"]: r[c] for r in listed} for c in ("source_timezone", "date_order"))
    line = rows.select("row_key", "source", "text", "time", "place").repartitionByRange("source", "place", "row_key")
    line = line.sortWithinPartitions("source", "place", "row_key").select("row_key", "source", "text", "time")
    read = cut(line.mapInArrow(_interpret(zones), _READ))
    pieces: dict[str | None, list] = {}
    for e in read.mapInArrow(_edges, _EDGE).collect():
        through = np.array(e["through"]).reshape(len(STATES), MOST, len(STATES), MOST)
        own = ([(f, m, None) for f, m in zip(e[f"{side}_forms"], e[f"{side}_micros"])] for side in ("first", "last"))
        pieces.setdefault(e["source"], []).append((e["part"], *own, np.where(through >= 1e300, np.inf, through)))
    settled = {}
    for source, own in pieces.items():
        own.sort(key=lambda x: x[0])
        if len(own) > 1:
            path = settle([o[1:] for o in own], beginning(orders.get(source or "", "dmy")))
            settled |= {(o[0], source): p for o, p in zip(own, path)}
    return read.mapInArrow(_choose(orders, settled), "row_key string, utc_text string, format string")
