"""Scalar normalisation as Column expressions: everything here stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def slug(name: Column) -> Column:
    """Lower case, & as and, runs of anything else as one dash; nothing left is `unknown`."""
    dashed = F.regexp_replace(F.replace(F.lower(name), F.lit("&"), F.lit("and")), "[^a-z0-9]+", "-")
    return F.regexp_replace(F.regexp_replace(dashed, "^-+|-+$", ""), "^$", "unknown")


#: Words of a club's name that do not tell it from another, and those that part two sides of a match.
CLUB_WORDS = ("afc", "fc", "cf", "sc", "and")
VERSUS_WORDS = ("v", "vs")


def name_key(name: Column, without: tuple[str, ...] = CLUB_WORDS) -> Column:
    """The words of a name without club words, one blank between; repeated words stay."""
    words = F.regexp_extract_all(F.lower(name), F.lit("([a-z0-9]+)"), F.lit(1))
    return F.array_join(F.filter(words, lambda w: ~w.isin(*without)), " ")


def season_start(at: Column) -> Column:
    """The year a season starts in: seasons turn in July."""
    return F.year(at) - (F.month(at) < 7).cast("int")


def season_label(start: Column) -> Column:
    """2024 as 2024/25."""
    return F.format_string("%d/%02d", start, F.pmod(start + 1, F.lit(100)))


def season_from_code(code: Column) -> Column:
    """The label of a season code: 9394 or 2425, 2024/2025, 2024-25 or a start year; null for anything else."""
    two = F.regexp_extract(code, r"^(\d{2})(\d{2})$", 1).try_cast("int")
    short = F.when(two >= 90, two + 1900).otherwise(two + 2000)
    runs = F.pmod(two + 1, F.lit(100)) == F.regexp_extract(code, r"^(\d{2})(\d{2})$", 2).try_cast("int")
    long = F.regexp_extract(code, r"^((?:19|20)\d{2})(?:[-/]\d{2}(?:\d{2})?)?$", 1).try_cast("int")
    return season_label(F.coalesce(F.when(runs, short), long))


def same_season(a: Column, b: Column) -> Column:
    """Whether two season texts may be one season; a missing one never excludes."""
    return a.isNull() | b.isNull() | (season_from_code(a) == season_from_code(b))


def season_codes(first: int, until: Column) -> Column:
    """Four-digit codes of the seasons from `first` that were complete at `until`."""
    last = season_start(until) - 1
    two = lambda y: F.lpad(F.pmod(y, F.lit(100)).cast("string"), 2, "0")
    return F.transform(F.when(last >= first, F.sequence(F.lit(first), last)).otherwise(F.array().cast("array<int>")), lambda y: F.concat(two(y), two(y + 1)))


def match_date(text: Column) -> Column:
    """dd/MM/yyyy or dd/MM/yy; a two-digit year of 69 or more is of the century before."""
    long = F.try_to_timestamp(F.when(text.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), text), F.lit("d/M/yyyy"))
    short = F.try_to_timestamp(F.when(text.rlike(r"^\d{1,2}/\d{1,2}/\d{2}$"), text), F.lit("d/M/yy"))
    day = F.coalesce(long, short).cast("date")
    return F.when(F.year(day) >= 2069, F.add_months(day, -1200)).otherwise(day)


def wall_clock(local: Column, zone: str) -> tuple[Column, Column, Column]:
    """(UTC instant, no such reading, two such readings) of a zone's wall clock, all as timestamp without zone.

    A reading in the gap does not come back from UTC as it went; one in the fold comes back from an hour off as well.
    """
    hour = F.expr("INTERVAL 1 HOUR")
    plain = local.cast("timestamp")
    utc = F.to_utc_timestamp(plain, zone)
    back = lambda at: F.from_utc_timestamp(at, zone)
    gap = back(utc) != plain
    fold = ~gap & ((back(utc + hour) == plain) | (back(utc - hour) == plain))
    return F.when(~gap & ~fold, utc).cast("timestamp_ntz"), gap, fold


def safe_int(text: Column) -> Column:
    """2 and 2.0 as 2; blanks, words and fractions of a number as null or cut towards zero."""
    number = F.trim(text).try_cast("double")
    return F.when(~F.isnan(number), number).cast("bigint")


def status_family(status: Column) -> Column:
    """A source's status text by its family."""
    s = F.lower(F.coalesce(status, F.lit("")))
    has = lambda *words: F.coalesce(s.rlike("|".join(words)), F.lit(False))
    return (
        F.when(has("postpon"), "postponed").when(has("cancel", "abandon"), "cancelled").when(has("final", "finished", "full_time", "complete", "ended", "^f$"), "finished")
        .when(has("delay"), "delayed").when(has("progress", "live", "half", "^p$"), "live").when(has("schedul", "not_?started", "pre", "^o$"), "scheduled").otherwise("unknown")
    )


def outcome(home: Column, away: Column) -> Column:
    return F.when(home > away, "HOME").when(home == away, "DRAW").when(home < away, "AWAY")


def failure_class(status: Column, error: Column, parser: Column, mapping: Column, empty: Column) -> Column:
    """The boundary at which a request stopped, by precedence: mapping, parser, empty body, HTTP status, error text."""
    e = F.lower(F.coalesce(error, F.lit("")))
    has = lambda *words: e.rlike("|".join(words))
    return (
        F.when(mapping, "provider_mapping_missing").when(parser, "parser_schema_drift").when(empty, "empty_response")
        .when(status == 429, "http_429").when(status.between(400, 499), "http_4xx").when(status >= 500, "http_5xx").when(status.isNotNull(), "unknown")
        .when(error.isNull(), "unknown").when(has("name or service not known", "getaddrinfo"), "dns_failure").when(has("ssl", "certificate verify", "tls"), "tls_failure")
        .when(has("proxy", "tunnel connection failed"), "proxy_failure").when(has("timed out", "timeout"), "timeout").when(has("connection"), "tcp_connect_failure")
        .otherwise("transport_library_failure")
    )


def freshness(kickoff: Column, last_success: Column, now: Column, live: Column) -> Column:
    """How fresh what is known of a fixture is, by the time left to its kick-off; a cache may be four times as old."""
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    hour = 3_600_000_000
    age = F.greatest(F.lit(0), micros(now) - micros(last_success))
    left = micros(kickoff) - micros(now)
    limit = F.when(left <= hour, hour // 2).when(left <= 6 * hour, 2 * hour).when(left <= 24 * hour, 6 * hour).otherwise(24 * hour)
    return F.when(last_success.isNull(), "UNKNOWN").when(age <= limit, "FRESH").when(~live & (left > hour) & (age <= limit * 4), "ACCEPTABLE_CACHE").otherwise("STALE")


def population(*ids: Column, probe: Column, kind: Column | None = None) -> Column:
    """Which population rows belong to; probes and ids that say smoke are never mixed with others."""
    smoke = probe
    for c in ids:
        text = F.lower(F.coalesce(c, F.lit("")))
        smoke = smoke | text.startswith("smoke") | text.startswith("test-smoke") | text.contains(":smoke:")
    return F.when(F.coalesce(smoke, F.lit(False)), "test_smoke").otherwise(F.coalesce(kind, F.lit("prospective_true_pit")) if kind is not None else F.lit("prospective_true_pit"))


#: Seconds before kick-off of the fixed horizons, in order, and other ways to write them.
HORIZONS = {"t-72h": 259_200, "t-24h": 86_400, "t-6h": 21_600, "t-1h": 3_600, "t-15m": 900}


def horizon(text: Column) -> Column:
    """A horizon in its one written form; null for no horizon."""
    plain = F.replace(F.lower(F.trim(text)), F.lit("_"), F.lit("-"))
    plain = F.when(plain.isin("fixture-first-observed", "first-observed"), "fixture_first_observed").otherwise(F.regexp_replace(plain, r"^t?-?(72h|24h|6h|1h|15m)$", "t-$1"))
    return F.when(plain.isin(*HORIZONS, "event", "fixture_first_observed"), plain)


def evidence_union(*lists: Column) -> Column:
    """Ids of several lists, each once, in order."""
    return F.array_sort(F.array_distinct(F.filter(F.concat(*(F.coalesce(x, F.array().cast("array<string>")) for x in lists)), lambda i: i.isNotNull())))


def content_id(prefix: str, *columns: Column, length: int = 32) -> Column:
    """An id by content: equal columns, equal id. Nulls and blanks differ."""
    parts = [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-")) for c in columns]
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("\x1f", *parts), 256), 1, length))


def redacted(url: Column) -> Column:
    """A URL without the values of keys and tokens."""
    return F.regexp_replace(url, r"(?i)([?&](?:api_?key|key|token|secret|password)=)[^&#]*", "$1***")
