"""Variant spellings of names typed by people, linked by a pigeonhole segment join.

Each reference name is written in the forms people use for it; a form that may have k typos is cut into k + 1
segments, one of which must then stand unchanged, shifted by k places at most, in any spelling of it. Names look up
their position-shifted substrings in the index of segments (with a swap of neighbours across an edge undone), and a banded edit distance verifies what it returns.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Words that say club, or nothing.
CLUB = frozenset(("fc", "afc", "cfc", "the", "club", "football", "f", "a"))
#: Words that make another team of a club's name.
OTHER_TEAM = re.compile(
    r"\b(?:women|womens|woman|ladies|lady|girls|wfc|youth|academy|reserves?|res|juniors?|colts|development|dev|legends|veterans|masters|ii|iii|iv|2nd|3rd|second|third|b|b team|under|u ?\d{1,2}s?|\d{1,2}s|jnrs?)\b"
)
#: Characters typed for others that look alike.
ALIKE = str.maketrans({"0": "o", "1": "l", "5": "s", "3": "e", "$": "s", "@": "a", "|": "l"})
_VOWELS = str.maketrans("", "", "aeiou")

EXACT, LOOSE = 0, 2
#: Places of a kind of form among the ranks, by how many letters it leaves out.
LETTERS = 20


def plain(name: str | None) -> str:
    """Lower case without accents, punctuation as blanks, single blanks."""
    text = unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", name or "")).replace("ø", "o").replace("ß", "ss").replace("ł", "l")
    text = "".join(c for c in text if not unicodedata.combining(c)).lower().replace("&", " and ").replace("'", "")
    return " ".join(re.sub(r"[^a-z0-9,]+", " ", text.translate(str.maketrans({"@": "a", "$": "s", "|": "l"}))).split())


def words_of(name: str | None) -> list[str] | None:
    """A name's words in reading order, club words off, or None for another team of a club or no name."""
    text = plain(name)
    text = re.sub(r"\ba f c\b|\bf c\b", "fc", re.sub(r"\s*,\s*", ",", text))
    if OTHER_TEAM.search(text.replace(",", " ")):
        return None
    parts = [p for p in text.split(",") if p]
    text = " ".join(reversed(parts))  # "Town, Some" is "Some Town"
    words = text.split()
    while words and words[0] in CLUB and len(words) > 1:
        words = words[1:]
    while words and words[-1] in ("fc", "afc", "cfc", "club") and len(words) > 1:
        words = words[:-1]
    return [w if w.isdigit() else w.translate(ALIKE) for w in words] or None


def abbreviations(word: str) -> set[str]:
    """What people shorten a word to, by rule: its beginnings, a beginning with the last letter, and its first letter
    with any of its other consonants in order."""
    bones = word[0] + word[1:].translate(_VOWELS)
    out = {word[:n] for n in range(1, len(word) + 1)} | {word[:n] + word[-1] for n in range(1, len(word) - 1)}
    kept = {bones[0]}
    for c in bones[1:]:
        kept |= {k + c for k in kept}
    # A lone "a" is no word's beginning but that of a second side.
    return (out | kept) - {"a"}


def forms(name: str, short_code: str | None, nickname: str | None, city: str | None) -> list[tuple[str, int, int]]:
    """(form without blanks, typos allowed, rank) of what a reference name goes by; a lower rank is believed first."""
    words = words_of(name) or []
    if not words:
        return []
    out: dict[tuple[str, int], int] = {}

    def add(form: str, typos: int, rank: int, less: int = 0) -> None:
        if len(form) >= 2:
            typos = min(typos, 0 if len(form) < 5 else 1 if len(form) < 8 else 2)
            out[form, typos] = min(rank * LETTERS + less, out.get((form, typos), 99 * LETTERS))

    whole = "".join(words)
    add(whole, LOOSE, 0)
    head, tail = words[:-1], words[-1]
    first = "".join(head)
    if head:
        thin = first[0] + first[1:].translate(_VOWELS)
        for short in abbreviations(tail):
            # The fewer letters are left out, the sooner it is that word: "cty" is city before county.
            less = min(LETTERS - 1, len(tail) - len(short))
            add(first + short, LOOSE, 0 if short == tail else 1, less)
            if len(short) > 2:
                add(short + first, LOOSE, 2, less)
            add(thin + short, EXACT, 3, less)
            for n in range(3, len(first)):
                add(first[:n] + short, EXACT, 3, less)
        add(thin + tail[0] + tail[1:].translate(_VOWELS), EXACT, 3)
        letters = "".join(w[0] for w in words)
        add(letters + "fc", EXACT, 4)
        add(letters + "afc", EXACT, 4)
        add(first, 1, 5)
        add(first[0] + first[1:].translate(_VOWELS), EXACT, 6)
    if short_code and len(short_code) > 1:
        add(plain(short_code).replace(" ", ""), EXACT, 4)
    if nickname:
        add(plain(nickname).replace(" ", ""), LOOSE, 1)
    return [(form, typos, rank) for (form, typos), rank in out.items()]


def near(a: str, b: str, most: int) -> int:
    """Edits (insert, delete, replace, swap neighbours) from a to b within a band of `most`; most + 1 if more."""
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return most + 1
    if a == b:
        return 0
    over = most + 1
    before, last = None, [j if j <= most else over for j in range(m + 1)]
    for i in range(1, n + 1):
        row = [over] * (m + 1)
        if i <= most:
            row[0] = i
        least = row[0]
        for j in range(max(1, i - most), min(m, i + most) + 1):
            cost = last[j - 1] + (a[i - 1] != b[j - 1])
            if last[j] + 1 < cost:
                cost = last[j] + 1
            if row[j - 1] + 1 < cost:
                cost = row[j - 1] + 1
            if before is not None and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1] and before[j - 2] + 1 < cost:
                cost = before[j - 2] + 1
            row[j] = cost
            if cost < least:
                least = cost
        if least > most:
            return over
        before, last = last, row
    return min(last[m], over)


def segments(form: str, typos: int) -> list[tuple[int, int]]:
    """Start and length of typos + 1 even segments."""
    parts = typos + 1
    size, longer = divmod(len(form), parts)
    out, at = [], 0
    for i in range(parts):
        n = size + (i >= parts - longer)
        out.append((at, n))
        at += n
    return out


def _signature(length: int, typos: int, part: int, text: str) -> str:
    return f"{length}.{typos}.{part}.{text}"


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = []
        for form, typos in zip(batch.column("form").to_pylist(), batch.column("typos").to_pylist()):
            got += [(_signature(len(form), typos, i, form[a : a + n]), form, typos) for i, (a, n) in enumerate(segments(form, typos))]
        yield pa.RecordBatch.from_pydict({"signature": pa.array([g[0] for g in got], pa.string()), "form": pa.array([g[1] for g in got], pa.string()), "typos": pa.array([g[2] for g in got], pa.int32())})


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each name's shifted substrings, for every length and number of typos that a form may have."""
    for batch in batches:
        names, keys, marks = [], [], []
        for name in batch.column("name").to_pylist():
            key = "".join(words_of(name) or [])
            if len(key) < 2:
                continue
            found = set()
            for typos in (0, 1, 2):
                for length in range(max(2, len(key) - typos), len(key) + typos + 1):
                    for part, (at, n) in enumerate(segments("x" * length, typos)):
                        # A segment that stands unchanged is shifted by no more than the edits left and right of it allow.
                        for shift in range(-typos, typos + 1):
                            start = at + shift
                            if 0 <= start <= len(key) - n and abs(shift) + abs(len(key) - length - shift) <= typos:
                                text = key[start : start + n]
                                found.add(_signature(length, typos, part, text))
                                # A swap across a segment's edge would spoil two segments at once: it is undone at each edge.
                                if typos and n and start + n < len(key) and part < typos:
                                    found.add(_signature(length, typos, part, text[:-1] + key[start + n]))
                                if typos and n and start and part:
                                    found.add(_signature(length, typos, part, key[start - 1] + text[1:]))
            marks += found
            names += [name] * len(found)
            keys += [key] * len(found)
        yield pa.RecordBatch.from_pydict({"name": pa.array(names, pa.string()), "key": pa.array(keys, pa.string()), "signature": pa.array(marks, pa.string())})


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = [near(k, f, t) for k, f, t in zip(batch.column("key").to_pylist(), batch.column("form").to_pylist(), batch.column("typos").to_pylist())]
        keep = pa.array([d <= t for d, t in zip(got, batch.column("typos").to_pylist())], pa.bool_())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.int32())], [*batch.schema.names, "edits"]).filter(keep)


def _forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = [(r["team_id"], *f) for r in batch.to_pylist() for f in forms(r["name"], r["short_code"], r["nickname"], r["city"])]
        yield pa.RecordBatch.from_pydict({"team_id": pa.array([g[0] for g in got], pa.string()), "form": pa.array([g[1] for g in got], pa.string()), "typos": pa.array([g[2] for g in got], pa.int32()), "rank": pa.array([g[3] for g in got], pa.int32())})


@F.pandas_udf(StringType())
def _head(name: pd.Series) -> pd.Series:
    """A name's first word and its last, each of which may be the place it is named for."""
    return pd.Series([" ".join(sorted({w[0], w[-1]})) if (w := words_of(n)) else None for n in name])


def link_names(names: DataFrame, reference: DataFrame) -> DataFrame:
    """(name, team_id, edits, rank): each distinct spelling with the one reference entry it stands for.

    names: name; reference: team_id, name, short_code, nickname, city. A spelling goes to the entry of the fewest
    edits, then of the form believed first; if two entries come out alike (initials or a city that two share), to
    none. A spelling that holds the city of one entry unchanged is not taken for a typo of another city's. Null,
    empty and wordless names, and a club's other teams, have no link; repeated names are linked once; an empty
    reference links nothing. Every spelling within the typos of a form is found: a segment join loses none.
    """
    spelled = names.where(F.col("name").isNotNull()).select("name").distinct()
    known = reference.where(F.col("name").isNotNull() & F.col("team_id").isNotNull()).select("team_id", "name", "short_code", "nickname", "city").distinct()
    form = known.mapInArrow(_forms, "team_id string, form string, typos int, rank int").groupBy("team_id", "form", "typos").agg(F.min("rank").alias("rank"))
    index = form.select("form", "typos").distinct().mapInArrow(_index, "signature string, form string, typos int")
    probe = spelled.mapInArrow(_probe, "name string, key string, signature string")
    pairs = probe.join(index, "signature").select("name", "key", "form", "typos").distinct()
    close = pairs.mapInArrow(_verify, "name string, key string, form string, typos int, edits int")
    city = F.lower(F.regexp_replace("city", "[^A-Za-z]", ""))
    match = close.join(form, ["form", "typos"]).groupBy("name", "team_id").agg(F.min(F.struct("edits", "rank")).alias("m"))
    match = match.join(known.groupBy("team_id").agg(F.first(city).alias("place")), "team_id")
    cities = known.select(city.alias("word")).where("word != ''").distinct()
    held = match.select("name").distinct().withColumn("word", F.explode(F.split(_head("name"), " "))).join(cities, "word").groupBy("name").agg(F.collect_set("word").alias("held"))
    match = match.join(held, "name", "left").where(F.col("held").isNull() | F.array_contains("held", F.col("place")))
    order = Window.partitionBy("name").orderBy("m")
    best = match.withColumn("r", F.rank().over(order)).where("r = 1").withColumn("n", F.count("*").over(Window.partitionBy("name"))).where("n = 1")
    return best.select("name", "team_id", F.col("m.edits").alias("edits"), F.col("m.rank").alias("rank"))
