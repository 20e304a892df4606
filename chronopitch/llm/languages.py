"""Missing or wrong language labels: the language of each document and of each segment of it.

A bit-sliced Bloom filter holds the letter n-grams of every language at once: each slot is a mask with one bit per
language, and the masks of an n-gram's slots, and-ed, name all languages that have it. A run of text counts the bits
of its n-grams by language; the counts, less what the filter's fill explains, decide.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from chronopitch.session import cut

#: Two-letter codes of languages, with their three-letter codes and names.
NAMES = {
    "en": "eng english", "de": "deu ger german deutsch", "fr": "fra fre french francais", "es": "spa spanish espanol castellano", "it": "ita italian italiano",
    "nl": "nld dut dutch nederlands", "pt": "por portuguese portugues", "sv": "swe swedish svenska", "pl": "pol polish polski", "da": "dan danish dansk", "no": "nor nob nno nb nn norwegian norsk",
    "fi": "fin finnish suomi", "cs": "ces cze czech cesky", "sk": "slk slo slovak", "hu": "hun hungarian magyar", "ro": "ron rum romanian", "tr": "tur turkish turkce", "el": "ell gre greek",
    "ru": "rus russian", "uk": "ukr ukrainian", "bg": "bul bulgarian", "hr": "hrv croatian", "sr": "srp serbian", "sl": "slv slovenian", "et": "est estonian", "lv": "lav latvian",
    "lt": "lit lithuanian", "ca": "cat catalan", "eu": "eus baq basque", "gl": "glg galician", "ga": "gle irish", "cy": "cym wel welsh", "is": "isl ice icelandic", "ja": "jpn japanese",
    "zh": "zho chi chinese", "ko": "kor korean", "ar": "ara arabic", "he": "heb hebrew", "hi": "hin hindi", "fa": "fas per persian", "vi": "vie vietnamese", "id": "ind indonesian",
}
_CODE = {alias: code for code, aliases in NAMES.items() for alias in (code, *aliases.split())}

#: What the fit takes: documents per label, by the hash of their id. Everything else takes all documents.
LABELLED = 600
#: A language has an n-gram if its documents have it at this share of the rate of the language that has it most.
SHARE = 0.25
#: Slots of the filter and hashes of an n-gram.
SLOTS, HASHES = 1 << 21, 2
#: Evidence of one more n-gram that a language has, of a change of language, and the least of a segment of its own.
HIT, SWITCH, APART = 1.2, 9.0, 9.0
#: Documents that an n-gram or a label must be in to count for a language.
SEEN = 2
#: Documents, letters and cached words that are held at a time.
DOCS, LETTERS, WORDS = 512, 4_000_000, 300_000

_UNIT = re.compile(r"&#?\w+;|https?://\S+|[.!?…:;]+(?=\s|$|[\"“”„«»'()\]])|[\r\n]+|[\"“”„«»()\[\]|]+|\s[–—/-]+(?=\s|$)|\s+/\s*|<[^<>]*>|\{[^{}]*\}")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")


def label_code(label: str | None) -> str | None:
    """The two-letter code that a label names in any written form, or None if it names no language."""
    text = unicodedata.normalize("NFKD", label or "").lower()
    text = "".join(c for c in text if not unicodedata.combining(c)).strip()
    return _CODE.get(text) or _CODE.get(re.split(r"[-_ ]", text)[0] if text else "")


def folded(text: str) -> str:
    """Lower case, accents off: texts typed without them are the same language."""
    text = unicodedata.normalize("NFKD", text.replace("ß", "ss").replace("ł", "l").replace("Ł", "l")).lower()
    return "".join(c for c in text if not unicodedata.combining(c)).replace("’", "'")


def words_by_unit(text: str) -> list[tuple[int, int, list[str]]]:
    """Start, end and words, as typed, of the pieces between sentence ends, line ends, quotes, brackets, lone dashes and markup."""
    out, at = [], 0
    edges = [m.span() for m in _UNIT.finditer(text)]
    for a, b in [*edges, (len(text), len(text))]:
        if a > at and (words := [w for w in _WORD.findall(text, at, a) if w[0].isalpha() and w[-1].isalpha()]):
            out.append((at, a, words))
        at = b
    return out


_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(place of the word, 64-bit hash) of each n-gram of each word: three and four letters with the word's edges, and
    the word itself. Each n-gram of a word once: a run of one letter or syllable says no more for being long."""
    import xxhash

    codes = np.frombuffer("".join(f"_{w}_" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.array([len(w) + 2 for w in words], np.int64)
    word = np.repeat(np.arange(len(words)), lengths)
    end = np.repeat(np.cumsum(lengths), lengths)
    at, where, hashes = np.arange(len(codes)), [np.arange(len(words))], [np.array([xxhash.xxh64_intdigest(f"={w}".encode("utf-8", "surrogatepass")) for w in words], np.uint64)]
    for n in (3, 4):
        start = np.flatnonzero(at + n <= end)
        h = np.full(len(start), n, np.uint64)
        for i in range(n):
            h = (h ^ codes[start + i]) * _MIX[0]
            h ^= h >> np.uint64(29)
        h = (h ^ (h >> np.uint64(30))) * _MIX[1]
        h = (h ^ (h >> np.uint64(27))) * _MIX[2]
        where.append(word[start])
        hashes.append(h ^ (h >> np.uint64(31)))
    where, hashes = np.concatenate(where), np.concatenate(hashes)
    order = np.lexsort((hashes, where))
    where, hashes = where[order], hashes[order]
    new = np.r_[True, (np.diff(where) != 0) | (np.diff(hashes) != 0)] if len(where) else np.zeros(0, bool)
    return where[new], hashes[new]


def slots(hashes: np.ndarray) -> list[np.ndarray]:
    """The slots of each hash."""
    return [((hashes >> np.uint64(24 * i)) % np.uint64(SLOTS)).astype(np.int64) for i in range(HASHES)]


@dataclass
class Filter:
    """The bit-sliced filter: a mask of languages per slot, and how full each language's slice is."""

    languages: list[str]
    masks: np.ndarray
    fill: list[float]

    def __post_init__(self) -> None:
        self._forget()

    def _forget(self) -> None:
        self._row: dict[str, int] = {}
        self._counts = np.zeros((0, len(self.languages) + 1), np.int32)

    def counts(self, words: list[str]) -> np.ndarray:
        """A row a word: how many of its n-grams any language has, then how many each has. Bits are counted by slice."""
        if len(self._row) > WORDS:
            self._forget()
        new = list(dict.fromkeys(w for w in words if w not in self._row))
        if new:
            where, hashes = grams(new)
            mask = np.full(len(hashes), np.iinfo(np.uint64).max, np.uint64)
            for slot in slots(hashes):
                mask &= self.masks[slot]
            where, mask = where[mask != 0], mask[mask != 0]
            slices = [np.bincount(where, minlength=len(new))]
            slices += [np.bincount(where[(mask >> np.uint64(k)) & np.uint64(1) == 1], minlength=len(new)) for k in range(len(self.languages))]
            self._row.update(zip(new, range(len(self._counts), len(self._counts) + len(new))))
            self._counts = np.concatenate([self._counts, np.stack(slices, 1).astype(np.int32)])
        return self._counts[[self._row[w] for w in words]]

    def evidence(self, seen: np.ndarray) -> np.ndarray:
        """Per language, the log odds of the n-grams it has of those seen, corrected for the filter's false positives."""
        false = np.array(self.fill) ** HASHES
        return HIT * np.maximum(0.0, (seen[:, 1:] - seen[:, :1] * false) / (1 - false))


def build_filter(grams_: np.ndarray, rates: np.ndarray, languages: list[str]) -> Filter:
    """The filter of the n-grams (hashes) that each language has, by their rates (a column a language) in its documents."""
    masks = np.zeros(SLOTS, np.uint64)
    has = (rates > 0) & (rates >= SHARE * rates.max(axis=1, keepdims=True, initial=0.0))
    bits = np.zeros(len(grams_), np.uint64)
    for k in range(len(languages)):
        bits |= has[:, k].astype(np.uint64) << np.uint64(k)
    for slot in slots(grams_):
        np.bitwise_or.at(masks, slot, bits)
    fill = [float(((masks >> np.uint64(k)) & np.uint64(1)).mean()) for k in range(len(languages))]
    return Filter(languages, masks, fill)


def _some(rows: list[tuple]) -> Iterator[list[tuple]]:
    """Rows (text first) in lots of at most DOCS, and of about LETTERS letters."""
    own, size = [], 0
    for row in rows:
        if own and (len(own) >= DOCS or size + len(row[0] or "") > LETTERS):
            yield own
            own, size = [], 0
        own.append(row)
        size += len(row[0] or "")
    if own:
        yield own


def _pieces(texts: list[str | None]) -> tuple[list[list[tuple[int, int, int, int]]], list[str]]:
    """Per text its pieces (start, end, first word, words), and the folded words of all texts."""
    out, raw = [], []
    for text in texts:
        own = []
        for a, b, words in words_by_unit(text or ""):
            own.append((a, b, len(raw), len(words)))
            raw += words
        out.append(own)
    return out, folded("\n".join(raw)).split("\n") if raw else []


def labelled(texts: list[str | None], known: Filter) -> list[list[tuple[int, int, str, float]]]:
    """`segments` of many texts at once."""
    pieces, words = _pieces(texts)
    flat = [p for own in pieces for p in own]
    if not flat:
        return [[] for _ in texts]
    seen = np.add.reduceat(known.counts(words), [p[2] for p in flat], axis=0)
    evidence, out, at = known.evidence(seen), [], 0
    for own in pieces:
        rows = range(at, at + len(own))
        at += len(own)
        out.append(_runs([(*flat[i][:2], int(seen[i, 0]), evidence[i]) for i in rows if seen[i, 0]], known) if own else [])
    return out


def segments(text: str | None, known: Filter) -> list[tuple[int, int, str, float]]:
    """(start, end, language, confidence) of each maximal run of text in one language; none for texts without words
    of which any language has an n-gram. A short text has one too, of low confidence.

    The pieces' evidence is decided together: a change of language costs SWITCH, and a run of its own must have APART
    more for its language than for that of the run beside it.
    """
    return labelled([text], known)[0]


def _runs(pieces: list[tuple[int, int, int, np.ndarray]], known: Filter) -> list[tuple[int, int, str, float]]:
    if not pieces:
        return []
    whole = np.stack([p[3] for p in pieces])
    if not whole.any():
        return []
    best = whole.argmax(1)
    if (best == best[0]).all():  # the path that is best at each piece and never switches
        return [_run(pieces[0][0], pieces[-1][1], int(best[0]), whole.sum(0), known)]
    pieces = [(a, b, n, own.tolist()) for a, b, n, own in pieces]
    size = len(known.languages)
    state, back = [0.0] * size, []
    for _, _, _, own in pieces:
        top = max(range(size), key=state.__getitem__)
        come = [k if state[k] >= state[top] - SWITCH else top for k in range(size)]
        state = [max(state[k], state[top] - SWITCH) + own[k] for k in range(size)]
        back.append(come)
    k = max(range(size), key=state.__getitem__)
    path = []
    for come in reversed(back):
        path.append(k)
        k = come[k]
    path.reverse()
    runs: list[list] = []
    for (a, b, n, own), k in zip(pieces, path):
        if runs and runs[-1][2] == k:
            runs[-1][1] = b
            runs[-1][3] += n
            runs[-1][4] = [x + y for x, y in zip(runs[-1][4], own)]
        else:
            runs.append([a, b, k, n, list(own)])
    while len(runs) > 1:  # a run that stands apart too little goes to the one beside it
        gaps = [min(r[4][r[2]] - r[4][o[2]] for o in (*runs[max(0, i - 1) : i], *runs[i + 1 : i + 2])) for i, r in enumerate(runs)]
        i = min(range(len(runs)), key=gaps.__getitem__)
        if gaps[i] >= APART:
            break
        sides = [j for j in (i - 1, i + 1) if 0 <= j < len(runs)]
        j = max(sides, key=lambda s: runs[i][4][runs[s][2]])
        runs[i][2] = runs[j][2]
        merged: list[list] = []
        for r in runs:
            if merged and merged[-1][2] == r[2]:
                merged[-1][1] = r[1]
                merged[-1][3] += r[3]
                merged[-1][4] = [x + y for x, y in zip(merged[-1][4], r[4])]
            else:
                merged.append(r)
        runs = merged
    return [_run(a, b, k, np.array(own), known) for a, b, k, _, own in runs]


def _run(a: int, b: int, k: int, own: np.ndarray, known: Filter) -> tuple[int, int, str, float]:
    second = float(np.delete(own, k).max(initial=0.0))
    return a, b, known.languages[k], 1 / (1 + math.exp(-min(30.0, max(-30.0, (float(own[k]) - second) / 3))))


GRAM, WHOLE = 0, 1
#: Least part of a language's n-grams, by how often it has them, that it has at a higher rate than any other.
OWN = 0.1


def _count(known: Filter | None):
    """Documents by language and n-gram (kind GRAM) and documents by language (WHOLE): by the label, or by each
    segment's language once there is a filter."""

    def lot(rows: list[tuple]) -> list[tuple]:
        texts, labels = [r[0] for r in rows], [r[1] for r in rows]
        out = []
        if known is not None:
            found = labelled(texts, known)
            parts = [(t[a:b], lang) for t, own in zip(texts, found) for a, b, lang, sure in own if sure > 0.9]
            texts, labels = [p[0] for p in parts], [p[1] for p in parts]
        out += [(WHOLE, label, 0, 1) for label in labels]
        pieces, words = _pieces(texts)
        if not words:
            return out
        unique, word = np.unique(np.array(words, object), return_inverse=True)
        text = np.repeat(np.arange(len(texts)), [sum(p[3] for p in own) for own in pieces])
        where, hashes = grams(list(unique))
        first = np.searchsorted(where, np.arange(len(unique) + 1))
        pairs = np.unique(np.stack([text, word]), axis=1)
        n = (first[1:] - first[:-1])[pairs[1]]
        at = np.repeat(first[pairs[1]] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
        codes = sorted(set(labels))
        code = np.array([codes.index(label) for label in labels])[np.repeat(pairs[0], n)]
        # An n-gram once a text, then by language.
        text, hashes = np.repeat(pairs[0], n), hashes[at]
        order = np.lexsort((hashes, text))
        text, hashes, code = text[order], hashes[order], code[order]
        once = np.r_[True, (np.diff(text) != 0) | (np.diff(hashes) != 0)]
        hashes, code = hashes[once], code[once]
        order = np.lexsort((hashes, code))
        hashes, code = hashes[order], code[order]
        edges = np.flatnonzero(np.r_[True, (np.diff(code) != 0) | (np.diff(hashes) != 0), True])
        return out + [(GRAM, codes[c], h, m) for c, h, m in zip(code[edges[:-1]].tolist(), hashes[edges[:-1]].view(np.int64).tolist(), np.diff(edges).tolist())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _some(list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))):
                got = lot(rows)
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in got], t) for i, t in enumerate((pa.int32(), pa.string(), pa.int64(), pa.int64()))], ["kind", "code", "gram", "n"])

    return run


@F.pandas_udf(StringType())
def _code_of(label: pd.Series) -> pd.Series:
    known = {v: label_code(v) for v in label.dropna().unique()}
    return label.map(known).astype(object).where(label.notna(), None)


def fit(docs: DataFrame, labelled: int = LABELLED) -> Filter:
    """The filter, fit on at most `labelled` documents per label (by the hash of doc_id), whole texts.

    Wrong labels are outvoted: a language has an n-gram only at SHARE of the rate of the one that has it most, and in
    SEEN documents. A second pass counts by the segments that the first filter finds, so mixed and mislabelled texts
    count where they belong. A label that only ever stands on texts of other languages has hardly an n-gram more often
    than those do, and is no language (OWN). A language needs SEEN labelled documents, whatever the size of the corpus.
    """
    rows = docs.where(F.col("text").isNotNull() & (F.length("text") > 20)).select("text", _code_of("lang").alias("code"), "doc_id").where("code IS NOT NULL")
    place = F.xxhash64("doc_id")
    # The bound by a threshold on the hash: it needs no sort of a label's documents. A row a language, at most NAMES many.
    counts = {r["code"]: r["count"] for r in rows.groupBy("code").count().collect()}
    languages = sorted(c for c, n in counts.items() if n >= SEEN)
    if not languages:
        return Filter(["en"], np.zeros(SLOTS, np.uint64), [0.0])
    share = F.lit(0)
    for c in languages:
        share = F.when(F.col("code") == c, int(min(1.0, labelled / counts[c]) * 1_000_000)).otherwise(share)
    sample = cut(rows.where(F.pmod(place, F.lit(1_000_000)) < share).select("text", "code"))
    known = None
    for _ in range(2):
        part = sample.mapInArrow(_count(known), "kind int, code string, gram long, n long").where(F.col("code").isin(languages))
        wide = part.groupBy("kind", "gram").agg(*(F.sum(F.when(F.col("code") == c, F.col("n")).otherwise(0)).alias(c) for c in languages))
        most = F.greatest(*(F.col(c) for c in languages), F.lit(0))
        # As many rows as the bounded sample has n-grams, whatever the size of the corpus.
        counted = wide.where((F.col("kind") != GRAM) | (most >= SEEN)).toPandas()
        total = np.maximum(1, counted.loc[counted["kind"] == WHOLE, languages].sum().to_numpy(float))
        own = counted[counted["kind"] == GRAM]
        n = own[languages].to_numpy(float)
        rate = n / total
        top = (n * (rate >= rate.max(axis=1, keepdims=True, initial=0.0))).sum(0) / np.maximum(1.0, n.sum(0))
        kept = np.flatnonzero(top >= OWN)
        if len(kept):
            languages, n, total = [languages[k] for k in kept], n[:, kept], total[kept]
        known = build_filter(own["gram"].to_numpy(np.int64).view(np.uint64), np.where(n.max(axis=1, keepdims=True, initial=0.0) >= SEEN, n, 0.0) / total, languages)
    return known


def language_segments(docs: DataFrame, known: Filter | None = None) -> DataFrame:
    """(doc_id, seg_no, lang, confidence, start, end, label): the maximal runs of each document in one language.

    docs: doc_id, text, lang. seg_no counts from 1 in reading order; start and end are places in the text; label is the
    language that the document's label names, null if none. Null, empty and wordless texts have no segment. Texts and
    words are read whole. The filter (16 MB, the same at every size of the corpus) is broadcast.
    """
    known = known or fit(docs)
    shared = docs.sparkSession.sparkContext.broadcast((known.languages, known.masks, known.fill))
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Filter(*shared.value)
        code = lru_cache(10_000)(label_code)
        for batch in batches:
            for rows in _some(list(zip(*(batch.column(i).to_pylist() for i in (1, 0, 2))))):
                found = labelled([r[0] for r in rows], own)
                out = [(doc, i + 1, lang, sure, a, b, code(label)) for (_, doc, label), runs in zip(rows, found) for i, (a, b, lang, sure) in enumerate(runs)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in out], t) for i, t in enumerate((batch.column(0).type, pa.int32(), pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.string()))],
                    ["doc_id", "seg_no", "lang", "confidence", "start", "end", "label"],
                )

    return docs.select("doc_id", "text", "lang").mapInArrow(run, f"doc_id {kind}, seg_no int, lang string, confidence double, start int, end int, label string")


def mislabelled(found: DataFrame) -> DataFrame:
    """Segments of documents whose label names no language or one the text is not in, and of those in several languages."""
    per = found.groupBy("doc_id").agg(F.count_distinct("lang").alias("n"), F.bool_or(F.coalesce(F.col("label") == F.col("lang"), F.lit(False))).alias("right"))
    return found.join(per.where((F.col("n") > 1) | ~F.col("right")).select("doc_id"), "doc_id", "left_semi")
