"""Encoding of a corpus with a public byte-level BPE tokenizer.

The merges of a piece of text run over a segment tree on its byte positions: each leaf has the rank of the pair that
starts there, each node the least rank below it, leftmost first; a merge updates the leaves of the live neighbours.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: how this vocabulary's texts are split before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Ids of null and of empty texts alike: no ids.
NO_IDS: tuple[int, ...] = ()

_NEVER = 1 << 60
#: Pieces kept with their ids by a worker; when so many are kept, it starts over. Longer pieces are not kept.
KEPT, KEPT_LENGTH = 200_000, 48


def vocabulary_file(name: str = "byte_bpe_50k.tiktoken", folder: str | None = None) -> str:
    """The vocabulary's path: `folder`, else the setting CHRONOPITCH_TOKENIZERS, else the installed public files."""
    folder = folder or os.environ.get("CHRONOPITCH_TOKENIZERS")
    if not folder:
        import public_tokenizers

        return public_tokenizers.path(name)
    return os.path.join(folder, name)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(word): int(rank) for word, rank in (line.split() for line in lines if line.strip())}


class Encoder:
    """Ids of texts by the ranks of a vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN) -> None:
        import regex

        self.ranks, self.find, self.kept = ranks, regex.compile(pattern).findall, {}
        self.single = [ranks[bytes([b])] for b in range(256)]

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """The ids of one piece: the leftmost pair of least rank merges, until no pair has one."""
        ranks, n = self.ranks, len(piece)
        if n == 1:
            return (self.single[piece[0]],)
        if (whole := ranks.get(piece)) is not None:
            return (whole,)
        size = 1 << (n - 1).bit_length()
        tree = [_NEVER] * (2 * size)
        end = list(range(1, n + 1))  # where the token that starts at a position ends; that is where the next starts
        before = list(range(-1, n - 1))
        for i in range(n - 1):
            tree[size + i] = ranks.get(piece[i : i + 2], _NEVER)
        for i in range(size - 1, 0, -1):
            left, right = tree[2 * i], tree[2 * i + 1]
            tree[i] = left if left <= right else right

        def point(at: int, rank: int) -> None:
            at += size
            tree[at] = rank
            while at > 1:
                at >>= 1
                left, right = tree[2 * at], tree[2 * at + 1]
                least = left if left <= right else right
                if tree[at] == least:
                    break
                tree[at] = least

        while (least := tree[1]) != _NEVER:
            at = 1
            while at < size:
                at = 2 * at if tree[2 * at] == least else 2 * at + 1
            at -= size
            middle = end[at]
            stop = end[middle]
            end[at] = stop
            point(middle, _NEVER)
            if stop < n:
                before[stop] = at
                point(at, ranks.get(piece[at : end[stop]], _NEVER))
            else:
                point(at, _NEVER)
            if at:
                prior = before[at]
                point(prior, ranks.get(piece[prior:stop], _NEVER))
        out, at = [], 0
        while at < n:
            out.append(ranks[piece[at : end[at]]])
            at = end[at]
        return tuple(out)

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return list(NO_IDS)
        out: list[int] = []
        kept = self.kept
        for piece in self.find(text):
            ids = kept.get(piece)
            if ids is None:
                # A lone surrogate has no UTF-8; it is taken as the replacement character.
                ids = self.merge(piece.encode("utf-8", "surrogatepass").decode("utf-8", "replace").encode())
                if len(piece) <= KEPT_LENGTH:
                    if len(kept) >= KEPT:
                        kept.clear()
                    kept[piece] = ids
            out += ids
        return out


#: Texts taken from a batch at a time.
SLICE = 256


def encoded(docs: DataFrame, text: str = "text", ids: str | None = "ids", count: str | None = None, vocabulary: str | None = None) -> DataFrame:
    """`docs` without its text, with the token ids of the text, their number, or both.

    Null and empty texts have no ids ([] and 0). Texts are encoded whole, whatever their length; other columns pass
    through, and a column that already has the result's name is replaced. The vocabulary file is read once, on the
    driver, and broadcast (about 1 MB, the same at every size of the corpus).
    """
    path = vocabulary or vocabulary_file()
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(path))
    kept = [c for c in docs.columns if c not in (text, ids, count)]
    rows = docs.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{text}`").cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for whole in batches:
            for start in range(0, max(1, whole.num_rows), SLICE):
                batch = whole.slice(start, SLICE)
                texts = batch.column(len(kept)).to_pylist()
                columns = [batch.column(i) for i in range(len(kept))]
                if ids:
                    lists = [encoder.encode(t) for t in texts]
                    columns.append(pa.array(lists, pa.list_(pa.int32())))
                    lengths = [len(x) for x in lists]
                else:
                    lengths = [len(encoder.encode(t)) for t in texts]
                if count:
                    columns.append(pa.array(lengths, pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, [*kept, *([ids] if ids else []), *([count] if count else [])])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    fields += [f"`{ids}` array<int>"] * bool(ids) + [f"`{count}` bigint"] * bool(count)
    return rows.mapInArrow(run, ", ".join(fields))
