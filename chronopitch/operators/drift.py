"""Schemas that drift between files: one consistent table, and a report of each change.

Rows are loaded as path-value maps with the raw JSON type of each value, path-type statistics are aggregated
by file, files are compared with their predecessor, and typed columns are projected with the casts that fail.
"""

from __future__ import annotations

import math
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from chronopitch.session import cut

#: Levels of nested objects that the JVM unrolls; whatever is deeper goes through `_deeper`, whole.
LEVELS = 5

#: JSON types by the name that Spark gives a variant.
OBJECT, ARRAY, STRING, BOOLEAN, WHOLE, FRACTION = "object", "array", "string", "boolean", "whole", "fraction"

_CHANGE = StructType([StructField(n, StringType()) for n in ("change_kind", "field_name", "to_name")])
_LEAF = ArrayType(StructType([StructField(n, StringType()) for n in ("path", "kind", "text")]))


def json_kind(schema: Column) -> Column:
    """The JSON type behind schema_of_variant; null for JSON null. A decimal without scale is a whole number only
    beyond 18 digits: shorter whole numbers are BIGINT, so a short one is a fraction such as 2.0."""
    digits = F.regexp_extract(schema, r"^DECIMAL\((\d+),0\)", 1)
    return (
        F.when(schema.startswith("OBJECT"), OBJECT)
        .when(schema.startswith("ARRAY"), ARRAY)
        .when(schema == "STRING", STRING)
        .when(schema == "BOOLEAN", BOOLEAN)
        .when(schema == "BIGINT", WHOLE)
        .when((digits != "") & (digits.cast("int") > 18), WHOLE)
        .when(schema != "VOID", FRACTION)
    )


def _members(value: str, prefix: str | None) -> str:
    key = "e.key" if prefix is None else f"concat({prefix}, '.', e.key)"
    return (
        f"transform(map_entries(coalesce(try_variant_get({value}, '$', 'map<string,variant>'), map())),"
        f" e -> struct({key} AS path, schema_of_variant(e.value) AS schema, e.value AS value))"
    )


@F.pandas_udf(_LEAF)
def _deeper(path: pd.Series, text: pd.Series) -> pd.Series:
    """Every member below an object, at any depth: (path, kind, text)."""
    import json

    def below(prefix: str, whole: str) -> list[tuple]:
        out, todo = [], [(prefix, json.loads(whole))]
        while todo:
            at, node = todo.pop()
            for key, value in node.items():
                here = f"{at}.{key}"
                if isinstance(value, dict):
                    todo.append((here, value))
                    kind = OBJECT
                else:
                    kind = (
                        None if value is None
                        else ARRAY if isinstance(value, list)
                        else BOOLEAN if isinstance(value, bool)
                        else STRING if isinstance(value, str)
                        else WHOLE if isinstance(value, int)
                        else FRACTION
                    )
                out.append((here, kind, None if value is None else value if isinstance(value, str) else json.dumps(value)))
        return out

    return pd.Series([below(p, t) for p, t in zip(path, text)])


def _levels(rows: DataFrame, payload: str) -> DataFrame:
    """`rows` without the payload, with _m0 to _m4: the members on each level, which the JVM unrolls."""
    kept = [F.col(f"`{c}`") for c in rows.columns if c != payload]
    level = rows.select(*kept, F.try_parse_json(F.col(payload)).alias("_v"))
    level = level.withColumn("_m0", F.expr(_members("_v", None)))
    for n in range(1, LEVELS):
        level = level.withColumn(
            f"_m{n}",
            F.expr(f"flatten(transform(filter(_m{n - 1}, x -> x.schema LIKE 'OBJECT%'), x -> {_members('x.value', 'x.path')}))"),
        )
    return level.drop("_v")


_LAST = f"filter(_m{LEVELS - 1}, x -> x.schema LIKE 'OBJECT%')"
_TEXT = "try_variant_get({}.value, '$', 'string')"


@F.pandas_udf(_LEAF)
def _deeper_all(objects: pd.Series) -> pd.Series:
    """`_deeper` of several objects of one row."""
    below = _deeper.func
    return pd.Series([[m for o in row for m in below(pd.Series([o["path"]]), pd.Series([o["text"]]))[0]] for row in objects])


def path_values(rows: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per member at any depth: path, kind (null for JSON null), text, and the columns of `rows` but the payload.

    Rows whose payload is null, no JSON or no object give no members; `unreadable_payloads` counts them.
    """
    keys = [c for c in rows.columns if c != payload]
    kept = [F.col(f"`{c}`") for c in keys]
    level = _levels(rows, payload)
    member = level.select(*kept, F.explode(F.concat(*(F.col(f"_m{n}") for n in range(LEVELS)))).alias("m"))
    flat = member.select(*kept, F.col("m.path").alias("path"), json_kind(F.col("m.schema")).alias("kind"), F.expr(_TEXT.format("m")).alias("text"))
    # An object at the last unrolled level may hold more members: its text goes on, whole. A text with no more opening
    # braces than there are levels holds no such object and is not parsed again.
    braces = F.length(payload) - F.length(F.replace(F.col(payload), F.lit("{"), F.lit("")))
    last = _levels(rows.where(braces > LEVELS), payload).select(*kept, F.explode(F.expr(_LAST)).alias("m"))
    deep = last.select(*kept, F.explode(_deeper(F.col("m.path"), F.expr(_TEXT.format("m")))).alias("d"))
    return flat.unionByName(deep.select(*(F.col(f"`{k}`") for k in keys), "d.path", "d.kind", "d.text"))


def unreadable_payloads(rows: DataFrame, payload: str = "payload") -> DataFrame:
    """Rows whose payload is no JSON object."""
    schema = F.schema_of_variant(F.try_parse_json(F.col(payload)))
    return rows.where(~F.coalesce(schema.startswith("OBJECT"), F.lit(False)))


#: Levels of value marks, each of a sixteenth of the values of the one before (enough for 64 million distinct values),
#: and the most bits of a level that are told apart.
MARKS, SPARSE = 6, 40


def path_statistics(members: DataFrame, by: list[str]) -> DataFrame:
    """Per `by`, path and kind: how many values, and what they look like, in a fixed number of plain aggregates."""
    text = F.col("text")
    number = F.when(F.col("kind").isin(WHOLE, FRACTION), text.try_cast("double"))
    number = F.when(F.col("kind") == BOOLEAN, (text == "true").cast("double")).otherwise(number)
    size = F.length(text).cast("double")
    measure = F.coalesce(F.when(F.isnan(number), None).otherwise(number), size)
    words = F.col("kind").isin(STRING, ARRAY)

    def marks(c: Column) -> Column:
        """Bits of the values' hashes: of all of them, then of every 16th value, and so on, so that one level stays sparse."""
        h = F.when(words, F.xxhash64(c))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int"))
        rest = F.shiftrightunsigned(h, 6)
        levels = [F.bit_or(F.when(rest.bitwiseAND(F.lit(16**n - 1)) == 0, bit).otherwise(F.lit(0).cast("long"))) for n in range(MARKS)]
        return F.array(*levels)

    return members.groupBy(*by, "path", "kind").agg(
        F.count("*").alias("n"),
        F.avg(measure).alias("mean"),
        F.avg(measure * measure).alias("square"),
        F.avg(F.when(words, F.length(F.regexp_replace(text, "[0-9]", ""))) / F.greatest(size, F.lit(1.0))).alias("letters"),
        F.avg(F.when(words, F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))))).alias("blanks"),
        marks(text).alias("marks"),
        marks(F.regexp_extract(text, r"([A-Za-z]+)[^A-Za-z]*$", 1)).alias("ends"),
        F.max(F.when(F.col("kind") == WHOLE, size)).cast("int").alias("longest"),
    )


def _name_likeness(old: str, new: str) -> float:
    """1 for names that differ in case or separators only; else the share of common leading letters or words."""
    plain = lambda s: re.sub(r"[^a-z0-9]", "", s.lower())
    words = lambda s: set(re.findall(r"[a-z]+|\d+", re.sub(r"([a-z])([A-Z])", r"\1 \2", s).lower().replace("_", " ")))
    a, b = plain(old), plain(new)
    if a == b:
        return 1.0
    common = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    shared = len(words(old) & words(new)) / max(1, min(len(words(old)), len(words(new))))
    return 0.9 * max(shared, common / max(1, min(len(a), len(b))))


def _content_likeness(a: dict, b: dict) -> float:
    """How well two sets of values of one type could be the same field's, from 0 to 1, allowing for how few there are."""
    n, m = max(1, a["n"]), max(1, b["n"])
    if a["kind"] == BOOLEAN:
        p, q = ((s["mean"] * s["n"] + 1) / (s["n"] + 2) for s in (a, b))
        return math.exp(-3 * max(0.0, abs(p - q) - 2.2 * math.sqrt(p * (1 - p) / n + q * (1 - q) / m)))
    spread = lambda s: math.sqrt(max(0.0, s["square"] - s["mean"] ** 2))
    sa, sb = spread(a), spread(b)
    both = math.sqrt((sa * sa + sb * sb) / 2) + 0.02 * max(abs(a["mean"]), abs(b["mean"])) + 1e-9
    away = max(0.0, abs(a["mean"] - b["mean"]) / both - 2.2 * math.sqrt(1 / n + 1 / m))
    floor = 0.02 * max(abs(a["mean"]), abs(b["mean"])) + 1e-9
    wider = max(0.0, abs(math.log((sa + floor) / (sb + floor))) - 2.2 * math.sqrt(1 / (2 * n) + 1 / (2 * m)) - 0.2)
    like = math.exp(-away - wider)
    if a["kind"] in (STRING, ARRAY):
        like *= math.exp(-4 * max(0.0, abs((a["letters"] or 0) - (b["letters"] or 0)) - 0.1 - 1 / math.sqrt(min(n, m))))
        like *= math.exp(-max(0.0, abs((a["blanks"] or 0) - (b["blanks"] or 0)) - 0.3 - 1.5 / math.sqrt(min(n, m))))
        share = 0.0
        for k in ("marks", "ends"):
            pairs = [(int(x) & (2**64 - 1), int(y) & (2**64 - 1)) for x, y in zip(a[k], b[k])]
            x, y = next((p for p in pairs if max(p[0].bit_count(), p[1].bit_count()) <= SPARSE), pairs[-1])
            share = max(share, (x & y).bit_count() / max(1, min(x.bit_count(), y.bit_count())))
        like *= 0.15 + 0.85 * min(1.0, 1.3 * share)
    return like


def _changes(cells: list[dict]) -> list[tuple]:
    """The changes of one file against the one before. cells: the paths that differ, side 0 before and 1 after."""
    sides: dict[str, list[dict]] = {}
    for c in cells:
        sides.setdefault(c["path"], [{}, {}])[c["side"]][c["kind"]] = c
    gone = {p for p, (a, b) in sides.items() if a and not b}
    come = {p for p, (a, b) in sides.items() if b and not a}
    typed = lambda s: {k for k in s if k is not None}
    retyped = {p for p, (a, b) in sides.items() if a and b and typed(a) and typed(b) and typed(a) != typed(b)}
    whole = {p for p in gone | come | retyped if p not in retyped or not all(OBJECT in s for s in sides[p])}

    def covered(path: str) -> bool:
        parts = path.split(".")
        return any(".".join(parts[:i]) in whole for i in range(1, len(parts)))

    def likeness(old: str, new: str) -> float:
        a, b = sides[old][0], sides[new][1]
        if not typed(a) or typed(a) != typed(b):
            return 0.0
        named = _name_likeness(old.rpartition(".")[2], new.rpartition(".")[2])
        if OBJECT in a:
            ours = {p[len(old) + 1 :]: sides[p][0] for p in gone if p.startswith(f"{old}.")}
            theirs = {p[len(new) + 1 :]: sides[p][1] for p in come if p.startswith(f"{new}.")}
            pairs = [(x, y) for x in ours for y in theirs if typed(ours[x]) & typed(theirs[y])]
            best = {x: max((max(_content_likeness(ours[x][k], theirs[y][k]) for k in typed(ours[x]) & typed(theirs[y])) for u, y in pairs if u == x), default=0.0) for x in ours}
            content = sum(best.values()) / len(best) if best else float(not theirs)
        else:
            content = sum(_content_likeness(a[k], b[k]) for k in typed(a)) / len(typed(a))
        return 0.0 if content < 0.3 and named < 0.95 else 0.75 * content + 0.25 * named

    old, new = (sorted(p for p in s if not covered(p)) for s in (gone, come))
    pairs = sorted(
        ((likeness(a, b), a, b) for a in old for b in new if a.rpartition(".")[0] == b.rpartition(".")[0]), key=lambda x: (-x[0], x[1], x[2])
    )
    renamed: dict[str, str] = {}
    for like, a, b in pairs:
        if like >= 0.3 and a not in renamed and b not in renamed.values():
            renamed[a] = b
    out = [("renamed", a, b) for a, b in renamed.items()]
    out += [("removed", a, a) for a in old if a not in renamed]
    out += [("added", b, b) for b in new if b not in renamed.values()]
    return out + [("retyped", p, p) for p in sorted(retyped) if not covered(p)]


@F.pandas_udf(ArrayType(_CHANGE))
def _compare(cells: pd.Series) -> pd.Series:
    return pd.Series([_changes([dict(c) if isinstance(c, dict) else c.asDict() for c in group]) for group in cells])


def file_statistics(entries: DataFrame) -> DataFrame:
    """Path-type statistics by file: feed_id, file_seq, path, kind and what `path_statistics` measures."""
    rows = entries.where(F.col("feed_id").isNotNull() & F.col("file_seq").isNotNull()).select("feed_id", "file_seq", "payload")
    return path_statistics(path_values(rows), ["feed_id", "file_seq"])


def schema_changes(entries: DataFrame) -> DataFrame:
    """(feed_id, file_seq, change_kind, field_name, to_name): each change of a payload field against the file before.

    entries: feed_id, file_seq, payload. Only files that follow a file of the same feed with a readable payload are
    compared. Null feed ids or numbers and unreadable payloads give nothing; repeated rows change nothing; an empty
    table gives no rows; extra columns are ignored. What one task holds is the width of a file's schema, not its rows.
    """
    return changes_between(file_statistics(entries))


def changes_between(stats: DataFrame) -> DataFrame:
    """The changes of `schema_changes`, from the statistics by file."""
    cell = F.struct("path", "kind", "n", "mean", "square", "letters", "blanks", "marks", "ends")
    files = stats.groupBy("feed_id", "file_seq").agg(F.collect_list(cell).alias("cells"))
    # Each file's cells go to the comparison with the file before and to that with the file after; nothing is computed twice.
    sides = F.array(F.struct(F.col("file_seq").alias("file_seq"), F.lit(1).alias("side")), F.struct((F.col("file_seq") + 1).alias("file_seq"), F.lit(0).alias("side")))
    sides = files.select("feed_id", F.explode(sides).alias("s"), "cells")
    pair = sides.groupBy("feed_id", "s.file_seq").agg(
        F.first(F.when(F.col("s.side") == 0, F.col("cells")), ignorenulls=True).alias("old"),
        F.first(F.when(F.col("s.side") == 1, F.col("cells")), ignorenulls=True).alias("new"),
    ).where(F.col("old").isNotNull() & F.col("new").isNotNull())
    # Only paths whose set of types differs go on, with all their cells and those of their members.
    types = lambda c: F.array_sort(F.transform(c, lambda x: F.concat_ws("|", x["path"], F.coalesce(x["kind"], F.lit("null")))))
    keep = lambda side, own: F.transform(
        F.filter(own, lambda x: F.array_contains(F.col("_turned"), x["path"])),
        lambda x: F.struct(F.lit(side).alias("side"), *(x[n].alias(n) for n in ("path", "kind", "n", "mean", "square", "letters", "blanks", "marks", "ends"))),
    )
    pair = pair.withColumn("_old", types(F.col("old"))).withColumn("_new", types(F.col("new")))
    pair = pair.where(F.col("_old") != F.col("_new"))
    differs = F.array_union(F.array_except("_old", "_new"), F.array_except("_new", "_old"))
    pair = pair.withColumn("_turned", F.array_distinct(F.transform(differs, lambda x: F.regexp_replace(x, r"\|[a-z]+$", ""))))
    found = pair.select(
        "feed_id", "file_seq", F.explode(_compare(F.concat(keep(0, F.col("old")), keep(1, F.col("new"))))).alias("c")
    )
    return found.select("feed_id", "file_seq", "c.change_kind", "c.field_name", "c.to_name")


def field_names(changes: DataFrame) -> dict[str, str]:
    """Old and new names of renamed fields by one name each; as many as the schema is wide, so they fit the driver."""
    pairs = changes.where(F.col("change_kind") == "renamed").groupBy("field_name", "to_name").count().limit(WIDEST + 1).collect()
    if len(pairs) > WIDEST:
        raise ValueError(f"more than {WIDEST} renamed fields")
    head: dict[str, str] = {}

    def top(name: str) -> str:
        while head.get(name, name) != name:
            name = head[name]
        return name

    for row in sorted(pairs, key=lambda r: (-r["count"], r["field_name"], r["to_name"])):
        a, b = top(row["field_name"]), top(row["to_name"])
        if a != b:
            head[b] = a
    return {name: top(name) for name in {n for r in pairs for n in (r["field_name"], r["to_name"])}}


#: Most fields of a schema that the driver takes: a schema, unlike rows, is small.
WIDEST = 5000


def consistent_names(path: str, names: dict[str, str]) -> str:
    """A path whose every leading part goes by its one name."""
    out = ""
    for part in path.split("."):
        raw = f"{out}.{part}" if out else part
        out = names.get(raw, raw)
    return out


#: Written forms of truth values.
TRUE, FALSE = ("true", "1", "yes", "y"), ("false", "0", "no", "n")
#: Whole numbers beyond this lose digits as a double.
EXACT = 2**53


def _column_type(kinds: dict[str, int], longest: int) -> str:
    """The type of a field's column: that of most of its values; whole numbers are kept exact."""
    numbers = kinds.get(WHOLE, 0) + kinds.get(FRACTION, 0)
    ranked = {k: n for k, n in kinds.items() if k not in (WHOLE, FRACTION)} | ({"number": numbers} if numbers else {})
    usual = max(ranked, key=lambda k: (ranked[k], k))
    if usual == "number":
        return "double" if kinds.get(FRACTION) else "bigint" if longest <= 18 else "decimal(38,0)"
    return {BOOLEAN: "boolean", ARRAY: "array<string>", OBJECT: OBJECT}.get(usual, "string")


def table_fields(stats: DataFrame, names: dict[str, str]) -> tuple[dict[str, tuple[str, str]], dict[str, str]]:
    """(path to (field, column type), field to column name), from the statistics: as many as the schema is wide.

    A field whose values come wrapped in objects in some files takes their member `value`; the other members are fields
    of their own. Column names have two underscores for a dot and differ in more than letter case.
    """
    seen = stats.where("kind IS NOT NULL").groupBy("path", "kind").agg(F.sum("n").alias("n"), F.max("longest").alias("longest")).limit(8 * WIDEST + 1).collect()
    if len({r["path"] for r in seen}) > WIDEST:
        raise ValueError(f"more than {WIDEST} fields")
    field = {p: consistent_names(p, names) for p in sorted({r["path"] for r in seen})}
    kinds: dict[str, dict[str, int]] = {}
    longest: dict[str, int] = {}
    for r in seen:
        own = kinds.setdefault(field[r["path"]], {})
        own[r["kind"]] = own.get(r["kind"], 0) + r["n"]
        longest[field[r["path"]]] = max(longest.get(field[r["path"]], 0), r["longest"] or 0)
    types = {f: _column_type(k, longest[f]) for f, k in kinds.items()}
    for path, name in field.items():
        base = name[: -len(".value")] if name.endswith(".value") else None
        if base in types and types[base] != OBJECT:
            field[path] = base
    columns, taken = {}, {"entry_id", "feed_id", "file_seq", "failed_casts"}
    for f in sorted(set(field.values()), key=lambda f: (-sum(kinds[f].values()), f)):
        if types[f] != OBJECT:
            name = re.sub(r"[^A-Za-z0-9_]+", "_", f.replace(".", "__"))
            while name.lower() in taken:
                name += "_"
            columns[f] = name
            taken.add(name.lower())
    return {p: (f, types[f]) for p, f in field.items()}, columns


def _cast(text: Column, kind: Column, type_: Column) -> Column:
    """The value's text in the form that its column's type casts, or null where it has none."""
    one = F.from_json(text, "array<string>")
    alone = F.when(kind == ARRAY, F.when(F.size(one) == 1, F.get(one, 0))).otherwise(text)
    number = alone.try_cast("double")
    truth = F.when(F.lower(alone).isin(*TRUE), "true").when(F.lower(alone).isin(*FALSE), "false")
    return (
        F.when(type_ == "string", alone)
        .when(type_ == "array<string>", F.when(kind == ARRAY, text))
        .when(kind == BOOLEAN, F.when(type_ == "boolean", truth))
        .when(type_ == "boolean", truth)
        .when(type_ == "double", F.when((kind != WHOLE) | (F.abs(number) <= EXACT), F.when(number.isNotNull() & ~F.isnan(number), alone)))
        .when(type_ == "bigint", F.when(alone.try_cast("bigint").isNotNull() & (alone.try_cast("decimal(38,6)") == alone.try_cast("bigint")), alone))
        .when(type_ == "decimal(38,0)", F.when(alone.try_cast("decimal(38,6)").isNotNull() & (alone.try_cast("decimal(38,6)") % 1 == 0) | alone.rlike(r"^-?\d{1,38}$"), alone))
    )


def consistent_table(entries: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """One row per distinct entry: its payload's fields under one name each, in typed columns, with the casts that failed.

    Columns: entry_id, feed_id, file_seq, one per field (see `table_fields`), and `failed_casts`, an array of (field,
    kind, text) with every value that its column could not take, whole: values of another type that do not cast,
    arrays of more than one element in place of a single value, and what a second path of one name holds. A field's
    type is the one most of its values have over all files. Nothing of a payload but nulls is in neither. Repeated
    entries count once; unreadable payloads give nulls; an empty table gives no rows and no fields. The statistics are
    written once; the table itself is one pass over the rows, without a shuffle but that of repeated entries.
    """
    stats = cut(file_statistics(entries))
    if names is None:
        names = field_names(changes_between(stats))
    paths, columns = table_fields(stats, names)
    rows = entries.where(F.col("entry_id").isNotNull()).groupBy("entry_id").agg(F.min(F.struct("feed_id", "file_seq", "payload")).alias("_r")).select("entry_id", "_r.*")
    level = _levels(rows, "payload")
    member = lambda a: F.transform(a, lambda m: F.struct(m["path"].alias("path"), json_kind(m["schema"]).alias("kind"), F.call_function("try_variant_get", m["value"], F.lit("$"), F.lit("string")).alias("text")))
    level = level.withColumn("_all", member(F.concat(*(F.col(f"_m{n}") for n in range(LEVELS)))))
    if any(p.count(".") >= LEVELS for p in paths):
        level = level.withColumn("_all", F.concat("_all", _deeper_all(F.expr(f"transform({_LAST}, m -> struct(m.path AS path, {_TEXT.format('m')} AS text))"))))
    order = sorted(columns)
    number = {f: i for i, f in enumerate(order)}
    rest = sorted({f for f, _ in paths.values()} - set(order))
    number |= {f: len(order) + i for i, f in enumerate(rest)}
    # A literal: as many entries as the schema has paths.
    literal = F.create_map(*(x for p, (f, t) in paths.items() for x in (F.lit(p), F.struct(F.lit(number[f]).alias("f"), F.lit(f).alias("name"), F.lit(t).alias("t"))))) if paths else None
    if literal is None:
        return rows.select("entry_id", "feed_id", "file_seq", F.array().cast("array<struct<field:string,kind:string,text:string>>").alias("failed_casts"))

    def placed(m: Column) -> Column:
        at = F.element_at(literal, m["path"])
        return F.struct(at["f"].alias("f"), at["name"].alias("field"), at["t"].alias("t"), m["kind"].alias("kind"), m["text"].alias("text"), _cast(m["text"], m["kind"], at["t"]).alias("v"))

    level = level.withColumn("_all", F.transform(F.filter("_all", lambda m: m["kind"].isNotNull()), placed))
    level = level.withColumn("_own", F.filter("_all", lambda m: m["kind"] != OBJECT)).withColumn("_at", F.expr("transform(_own, m -> m.f)"))
    lost = F.filter("_own", lambda m, i: m["v"].isNull() | (F.array_position("_at", m["f"]) != i + 1))
    unwrapped = F.filter("_all", lambda m: (m["kind"] == OBJECT) & (m["t"] != OBJECT) & (F.array_position("_at", m["f"]) == 0))
    failed = F.array_sort(F.transform(F.concat(lost, unwrapped), lambda m: F.struct(m["field"].alias("field"), m["kind"].alias("kind"), m["text"].alias("text"))))

    def column(f: str) -> Column:
        type_ = next(t for g, t in paths.values() if g == f)
        text = F.expr(f"CASE WHEN array_position(_at, {number[f]}) > 0 THEN element_at(_own, cast(array_position(_at, {number[f]}) AS int)).v END")
        return (F.from_json(text, type_) if type_ == "array<string>" else text.try_cast(type_)).alias(columns[f])

    return level.select("entry_id", "feed_id", "file_seq", *(column(f) for f in order), failed.alias("failed_casts"))
