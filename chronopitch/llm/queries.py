"""The queries of this subpackage: p3, p5, p7, p8, p9 and p10, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronopitch.llm import entities, languages, mixing, names, survivors, tokens
from chronopitch.session import cut, table


def p3_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivors.survivors(table(spark, sf_dir, "canonical_entities"), table(spark, sf_dir, "source_authority"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    several = survivors.repeated_groups(table(spark, sf_dir, "canonical_entities"))
    first = survivors.surviving_records(table(spark, sf_dir, "canonical_entities"), table(spark, sf_dir, "source_authority"))
    return first.join(several, "canonical_id", "left_semi")


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every name that the two tables hold: table_name, row_id, side, name."""
    both = None
    for name, home, away in (("football_data_timezone", "hometeam", "awayteam"), ("live_fixture", "home_team", "away_team")):
        sides = F.array(*(F.struct(F.lit(s).alias("side"), F.col(c).alias("name")) for s, c in (("home", home), ("away", away))))
        rows = table(spark, sf_dir, name).select(F.lit(name).alias("table_name"), "row_id", F.explode(sides).alias("s")).select("table_name", "row_id", "s.side", "s.name")
        both = rows if both is None else both.unionByName(rows)
    return both.where(F.col("name").isNotNull())


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed, teams = _typed(spark, sf_dir), table(spark, sf_dir, "team_reference")
    linked = names.link_names(typed, teams)
    # Names written exactly as in the reference are no case.
    exact = teams.select("team_id", F.col("name")).distinct()
    linked = linked.join(exact, ["team_id", "name"], "left_anti")
    return typed.join(linked, "name").select("table_name", "row_id", "side", "team_id")


def p7_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = table(spark, sf_dir, "source_observation").select(F.col("observation_id").alias("query_id"), F.col("entity_type").alias("kind"), "name", "attributes")
    known = table(spark, sf_dir, "canonical_entities").select(F.col("canonical_id").alias("entity_id"), F.col("entity_type").alias("kind"), "name", "attributes")
    found = entities.link_entities(seen, known)
    return found.select(F.col("query_id").alias("observation_id"), F.col("entity_id").alias("canonical_id"), F.round("confidence", 6).alias("confidence"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p7_links(spark, sf_dir).select("observation_id", "canonical_id")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encoded(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _mix(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    sized = cut(tokens.encoded(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), ids=None, count="n_tokens"))
    return mixing.mix(sized, table(spark, sf_dir, "mixture_target"))


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mix(spark, sf_dir)[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mix(spark, sf_dir)[1]


def p10_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return languages.language_segments(docs).withColumn("confidence", F.round("confidence", 6))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return languages.mislabelled(cut(languages.language_segments(docs))).select("doc_id", "seg_no", "lang")


QUERIES = {"p3_found": p3_found, "p3_survivors": p3_survivors, "p5_found": p5_found, "p7_found": p7_found, "p7_links": p7_links, "p8_ids": p8_ids, "p9_mix": p9_mix, "p9_shares": p9_shares, "p10_found": p10_found, "p10_segments": p10_segments}

_BLANK = ", ".join(f"'{b}'" for b in survivors.BLANKS)
_NUMBER = ", ".join(str(n) for n in survivors.NO_NUMBERS)

ORACLE: dict[str, str] = {
    "p3_found": f"""
        WITH r AS (SELECT record_id, canonical_id, lower(trim(entity_type)) AS kind, lower(trim(replace(current_source, chr(160), ' '))) AS src, current_knowledge_at AS known, name,
                          CASE WHEN json_valid(attributes) AND json_type(attributes) = 'OBJECT' THEN attributes END AS attributes FROM canonical_entities WHERE canonical_id IS NOT NULL),
        f AS (SELECT record_id, canonical_id, kind, src, known, 'name' AS field_name, name AS value FROM r
              UNION ALL SELECT record_id, canonical_id, kind, src, known, e.key, e.value FROM (SELECT *, unnest(map_entries(json_transform(attributes, '"MAP(VARCHAR, VARCHAR)"'))) AS e FROM r) WHERE e.key <> 'name'),
        i AS (SELECT *, lower(trim(replace(value, chr(160), ' '))) AS v FROM f WHERE value IS NOT NULL),
        g AS (SELECT * FROM i WHERE v NOT IN ({_BLANK}) AND NOT coalesce(TRY_CAST(v AS DOUBLE) IN ({_NUMBER}) OR TRY_CAST(v AS DOUBLE) < 0, FALSE)),
        a AS (SELECT lower(trim(entity_type)) AS kind, field_name, lower(trim(source)) AS src, min(trust_rank) AS rnk FROM source_authority GROUP BY ALL),
        n AS (SELECT g.*, row_number() OVER (PARTITION BY canonical_id, g.field_name ORDER BY coalesce(rnk, 1000000), known DESC NULLS LAST, record_id) AS place
              FROM g LEFT JOIN a ON a.kind = g.kind AND a.field_name = g.field_name AND a.src = g.src)
        SELECT canonical_id, field_name, record_id FROM n WHERE place = 1 AND canonical_id IN (SELECT canonical_id FROM canonical_entities GROUP BY canonical_id HAVING count(DISTINCT record_id) > 1)""",
}
