"""Removal of boilerplate lines by the number of distinct sites they stand on.

Every line (without blanks at its ends) gets a 96-bit hash. A HyperLogLog sketch of the sites per line hash is built
and merged by aggregation, so a line that stands on every page of a corpus meets its key as one sketch per task. A line
whose estimate is far from `min_sites` is decided by the sketch; lines near it get an exact distinct count. A line on
`min_sites` or more distinct sites is boilerplate: every occurrence is removed but the first one (least doc_id, then
line number), so no content is lost.

Defined cases: null text stays null and has no lines; an empty text has one empty line; blank lines are never removed; a
null site is a site of its own; a null id comes last in the order of first occurrences; rows that share an id are told
apart by their texts only, so each loses its own boilerplate lines and all of them keep a first occurrence at the same
line number; further columns of any name go along; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heronlake.session import settle

MIN_SITES = 10
#: log2 of the number of sketch registers; the standard error of the estimate is 1.04 / sqrt(2 ** LG_K).
LG_K = 12
#: Estimates within so many standard errors of the threshold (one site at least) are counted exactly.
BAND = 5.0


def _key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.hash(line).alias("b"))


def line_rows(documents: DataFrame) -> DataFrame:
    """(doc_id, text_key, site, line_no, key) of every line that is not blank."""
    # the key of the text in a step of its own: beside the generator it would be computed for every line
    keyed = documents.select("doc_id", _key(F.col("text")).alias("text_key"), F.col("source").alias("site"), "text")
    lines = keyed.select("doc_id", "text_key", "site", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    line = F.regexp_replace("line", r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return (lines.withColumn("line", F.when(F.col("line").rlike(r"^[\x20\x09-\x0D]|[\x20\x09-\x0D]$"), line).otherwise(F.col("line")))
            .filter("line <> ''")
            .select("doc_id", "text_key", "site", "line_no", _key(F.col("line")).alias("key")))


def wide_lines(rows: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K, band: float = BAND) -> DataFrame:
    """Keys of the lines on min_sites or more distinct sites, with their first occurrence."""
    site = F.coalesce(F.concat(F.lit("s"), F.col("site")), F.lit("null"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "line_no")).alias("first")
    error = max(1.0, band * 1.04 / 2 ** (lg_k / 2) * min_sites)
    counted = settle(
        rows.groupBy("key").agg(F.hll_sketch_agg(site, F.lit(lg_k)).alias("sites"), first)
        .select("key", "first", F.hll_sketch_estimate("sites").alias("estimate"))
        .filter(F.col("estimate") >= min_sites - error), "line-spread")
    near = counted.filter(F.col("estimate") < min_sites + error).select(F.col("key").alias("near_key"))
    exact = (rows.join(near, F.col("key") == F.col("near_key"), "left_semi")
             .groupBy("key", site.alias("site")).agg(F.lit(1).alias("one"))
             .groupBy("key").agg(F.sum("one").alias("sites"))
             .filter(F.col("sites") >= min_sites).select(F.col("key").alias("wide_key")))
    clear = counted.filter(F.col("estimate") >= min_sites + error).select("key", "first")
    return clear.unionByName(counted.join(exact, F.col("key") == F.col("wide_key"), "left_semi").select("key", "first"))


def removed_lines(rows: DataFrame, wide: DataFrame) -> DataFrame:
    """Per document the numbers of the lines to remove. Rows with one id and different texts are different documents; rows
    with one id and one text lose the same lines."""
    w = wide.select(F.col("key").alias("wide_key"), "first")
    again = ~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("line_no") == F.col("first.line_no")))
    return (rows.join(w, F.col("key") == F.col("wide_key")).filter(again)
            .groupBy("doc_id", "text_key").agg(F.collect_set("line_no").alias("removed")))


def without_boilerplate(documents: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """doc (the row as it came), text without boilerplate lines, n_lines and n_removed of every document."""
    rows = line_rows(documents)
    wide = settle(wide_lines(rows, min_sites, lg_k), "line-wide")
    gone = removed_lines(rows, wide).select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key"), "removed")
    # the row goes along as one value, so that columns of any name do no harm
    whole = documents.select(F.struct(*documents.columns).alias("doc"))
    text = F.col("doc").getField("text")
    same = F.col("doc").getField("doc_id").eqNullSafe(F.col("gone_id")) & (_key(text) == F.col("gone_key"))
    # lines and the places that stay are bound once; array_except looks places up by hash
    parts = F.struct(F.split(text, "\n", -1).alias("lines"), F.col("removed"))
    stay = F.transform(F.array(parts), lambda p: F.struct(p["lines"].alias("lines"), F.array_except(
        F.sequence(F.lit(0), F.size(p["lines"]) - 1), p["removed"]).alias("places")))
    kept = F.transform(stay, lambda p: F.struct(
        F.array_join(F.transform(p["places"], lambda i: F.get(p["lines"], i)), "\n").alias("text"),
        F.size(p["lines"]).alias("lines"), F.size("removed").alias("gone")))
    joined = whole.join(gone, same, "left")
    cut = joined.withColumn("cut", F.when(F.col("removed").isNotNull(), F.get(kept, F.lit(0))))
    n_lines = F.coalesce(F.size(F.when(text.isNotNull(), F.split(text, "\n", -1))), F.lit(0)).cast("long")
    return cut.select("doc", F.coalesce(F.col("cut.text"), text).alias("text"), n_lines.alias("n_lines"),
                      F.coalesce(F.col("cut.gone"), F.lit(0)).cast("long").alias("n_removed"))


def dedup(documents: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """doc_id, n_lines, n_removed and text without boilerplate lines of every document."""
    cleaned = without_boilerplate(documents.select("doc_id", "source", "text"), min_sites, lg_k)
    return cleaned.select("doc.doc_id", "n_lines", "n_removed", "text")


SQL = """
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS no
  FROM documents WHERE text IS NOT NULL),
trimmed AS (SELECT *, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t FROM lines),
wide AS (
  SELECT t, min((doc_id, no)) AS first FROM trimmed WHERE t <> ''
  GROUP BY t HAVING count(DISTINCT coalesce('s' || source, 'null')) >= 10),
marked AS (
  SELECT l.doc_id, l.no, l.line, w.t IS NOT NULL AND (l.doc_id, l.no) <> w.first AS gone
  FROM trimmed l LEFT JOIN wide w ON l.t = w.t AND l.t <> '')
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
       coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (WHERE NOT gone), '') AS text
FROM marked GROUP BY doc_id
UNION ALL SELECT doc_id, 0, 0, NULL FROM documents WHERE text IS NULL
"""
