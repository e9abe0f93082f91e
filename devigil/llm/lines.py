"""Line dedup by the spread of a line over sites.

Lines are hashed; a HyperLogLog sketch of the sites of every line merges by aggregation. Lines whose
estimate is near the threshold are counted exactly, and lines on enough sites are boilerplate: they
are removed wherever they stand. All sites of a text count. A line that stands in one text only is no
boilerplate, so copies of a document alone do not turn its lines into it.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, sqrt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devigil.llm.shared import Landing

# with blanks, so that no column of the input has these names
KEY = ("hash a of text", "hash b of text")
LINE = ("hash a of line", "hash b of line")
GONE = "positions to take out"


@dataclass(frozen=True)
class LineParams:
    """A line of at least ``min_chars`` characters, spaces around it aside, on at least ``min_sites``
    sites and in more than one text is boilerplate. Sketches have 2 ** ``lg_k`` registers; estimates within ``sigmas`` standard
    errors of the threshold (and at least 1) are not trusted."""

    min_sites: int = 8
    min_chars: int = 20
    lg_k: int = 10
    sigmas: float = 5.0

    @property
    def band(self) -> int:
        return max(1, ceil(self.sigmas * 1.04 / sqrt(2**self.lg_k) * self.min_sites))


def _hashes(value) -> tuple:
    """128 bits as two columns."""
    return F.xxhash64(value), F.xxhash64(value, F.lit(1))


def occurrences(docs: DataFrame, params: LineParams) -> DataFrame:
    """``text_a, text_b, site, pos, line_a, line_b``: the countable lines of every text on each of its sites."""

    def hashed(line):
        a, b = _hashes(F.trim(line))
        return F.when(F.length(F.trim(line)) >= params.min_chars, F.struct(a.alias("a"), b.alias("b")))

    lines = F.transform(F.split("text", "\n", -1), hashed)
    a, b = _hashes(F.col("text"))
    texts = docs.filter("text is not null").select(
        a.alias(KEY[0]), b.alias(KEY[1]), F.coalesce("source", F.lit("")).alias("site"), lines.alias("lines")
    )
    texts = texts.groupBy(*KEY, "site").agg(F.first("lines").alias("lines"))
    each = texts.select(*KEY, "site", F.posexplode("lines").alias("pos", "line")).filter("line is not null")
    return each.select(*KEY, "site", "pos", F.col("line.a").alias(LINE[0]), F.col("line.b").alias(LINE[1]))


def boilerplate(found: DataFrame, store: Landing, params: LineParams) -> DataFrame:
    """``line_a, line_b`` of the lines on at least ``min_sites`` sites and in more than one text."""
    several = (F.min(KEY[0]) < F.max(KEY[0])) | (F.min(KEY[1]) < F.max(KEY[1]))
    sketches = found.groupBy(*LINE).agg(F.hll_sketch_agg("site", params.lg_k).alias("sketch"), several.alias("several"))
    spread = sketches.filter("several").select(*LINE, F.hll_sketch_estimate("sketch").alias("sites"))
    spread = store.land(spread.filter(F.col("sites") >= params.min_sites - params.band), "spread")
    near = spread.filter(F.col("sites") <= params.min_sites + params.band).select(*LINE)
    exact = found.join(near, list(LINE)).select(*LINE, "site").distinct().groupBy(*LINE).count()
    sure = spread.filter(F.col("sites") > params.min_sites + params.band).select(*LINE)
    return sure.unionByName(exact.filter(F.col("count") >= params.min_sites).select(*LINE))


def remove_boilerplate(docs: DataFrame, params: LineParams = LineParams()) -> DataFrame:
    """``docs`` (with ``text`` and ``source``) with boilerplate lines taken out of ``text``, and the
    columns ``n_lines`` and ``n_removed``.

    A null text stays null with 0 lines; an empty text has one empty line. A null source is a site of
    its own. Equal rows get equal results; columns of the names added are replaced.
    """
    store = Landing(docs.sparkSession, "lines")
    found = store.land(occurrences(docs, params), "occurrences")
    common = boilerplate(found, store, params)
    gone = found.join(common, list(LINE)).groupBy(*KEY).agg(F.collect_set("pos").alias(GONE))
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    a, b = _hashes(F.col("text"))
    keyed = docs.select(*names).withColumns({KEY[0]: a, KEY[1]: b})
    joined = keyed.join(gone, list(KEY), "left")
    lines = F.split("text", "\n", -1)
    kept = F.filter(lines, lambda line, i: ~F.array_contains(F.col(GONE), i))
    cleaned = F.when(F.col(GONE).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    count = F.coalesce(F.size(lines), F.lit(0))
    columns = [cleaned.alias(c) if c == "text" else F.col(f"`{c}`") for c in names]
    return joined.select(
        *columns,
        F.when(F.col("text").isNull(), 0).otherwise(count).cast("bigint").alias("n_lines"),
        F.coalesce(F.when(F.col(GONE).isNotNull(), F.size(GONE)), F.lit(0)).cast("bigint").alias("n_removed"),
    )


#: The same in SQL, with exact counts: what the sketches must agree with.
CHECK = """
WITH sites AS (
  SELECT DISTINCT text, coalesce(source, '') AS site FROM documents WHERE text IS NOT NULL
), split AS (
  SELECT text, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM (SELECT DISTINCT text FROM sites)
), common AS (
  SELECT trim(line) AS line FROM split JOIN sites USING (text) WHERE length(trim(line)) >= 20
  GROUP BY ALL HAVING count(DISTINCT site) >= 8 AND count(DISTINCT text) >= 2
), cleaned AS (
  SELECT s.text, count(*) AS n_lines, count(c.line) AS n_removed,
         coalesce(string_agg(s.line, chr(10) ORDER BY s.pos) FILTER (WHERE c.line IS NULL), '') AS kept
  FROM split s LEFT JOIN common c ON trim(s.line) = c.line GROUP BY s.text
)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       sha256(kept) AS kept_sha256
FROM documents d LEFT JOIN cleaned USING (text)
"""
