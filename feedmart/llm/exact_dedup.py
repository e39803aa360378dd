"""Exact deduplication by content-defined chunk recipes (DataFrame functions only).

A text is normalised by deleting the white space ``[\\x20\\x09-\\x0D]`` and cut into chunks whose ends are
chosen by the content: after MIN_CHUNK characters a chunk ends at the first BOUNDARY, and at MAX_CHUNK
characters in any case. A chunk's identifier is a 64-bit hash. The chunks of all documents are
deduplicated by identifier and each identifier is verified: all chunks that carry it must agree in length and
in 60 bits of SHA-256; where one doesn't, the recipes use the long identifiers (hash, SHA-256 bits, length)
instead. Two documents are equal when their recipes, the ordered identifier lists, are equal. Only recipes
(about one long integer per kilobyte) are shuffled; no text moves.

Defined results: null text counts as empty; all empty texts are one group. A null id sorts after all
others. Among rows equal in length and id one stays, the first in the staged recipe table. An empty table
gives an empty result. Other columns are ignored by ``exact_groups`` and kept by ``drop_copies``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import join_groups, staged

MIN_CHUNK, MAX_CHUNK = 256, 2048


def _alternate(odd: int) -> str:
    """Ranges of a character class: every other run of the code points beyond Latin letters; runs are longer where scripts are larger."""
    regions = [(0x280, 0x3400, 64), (0x3400, 0x10000, 512), (0x10000, 0x32400, 2048)]
    return "".join(f"\\x{{{a:X}}}-\\x{{{a + run - 1:X}}}" for begin, end, run in regions for a in range(begin + odd * run, end, 2 * run))


# Chunks end after three characters of these classes in a row; any fixed choice works, rarer rows make longer chunks. The first three classes cut
# lower-case Latin text, the others digits, capitals and all other scripts.
ONE, OTHER = f"[0-4A-M{_alternate(0)}]", f"[5-9N-Z{_alternate(1)}]"
BOUNDARY = f"(?:[aehit][bdglmrsu][cfkopvwyz]|(?![a-z]){ONE}{OTHER}{ONE})"
CHUNK = f"(?s).{{{MIN_CHUNK},{MAX_CHUNK - 3}}}?{BOUNDARY}|.{{1,{MAX_CHUNK}}}"
WHITE = "[\\x20\\x09-\\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, "")


def _chunk(c: Column) -> Column:
    return F.struct(F.xxhash64(c).alias("id"),
                    F.conv(F.substring(F.sha2(c, 256), 1, 15), 16, 10).cast("long").alias("sha"),
                    F.length(c).alias("len"))


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: row number, id, code points, digest of the normalised text, recipe."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("raw"))
    rows = rows.select("doc_id", F.length("raw").cast("long").alias("points"), normalised(F.col("raw")).alias("norm"))
    return rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "points",
                       F.sha2(F.col("norm"), 256).alias("text_sha256"),
                       F.transform(F.regexp_extract_all("norm", F.lit(CHUNK), F.lit(0)), _chunk).alias("recipe"))


def verified(recipe_rows: DataFrame) -> bool:
    """True when every chunk identifier stands for one content."""
    chunks = recipe_rows.select(F.explode("recipe").alias("c")).select("c.*")
    ids = chunks.groupBy("id").agg(F.min("sha").alias("a"), F.max("sha").alias("b"), F.min("len").alias("c"),
                                   F.max("len").alias("d"))
    return ids.filter("a <> b or c <> d").isEmpty()


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, points for every row of ``docs``."""
    rows = staged(recipes(docs, id_col, text_col), "recipes")
    ids = F.col("recipe.id") if verified(rows) else F.col("recipe")
    rows = rows.select("row", "doc_id", "points", "text_sha256", ids.alias("ids"))
    rank = F.struct((-F.col("points")).alias("p"), F.col("doc_id").isNull().alias("n"), F.col("doc_id"), F.col("row"))
    groups = rows.groupBy("ids").agg(F.min(rank).alias("best"), F.count("*").alias("group_size"))
    groups = groups.select("ids", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"),
                           "group_size")
    groups = staged(groups, "recipe-groups")
    out = join_groups(rows, groups, "ids", "group_size", rows.count())
    return out.select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
                      "text_sha256", "points")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept.

    Ids to drop are narrow rows; the texts move once, for the anti-join (not at all when Spark sees from the size of
    the written ids that they can be broadcast). Ids that several rows share are decided by id and text, apart."""
    rows = exact_groups(docs, id_col, text_col)
    ids = staged(rows.groupBy("doc_id").agg(F.count("*").alias("n"), F.max("kept").alias("kept")).filter("n > 1 or not kept"), "copies")
    own = F.col(id_col).eqNullSafe(F.col("__id"))
    out = docs.join(ids.select(F.col("doc_id").alias("__id")), own, "left_anti")
    shared = ids.filter("n > 1")
    if shared.isEmpty():
        return out
    raw = F.coalesce(F.col(text_col), F.lit(""))
    again = docs.join(shared.select(F.col("doc_id").alias("__id")), own, "left_semi")
    again = again.withColumns({"__sha": F.sha2(normalised(raw), 256), "__points": F.length(raw).cast("long")})
    stay = rows.filter("kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__stay"), F.col("points").alias("__long"))
    again = again.join(stay, own & (F.col("__sha") == F.col("__stay")) & (F.col("__points") == F.col("__long")), "left_semi")
    # a row repeated in full has one decision; one of the repeats stays
    nth = F.row_number().over(Window.partitionBy("__sha", id_col, "__points").orderBy(text_col))
    again = again.withColumn("__nth", nth).filter("__nth = 1").select(*docs.columns)
    return out.unionByName(again)


__all__ = ["drop_copies", "exact_groups", "normalised", "recipes", "verified"]
