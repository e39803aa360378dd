"""One spelling per category across sources.

The task asks for categories to be unified across sources; the reference leaves it undone. A
category is matched on its trimmed lower-case form against an optional mapping table
(``key, canonical``); unmatched names keep their trimmed form, so with no mapping this is the
identity up to surrounding blanks.

``propose_categories`` derives such a mapping: names that share most of their letters are joined, and each group is offered under its
most frequent name. The proposals are a table to be reviewed (``Store`` keeps it); only accepted rows become a mapping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmart.operators.components import components
from feedmart.session import materialise

PROPOSED, ACCEPTED, DECLINED = "proposed", "accepted", "declined"


def normalise_key(col):
    c = F.col(col) if isinstance(col, str) else col
    return F.lower(F.trim(c))


def category_normalise(df: DataFrame, col: str = "tags", mapping: DataFrame | None = None) -> DataFrame:
    if mapping is None:
        return df.withColumn(col, F.trim(F.col(col)))
    m = mapping.select(F.col("key").alias("_nkey"), F.col("canonical").alias("_canon"))
    twice = m.groupBy("_nkey").count().where("count > 1").limit(3).collect()
    if twice:
        raise ValueError(f"mapping keys must be unique; listed twice: {[r['_nkey'] for r in twice]}")
    joined = df.withColumn("_nkey", normalise_key(col)).join(m, "_nkey", "left")
    return joined.withColumn(col, F.coalesce(F.col("_canon"), F.trim(F.col(col)))).drop("_nkey", "_canon")


def letter_grams(name: Column) -> Column:
    """Distinct three-letter pieces of the words of a name, word ends marked. Case, hyphens and the order of words
    make no difference, a plural or a misspelt letter a small one."""
    words = F.filter(F.split(F.regexp_replace(F.lower(name), "[^\\p{L}\\p{N}]+", " "), " "), lambda w: w != "")
    pieces = F.transform(words, lambda w: F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.substring(F.concat(F.lit("#"), w, F.lit("#")), i, 3)))
    return F.array_distinct(F.flatten(pieces))


def similar_names(names: DataFrame, percent: int = 50) -> DataFrame:
    """Pairs ``a < b`` of ``key`` values whose pieces overlap by at least ``percent`` hundredths (common / all), with the overlap.

    Two such names share one of the rarest pieces of each: with n pieces, of the first n - ceil(percent n / 100) + 1 in order of
    frequency. Only these are joined, so pieces that most names have make no pairs; candidates are then compared in full."""
    sets = materialise(names.select("key", letter_grams(F.col("key")).alias("grams")).where("size(grams) > 0"), "name-grams")
    posts = sets.select("key", F.size("grams").alias("n"), F.explode("grams").alias("gram"))
    often = posts.groupBy("gram").agg(F.count(F.lit(1)).alias("often"))
    rare = posts.join(often, "gram").groupBy("key", "n").agg(F.array_sort(F.collect_list(F.struct("often", "gram"))).alias("order"))
    first = F.slice("order", F.lit(1), (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).cast("int"))
    heads = materialise(rare.select("key", "n", F.explode(first).alias("p")).select("key", "n", F.col("p.gram").alias("gram")), "name-heads")
    other = heads.select(F.col("key").alias("b"), F.col("n").alias("m"), "gram")
    near = (F.col("key") < F.col("b")) & (100 * F.least("n", "m") >= percent * F.greatest("n", "m"))
    met = heads.withColumnRenamed("key", "a").join(other, "gram").withColumnRenamed("a", "key").where(near).select(F.col("key").alias("a"), "b").distinct()
    full = met.join(sets.select(F.col("key").alias("a"), F.col("grams").alias("ga")), "a").join(sets.select(F.col("key").alias("b"), F.col("grams").alias("gb")), "b")
    common = F.size(F.array_intersect("ga", "gb"))
    whole = F.size("ga") + F.size("gb") - common
    return full.where(100 * common >= percent * whole).select("a", "b", (common / whole).alias("overlap"))


def propose_categories(names: DataFrame, percent: int = 50) -> DataFrame:
    """``key, name, canonical, overlap, n, sources, status`` of every name that is like another.

    ``names``: ``name, source, n`` (uses). Names with one key (case, blanks) are one; its name is the most used form. Similar keys are joined into
    groups, also through others between them, which is why the table is to be reviewed. ``canonical`` is the group's most used name."""
    used = names.where("name IS NOT NULL").groupBy(F.trim("name").alias("name")).agg(F.sum("n").alias("n"), F.collect_set("source").alias("from"))
    form = F.min_by("name", F.struct(-F.col("n"), F.col("name")))
    keys = used.groupBy(normalise_key("name").alias("key")).agg(
        form.alias("name"), F.sum("n").alias("n"), F.size(F.array_distinct(F.flatten(F.collect_list("from")))).alias("sources"), F.count(F.lit(1)).alias("forms"))
    keys = materialise(keys, "category-keys")
    pairs = materialise(similar_names(keys, percent), "similar-names")
    ends = pairs.select(F.col("a").alias("key"), "overlap").unionByName(pairs.select(F.col("b").alias("key"), "overlap"))
    best = ends.groupBy("key").agg(F.max("overlap").alias("overlap"))
    grouped = keys.join(components(pairs).withColumnRenamed("node", "key"), "key", "left").join(best, "key", "left")
    grouped = grouped.where("component IS NOT NULL OR forms > 1").withColumn("component", F.coalesce("component", "key"))
    head = grouped.groupBy("component").agg(F.min_by("name", F.struct(-F.col("n"), -F.col("sources"), F.col("name"))).alias("canonical"))
    out = grouped.join(head, "component")
    return out.select("key", "name", "canonical", F.coalesce("overlap", F.lit(1.0)).alias("overlap"), "n", F.col("sources").cast("long").alias("sources"),
                      F.lit(PROPOSED).alias("status"))
