"""Cleaning: normalised fields, exact duplicates, fuzzy duplicates merged field by field.

Row order is meaning here ("keep the first"), so every frame carries `_row_ord`; nothing sorts between steps.

Defined results: NULL equals NULL in the exact key but never in linkage; a row without name and website is linked to
nothing; ties in completeness go to the smaller `_row_ord`; extra columns are kept and merged like the others; an empty
table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import text as X
from ledgerloom.functions.nulls import clean_str
from ledgerloom.functions.similarity import similar_pairs, sorted_words
from ledgerloom.operators.graph import connected_components
from ledgerloom.runtime import cut
from ledgerloom.schema import STANDARD_COLUMNS, Settings

ORD = "_row_ord"
NORMALISERS = {
    "name": X.norm_name,
    "company_name": X.norm_name,
    "website": X.norm_domain,
    "linkedin": X.norm_linkedin,
    "facebook": lambda c: X.norm_social(c, "facebook"),
    "twitter": lambda c: X.norm_social(c, "twitter"),
    "instagram": lambda c: X.norm_social(c, "instagram"),
    "email": X.norm_email,
    "phone": X.norm_phone,
}


def with_order(df: DataFrame) -> DataFrame:
    return df if ORD in df.columns else df.withColumn(ORD, F.monotonically_increasing_id())


def coerce_and_trim(df: DataFrame) -> DataFrame:
    """Every text column trimmed, NA words as NULL."""
    texts = [c for c, kind in df.dtypes if kind == "string"]
    return df.withColumns({c: clean_str(F.col(c)) for c in texts})


def normalise(df: DataFrame) -> DataFrame:
    """All fields in canonical form; what has no canonical form becomes NULL."""
    return df.withColumns({c: F.nullif(f(F.col(c)), F.lit("")) for c, f in NORMALISERS.items() if c in df.columns})


def filled(df: DataFrame, but: tuple[str, ...] = (ORD,)) -> Column:
    """Number of columns that aren't NULL."""
    cols = [c for c in df.columns if c not in but]
    return sum((F.col(c).isNotNull().cast("int") for c in cols[1:]), F.col(cols[0]).isNotNull().cast("int"))


def drop_exact_duplicates(df: DataFrame, keys=("name", "website", "linkedin")) -> DataFrame:
    """Of rows with equal keys the one with most filled columns, then the first.

    A grouped maximum, not a window: a key held by a third of all rows is combined on the map side.
    """
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(filled(df).alias("n"), (-F.col(ORD)).alias("o"))
    best = df.groupBy(*keys).agg(F.max(F.struct(order.alias("order"), *rest)).alias("b"))
    return best.select(*[F.col(c) if c in keys else F.col(f"b.{c}").alias(c) for c in df.columns])


def match_edges(df: DataFrame, threshold: float) -> DataFrame:
    """a, b: rows of one entity, as a star per equal website and per equal sorted name, plus links of similar names.

    All sides grow with the rows, and files of written steps are several times smaller than their rows in memory, so no side
    is left to be broadcast for its estimated size.
    """
    rows = df.select(F.col(ORD).alias("i"), "website", sorted_words(F.col("name")).alias("key"))

    def star(c: str) -> DataFrame:
        first = rows.filter(F.col(c).isNotNull()).groupBy(c).agg(F.min("i").alias("first"))
        return rows.join(first.hint("merge"), c).filter("i != first").select(F.col("i").alias("a"), F.col("first").alias("b"))

    first = cut(rows.filter("key IS NOT NULL").groupBy("key").agg(F.min("i").alias("first")))
    pairs = similar_pairs(first, threshold)
    left = first.select(F.col("key").alias("left"), F.col("first").alias("a"))
    right = first.select(F.col("key").alias("right"), F.col("first").alias("b"))
    similar = pairs.join(left.hint("merge"), "left").join(right.hint("merge"), "right").select("a", "b")
    return star("website").unionByName(star("key")).unionByName(similar)


def cluster(df: DataFrame, threshold: float = 90) -> DataFrame:
    """df with `cluster`, the smallest `_row_ord` of each row's entity."""
    comp = connected_components(match_edges(df, threshold))
    return (
        df.join(comp.withColumnRenamed("node", ORD).hint("merge"), ORD, "left")
        .withColumn("cluster", F.coalesce("component", ORD))
        .drop("component")
    )


def merge_clusters(df: DataFrame) -> DataFrame:
    """One row per cluster: per column the first value in order of confidence, filled columns and arrival.

    Internal columns (`_...`) of merged rows become NULL; single rows stay as they are.
    """
    data = [c for c in df.columns if c not in (ORD, "cluster")]
    score = F.coalesce(F.col("confidence_score").cast("string").try_cast("double"), F.lit(-1e300))
    order = F.struct(score.alias("s"), filled(df, (ORD, "cluster")).alias("n"), (-F.col(ORD)).alias("o"))
    x = df.withColumn("_order", order)
    aggs = []
    for c in data:
        if c.startswith("_"):
            aggs.append(F.when(F.count(F.lit(1)) == 1, F.max(c)).alias(c))
        elif c == "confidence_score":
            best = F.max(F.col(c).cast("string").try_cast("double"))
            kept = F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_order")))
            aggs.append(
                F.when(F.count(F.lit(1)) == 1, kept).otherwise(F.coalesce(best.try_cast("int").cast("string"), kept)).alias(c)
            )
        else:
            aggs.append(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_order"))).alias(c))
    return x.groupBy("cluster").agg(F.min(ORD).alias(ORD), *aggs).select(ORD, *data)


def clean(df: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Trim, normalise, drop exact duplicates, merge fuzzy ones."""
    s = settings or Settings()
    x = cut(drop_exact_duplicates(normalise(coerce_and_trim(with_order(df)))))
    return merge_clusters(cluster(x, s.fuzzy_threshold))


def with_fullness(df: DataFrame) -> DataFrame:
    """df with `_filled`, the number of a row's filled columns, which the output order goes by."""
    return df.withColumn("_filled", filled(df.drop("_filled"), (ORD,)))


def in_output_order(df: DataFrame) -> DataFrame:
    """Rows as they are written out: fuller ones first, then in order of arrival. Only a sink sorts."""
    x = df if "_filled" in df.columns else with_fullness(df)
    return x.orderBy(F.desc("_filled"), ORD)


def clean_dataframe(df: DataFrame) -> DataFrame:
    return clean(df)


def standard_columns(df: DataFrame) -> DataFrame:
    """Exactly the standard columns; missing ones are ''."""
    return df.select(*[F.col(c) if c in df.columns else F.lit("").alias(c) for c in STANDARD_COLUMNS])


