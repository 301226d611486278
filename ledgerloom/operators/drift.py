"""Schemas that drift between files: one table from files with changing headers, and a report of each change.

Tagged-union inference. Each file gets a schema of columns; each column a union of type tags (integer, decimal,
boolean, date, text) with the number of values behind every tag, gathered in one aggregation that merges on the map
side. Fusing the schemas keeps all alternatives per field: `one_table` has one row per record and one column per field
in canonical text, and beside it a typed branch per alternative where files disagree. `changes` compares each file with
the one delivered before it in its feed, `alternatives` lists the tags that appear in a column or vanish from it.

Defined results:
 - Missing values (NULL, blank, NA words) carry no tag; a column of nothing but missing values has no type and is no
   type change; the last known type of the same name in the feed stands in for it.
 - The type of a column is its most frequent tag; equal counts go to the more general tag (text, date, decimal,
   integer, boolean).
 - Records whose number of fields differs from the header's, or that are badly quoted, don't count and aren't loaded.
 - A header name used twice in one file counts once; in `one_table` the first of its columns that has a value counts.
   Files without records have columns but no types.
 - A removed and an added name of one file are a rename if their values have the same form, unless both names are known
   to stand for different fields; the same field by name alone is enough only where one side has no values or the values
   changed their form with the name. Each name is used at most once, pairs with equal field first, then in header order.
 - Files delivered at the same time follow file_id. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.nulls import clean_str
from ledgerloom.functions.records import header_field, header_names, split_record, well_quoted

TAGS = ("boolean", "integer", "decimal", "date", "text")


def type_tag(value: Column) -> Column:
    """Tag of a value that isn't missing."""
    return (
        F.when(value.rlike(r"(?i)^(true|false)$"), "boolean")
        .when(value.rlike(r"^[+-]?\d+$"), "integer")
        .when(value.rlike(r"^[+-]?(\d+\.\d*|\.\d+)([eE][+-]?\d+)?$"), "decimal")
        .when(value.rlike(r"^\d{4}-\d{2}-\d{2}$") & value.try_cast("date").isNotNull(), "date")
        .otherwise("text")
    )


def value_form(value: Column) -> Column:
    """Coarse form of a value, to recognise the same content under an unknown name."""
    return (
        F.when(value.rlike(r"(?i)linkedin\.|linkedin/"), "linkedin")
        .when(value.rlike(r"^[^\s@]+@[^\s@]+\.[^\s@]+$"), "email")
        .when(value.rlike(r"(?i)^(https?://)?[a-z0-9\-]+(\.[a-z0-9\-]+)+(:\d+)?([/?#].*)?$"), "website")
        .when(value.rlike(r"(?i)^(tel:?\s*)?[+(]?\d[\d\s().\-]{6,}$") & value.rlike(r"[\s+(\-]"), "phone")
        .when(value.rlike(r"^(18|19|20)\d{2}$"), "year")
        .when(value.rlike(r"[.!?…]$") | (F.size(F.split(value, r"\s+")) > 8), "prose")
        .otherwise(type_tag(value))
    )


FORMS = ("linkedin", "email", "website", "phone", "year", "prose")


def file_columns(files: DataFrame) -> DataFrame:
    """feed, file_id, delivery order and the header's names with their places."""
    return files.select(
        "feed",
        "file_id",
        "delivered_at",
        F.posexplode(header_names(F.col("header_line"), F.col("delimiter"))).alias("pos", "name"),
    )


def records(lines: DataFrame, files: DataFrame) -> DataFrame:
    """line_id, file_id and fields (_f) of all records that fit their header."""
    heads = files.select(
        "file_id",
        F.col("delimiter").alias("_d"),
        F.size(header_names(F.col("header_line"), F.col("delimiter"))).alias("_n"),
    )
    recs = lines.select("line_id", "file_id", "raw_line").join(heads, "file_id")
    recs = recs.filter(well_quoted(F.col("raw_line"), F.col("_d"))).select(
        "line_id", "file_id", "_n", split_record(F.col("raw_line"), F.col("_d")).alias("_f")
    )
    return recs.filter(F.size("_f") == F.col("_n")).select("line_id", "file_id", "_f")


def record_values(lines: DataFrame, files: DataFrame) -> DataFrame:
    """line_id, file_id, pos, value (NULL if missing) of all records that fit their header."""
    cells = records(lines, files).select("line_id", "file_id", F.posexplode("_f").alias("pos", "value"))
    return cells.withColumn("value", clean_str(F.col("value")))


def column_types(lines: DataFrame, files: DataFrame) -> DataFrame:
    """file_id, pos, union of tags with counts, the leading type and the leading form."""
    vals = record_values(lines, files).filter(F.col("value").isNotNull())
    tagged = vals.select("file_id", "pos", type_tag(F.col("value")).alias("tag"), value_form(F.col("value")).alias("form"))
    counts = [F.count_if(F.col("tag") == t).alias(t) for t in TAGS]
    form_counts = [F.count_if(F.col("form") == t).alias("f_" + t) for t in FORMS]
    g = tagged.groupBy("file_id", "pos").agg(*counts, *form_counts)
    best = F.greatest(*[F.col(t) for t in TAGS])
    kind = F.lit(None).cast("string")
    for t in ("boolean", "integer", "decimal", "date", "text"):
        kind = F.when((F.col(t) == best) & (best > 0), t).otherwise(kind)
    total = sum(F.col(t) for t in TAGS)
    form = kind
    for t in FORMS:
        form = F.when(F.col("f_" + t) * 2 > total, t).otherwise(form)
    union = F.map_filter(
        F.create_map(*[x for t in TAGS for x in (F.lit(t), F.col(t))]), lambda _, n: n > 0
    )
    return g.select("file_id", "pos", union.alias("union"), kind.alias("kind"), form.alias("form"))


def schemas(lines: DataFrame, files: DataFrame) -> DataFrame:
    """One row per file: feed, n (place in the feed) and cols, an array of (name, field, kind, form)."""
    cols = file_columns(files).join(column_types(lines, files), ["file_id", "pos"], "left")
    cols = cols.withColumn("field", header_field(F.col("name")))
    per_name = cols.groupBy("feed", "file_id", "delivered_at", "name").agg(
        F.min_by(F.struct("field", "kind", "form", "union"), "pos").alias("s"), F.min("pos").alias("pos")
    )
    # a column without values keeps the last known type of its name in the feed
    w = Window.partitionBy("feed", "name").orderBy("delivered_at", "file_id")
    known = F.last("s.kind", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    per_name = per_name.withColumn("known", known)
    return per_name.groupBy("feed", "file_id", "delivered_at").agg(
        F.collect_list(
            F.struct("name", "s.field", F.col("known").alias("kind"), "s.form", "s.union", "pos")
        ).alias("cols")
    )


def _ordered(lines: DataFrame, files: DataFrame) -> DataFrame:
    """file_id, cols and prev, the columns of the file before it in the feed; first files left out."""
    w = Window.partitionBy("feed").orderBy("delivered_at", "file_id")
    s = schemas(lines, files).withColumn("cols", F.array_sort("cols", lambda a, b: a["pos"] - b["pos"]))
    return s.withColumn("prev", F.lag("cols").over(w)).filter(F.col("prev").isNotNull()).select("file_id", "cols", "prev")


def _names(c) -> Column:
    return F.transform(c, lambda x: x["name"])


def _same_form(o: Column, n: Column) -> Column:
    return o["form"] == n["form"]


def _same_field(o: Column, n: Column) -> Column:
    return o["field"] == n["field"]


# What makes an old and a new column one, the strongest evidence first.
EVIDENCE = (
    lambda o, n: _same_form(o, n) & _same_field(o, n),
    lambda o, n: _same_form(o, n) & (o["field"].isNull() | n["field"].isNull()),
    lambda o, n: _same_field(o, n),
)


def _with_renames(s: DataFrame) -> DataFrame:
    """s with gone and new (columns without a partner) and pairs (names of renamed columns), one array expression per file."""
    s = s.withColumns(
        {
            "gone": F.filter("prev", lambda x: ~F.array_contains(_names("cols"), x["name"])),
            "new": F.filter("cols", lambda x: ~F.array_contains(_names("prev"), x["name"])),
            "pairs": F.array().cast("array<struct<o:string,n:string>>"),
        }
    )
    for same in EVIDENCE:
        start = F.struct(F.filter("gone", lambda x: F.lit(False)).alias("gone"), F.col("new").alias("new"), F.col("pairs").alias("pairs"))
        s = s.withColumn("_r", F.aggregate("gone", start, _pairing(same)))
        s = s.withColumns({c: F.col(f"_r.{c}") for c in ("gone", "new", "pairs")}).drop("_r")
    return s


def _pairing(same):
    """The step that takes an old column and pairs it with the first new one it is the same as."""

    def step(acc: Column, o: Column) -> Column:
        hit = F.get(F.filter(acc["new"], lambda n: F.coalesce(same(o, n), F.lit(False))), F.lit(0))
        pair = F.struct(o["name"].alias("o"), hit["name"].alias("n"))
        return F.struct(
            F.when(hit.isNull(), F.array_append(acc["gone"], o)).otherwise(acc["gone"]).alias("gone"),
            F.filter(acc["new"], lambda n: hit.isNull() | (n["name"] != hit["name"])).alias("new"),
            F.when(hit.isNull(), acc["pairs"]).otherwise(F.array_append(acc["pairs"], pair)).alias("pairs"),
        )

    return step


def _change(kind: str, old: Column, new: Column) -> Column:
    return F.struct(F.lit(kind).alias("change_kind"), old.alias("old_field"), new.alias("new_field"))


def changes(lines: DataFrame, files: DataFrame) -> DataFrame:
    """file_id, change_kind, old_field, new_field of every file against the one before it in its feed."""
    s = _with_renames(_ordered(lines, files))
    none = F.lit("")
    was = lambda x: F.get(F.filter("prev", lambda p: p["name"] == x["name"]), F.lit(0))["kind"]
    retyped = F.filter("cols", lambda x: F.coalesce(was(x) != x["kind"], F.lit(False)))
    found = F.concat(
        F.transform("gone", lambda x: _change("removed", x["name"], none)),
        F.transform("new", lambda x: _change("added", none, x["name"])),
        F.transform("pairs", lambda x: _change("renamed", x["o"], x["n"])),
        F.transform(retyped, lambda x: _change("type_changed", x["name"], x["name"])),
    )
    return s.select("file_id", F.explode(found).alias("c")).select("file_id", "c.*")


def alternatives(lines: DataFrame, files: DataFrame) -> DataFrame:
    """file_id, field, tag, change (appeared or vanished), n_values: tags of a column's union that the file before didn't
    have, or that it had alone (n_values counts in the file that has the tag). Renamed columns are compared with what they were."""
    s = _with_renames(_ordered(lines, files))
    old_name = lambda x: F.coalesce(F.get(F.filter("pairs", lambda p: p["n"] == x["name"]), F.lit(0))["o"], x["name"])
    both = F.transform(
        "cols", lambda x: F.struct(x["name"].alias("field"), x["union"].alias("now"), F.get(F.filter("prev", lambda p: p["name"] == old_name(x)), F.lit(0))["union"].alias("was"))
    )
    both = s.select("file_id", F.explode(both).alias("c")).select("file_id", "c.*").filter("now IS NOT NULL AND was IS NOT NULL")

    def only(a: str, b: str, change: str) -> Column:
        tags = F.filter(F.map_entries(a), lambda e: ~F.map_contains_key(b, e["key"]))
        return F.transform(tags, lambda e: F.struct(e["key"].alias("tag"), F.lit(change).alias("change"), e["value"].alias("n_values")))

    found = F.concat(only("now", "was", "appeared"), only("was", "now", "vanished"))
    return both.select("file_id", "field", F.explode(found).alias("t")).select("file_id", "field", "t.*")


def _fields(files: DataFrame) -> DataFrame:
    """file_id, pos, field (the canonical one, or the header's own name where it is unknown)."""
    return file_columns(files).select("file_id", "pos", F.coalesce(header_field(F.col("name")), F.col("name")).alias("field"))


def fused_schema(lines: DataFrame, files: DataFrame) -> dict[str, set[str]]:
    """Every field of all files with the union of its tags. As large as the set of header names."""
    tags = column_types(lines, files).select("file_id", "pos", F.map_keys("union").alias("tags"))
    fused = _fields(files).join(tags, ["file_id", "pos"], "left").groupBy("field")
    fused = fused.agg(F.array_distinct(F.flatten(F.collect_set("tags"))).alias("tags"))
    return {r["field"]: set(r["tags"]) for r in fused.collect()}


BRANCHES = {
    "integer": lambda v: v.try_cast("bigint"),
    "decimal": lambda v: v.try_cast("double"),
    "boolean": lambda v: F.lower(v) == "true",
    "date": lambda v: v.try_cast("date"),
}


def one_table(lines: DataFrame, files: DataFrame) -> DataFrame:
    """One row per readable record: line_id, file_id and every field of any file in canonical text, NULL where it is
    missing. A field that isn't of one type throughout has a typed branch per other tag, such as founded__date, beside it.
    """
    schema = fused_schema(lines, files)
    per_file = _fields(files).groupBy("file_id").agg(F.array_sort(F.collect_list(F.struct("pos", "field"))).alias("_cols"))
    recs = records(lines, files).join(per_file, "file_id")
    out = ["line_id", "file_id"]
    for field in sorted(schema):
        at = F.filter("_cols", lambda c: c["field"] == field)
        values = F.transform(at, lambda c: clean_str(F.get("_f", c["pos"])))
        recs = recs.withColumn("_v_" + field, F.get(F.array_compact(values), F.lit(0)))
        v = F.col(f"`_v_{field}`")
        out.append(v.alias(field))
        tags = schema[field]
        if len(tags) > 1:
            # a whole number is a decimal, too
            out += [
                F.when(type_tag(v).isin(t, *["integer"] * (t == "decimal")), BRANCHES[t](v)).alias(f"{field}__{t}") for t in BRANCHES if t in tags
            ]
    return recs.select(*out)
