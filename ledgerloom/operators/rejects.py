"""Rows that fail to parse: load every record as nullable text, collect rule violations, split by them.

Each record of a delimited file is split under its own file's header by a quote-aware expression, every column stays
text, and the rules are evaluated as one array of reasons per row; an empty array is a loadable row. There is no Python
in the row path and one shuffle at most (records to their file's header; broadcast by Spark while the file list is
small).

Defined results:
 - NULL or empty record: one empty field, so `column_count` unless the header has one column; never dropped.
 - Records of a file that isn't in the file list: reason `no_header`.
 - Repeated records and redelivered files: each line_id is judged by itself.
 - Empty tables give empty results; extra columns are ignored, and a clash with a working column is impossible as only
   the named columns are read.
 - Very long records are matched with possessive patterns: no recursion, no backtracking.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.nulls import clean_str
from ledgerloom.functions.records import header_field, header_names, split_record, well_quoted
from ledgerloom.functions.text import EMAIL_RE, norm_domain


def judge_records(lines: DataFrame, files: DataFrame) -> DataFrame:
    """lines: line_id, file_id, line_no, raw_line. files: file_id, delimiter, header_line.

    Gives line_id, file_id, line_no, names and fields (arrays of text, side by side) and errors: the violated rules in
    order of precedence.
    """
    heads = files.select(
        "file_id",
        F.col("delimiter").alias("_d"),
        header_names(F.col("header_line"), F.col("delimiter")).alias("names"),
    ).withColumn("_kinds", F.transform("names", header_field))
    recs = (
        lines.select("line_id", "file_id", "line_no", F.coalesce("raw_line", F.lit("")).alias("_line"))
        .join(heads, "file_id", "left")
        .withColumn("_quoted", F.coalesce(well_quoted(F.col("_line"), F.col("_d")), F.lit(False)))
        .withColumn("fields", F.when(F.col("_quoted"), split_record(F.col("_line"), F.col("_d"))))
    )
    cells = F.arrays_zip(F.col("_kinds").alias("k"), F.col("fields").alias("v"))

    def wrong(cell):
        v = clean_str(cell["v"])
        return v.isNotNull() & (
            ((cell["k"] == "website") & (norm_domain(v) == "")) | ((cell["k"] == "email") & ~v.rlike(EMAIL_RE))
        )

    same_size = F.size("fields") == F.size("names")
    errors = F.array_compact(
        F.array(
            F.when(F.col("_d").isNull(), "no_header"),
            F.when(F.col("_d").isNotNull() & ~F.col("_quoted"), "quoting"),
            F.when(F.col("_quoted") & ~same_size, "column_count"),
            F.when(F.col("_quoted") & same_size & F.coalesce(F.exists(cells, wrong), F.lit(False)), "invalid_value"),
        )
    )
    return recs.select("line_id", "file_id", "line_no", "names", "fields", errors.alias("errors"))


def rejected(judged: DataFrame) -> DataFrame:
    return judged.filter(F.size("errors") > 0).select("line_id", F.element_at("errors", 1).alias("reason"))


LOADED_FIELDS = ("name", "website", "linkedin", "email", "phone", "description")


def loaded(judged: DataFrame) -> DataFrame:
    """The valid rows under canonical fields, all nullable text; every other column stays in the array `extra`.

    A field has the value of the first column that stands for it. `extra` holds name and value of all columns that gave
    no field, in the file's order: unknown ones, known ones outside LOADED_FIELDS and further columns of one field. It is
    an array and no map, as a header may name two columns alike.
    """
    ok = judged.filter(F.size("errors") == 0).withColumn("_kinds", F.transform("names", header_field))

    def pick(field: str):
        at = F.array_position("_kinds", field)
        return F.when(at > 0, clean_str(F.get("fields", (at - 1).cast("int")))).alias(field)

    cells = F.transform(
        F.arrays_zip("names", "fields", "_kinds"),
        lambda c, i: F.struct(
            c["names"].alias("name"),
            clean_str(c["fields"]).alias("value"),
            F.coalesce(
                c["_kinds"].isin(*LOADED_FIELDS) & (F.array_position("_kinds", c["_kinds"]) == i + 1), F.lit(False)
            ).alias("taken"),
        ),
    )
    extra = F.transform(
        F.filter(cells, lambda c: ~c["taken"]), lambda c: F.struct(c["name"].alias("name"), c["value"].alias("value"))
    )
    return ok.select("line_id", "file_id", "line_no", *[pick(f) for f in LOADED_FIELDS], extra.alias("extra"))


def judge_batches(batch_tables: list[DataFrame], files: DataFrame) -> DataFrame:
    cols = ["line_id", "file_id", "line_no", "raw_line"]
    lines = batch_tables[0].select(cols)
    for t in batch_tables[1:]:
        lines = lines.unionAll(t.select(cols))
    return judge_records(lines, files)
