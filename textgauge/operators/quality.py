"""Table quality gate: five checks and their report.

Every check returns a DataFrame with a boolean ``passed``.  An empty table has null ratios and fails.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textgauge.config import QualityConfig
from textgauge.functions import text as X
from textgauge.functions.digests import row_digest, text_digest

DEFAULT = QualityConfig()


def check_schema(df: DataFrame, config: QualityConfig = DEFAULT) -> DataFrame:
    """One row per actual or expected column; only a missing required column fails."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = [*actual, *sorted((set(config.expected_columns) | set(config.required_columns)) - set(actual))]
    passed = set(config.required_columns) <= set(actual)

    def row(name: str) -> Column:
        if name in actual:
            status = "expected" if name in config.expected_columns else "extra"
        else:
            status = "missing required" if name in config.required_columns else "missing"
        return F.struct(
            F.lit(name).alias("column"),
            F.lit(actual.get(name)).cast("string").alias("dtype"),
            F.lit(status).alias("status"),
            F.lit(passed).alias("passed"),
        )

    rows = df.agg(F.count(F.lit(1)).alias("n_rows"), F.array(*[row(c) for c in wanted]).alias("_r"))
    return rows.select("n_rows", F.inline("_r"))


def check_quality(df: DataFrame, config: QualityConfig = DEFAULT) -> DataFrame:
    """Null shares, duplicate rows, empty rows and the quality score in one row.

    Equal rows have equal nulls, so the grouping that finds duplicates counts the nulls as well: one pass.
    """
    empty = F.lit(all(isinstance(f.dataType, T.StringType) for f in df.schema.fields))
    for c in df.columns:
        empty = empty & F.coalesce(F.col(c) == "", F.lit(False))
    missing = {f"_m{i}": F.col(c).isNull() for i, c in enumerate(df.columns)}
    groups = (
        df.select(row_digest(df, df.columns).alias("_d"), empty.alias("_e"), *[m.alias(name) for name, m in missing.items()])
        .groupBy("_d")
        .agg(F.count(F.lit(1)).alias("_n"), F.bool_or("_e").alias("_e"), *[F.bool_or(name).alias(name) for name in missing])
    )

    def rows(condition: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col(condition), F.col("_n"))), F.lit(0))

    nulls = [rows(name) for name in missing]
    n = F.coalesce(F.sum("_n"), F.lit(0))
    row = groups.agg(
        n.alias("n_rows"),
        F.array(*nulls).alias("_nulls"),
        (n - F.count(F.lit(1))).alias("duplicate_rows"),
        rows("_e").alias("empty_rows"),
    )
    some = F.col("n_rows") > 0
    worst = F.when(some, F.array_max("_nulls").cast("double") / F.col("n_rows"))
    repeated = F.when(some, F.col("duplicate_rows").cast("double") / F.col("n_rows"))
    over = F.size(F.filter("_nulls", lambda k: k.cast("double") / F.col("n_rows") > config.max_null_fraction))
    return row.select(
        "n_rows",
        worst.alias("worst_null_share"),
        F.when(some, over).otherwise(0).cast("bigint").alias("high_null_columns"),
        "duplicate_rows",
        repeated.alias("duplicate_share"),
        "empty_rows",
        (1.0 - worst - repeated).alias("quality_score"),
        (some & (F.coalesce(worst, F.lit(0.0)) <= config.max_null_fraction)).alias("passed"),
    )


def check_text(df: DataFrame, config: QualityConfig = DEFAULT, approximate: bool = False) -> DataFrame:
    """Length limits, blank texts and diversity; a null text reads as ``None``.

    Copies of a text are combined first, so one grouping by digest serves every figure.  ``approximate``
    counts distinct texts with a sketch instead, which needs no grouping; all other figures stay exact.
    """
    text = F.coalesce(F.col(config.text), F.lit("None"))
    texts = df.select(text_digest(text).alias("_d"), X.char_count(text).alias("_l"), X.is_blank(text).alias("_b"))
    if approximate:
        texts = texts.withColumn("_n", F.lit(1))
        distinct = F.approx_count_distinct("_d", 0.01)
    else:
        texts = texts.groupBy("_d").agg(
            F.count(F.lit(1)).alias("_n"), F.max("_l").alias("_l"), F.bool_or("_b").alias("_b")
        )
        distinct = F.count(F.lit(1))

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("_n"))), F.lit(0))

    n = F.coalesce(F.sum("_n"), F.lit(0))
    short, long = F.col("_l") < config.min_length, F.col("_l") > config.max_length
    out = texts.agg(
        n.alias("n_rows"),
        F.min("_l").alias("min_length"),
        F.max("_l").alias("max_length"),
        (F.sum(F.col("_l") * F.col("_n")).cast("double") / F.nullif(n, F.lit(0))).alias("mean_length"),
        rows(short).alias("too_short"),
        rows(long).alias("too_long"),
        rows(~short & ~long).alias("within_range"),
        rows(F.col("_b")).alias("empty_texts"),
        distinct.alias("unique_texts"),
        F.when(n > 0, distinct.cast("double") / n).alias("diversity"),
    )
    passed = (F.col("too_short") == 0) & (F.col("too_long") == 0) & (F.col("empty_texts") == 0)
    return out.withColumn("passed", (F.col("n_rows") > 0) & passed)


def check_labels(df: DataFrame, config: QualityConfig = DEFAULT) -> DataFrame:
    """One row per found or expected label; unexpected and null labels fail."""
    found = df.groupBy(F.col(config.label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    kind = dict(found.dtypes)["label"]
    expected = found.agg(F.count(F.lit(1)).alias("_")).select(
        F.explode(F.array(*[F.lit(x).cast(kind) for x in config.expected_labels])).alias("label"),
        F.lit(0).cast("bigint").alias("n"),
    )
    rows = found.unionByName(expected).groupBy("label").agg(F.sum("n").alias("n"))
    status = (
        F.when(F.col("label").isNull(), "null")
        .when(~F.col("label").isin(*config.expected_labels), "unexpected")
        .when(F.col("n") == 0, "missing")
        .otherwise("expected")
    )
    return rows.withColumn("status", status).withColumn("passed", ~F.col("status").isin("null", "unexpected"))


def check_classes(df: DataFrame, config: QualityConfig = DEFAULT) -> DataFrame:
    """Rows and percentage per class, sufficiency, and the balance of all classes."""
    counts = df.groupBy(F.col(config.label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").cast("double")).scalar()
    # Tested together with the count, the null filter stays above the grouping and all three uses share it.
    labelled = counts.where(F.when(F.col("label").isNull(), 0).otherwise(F.col("n")) > 0)
    low, high, classes = F.min("n"), F.max("n"), F.count(F.lit(1))
    ratio = F.when(classes < 2, F.lit(1.0)).otherwise(low.cast("double") / high)
    overall = labelled.agg(F.struct(ratio.alias("ratio"), (low >= config.min_class_rows).alias("ok")).alias("_o")).scalar()
    return (
        labelled.withColumn("_t", total)
        .withColumn("_o", overall)
        .select(
            "label",
            "n",
            (F.col("n") * 100.0 / F.col("_t")).alias("percent"),
            (F.col("n") >= config.min_class_rows).alias("sufficient"),
            F.col("_o.ratio").alias("balance_ratio"),
            (F.col("_o.ratio") >= config.min_balance).alias("is_balanced"),
            F.col("_o.ok").alias("passed"),
        )
    )


def validation_report(df: DataFrame, config: QualityConfig = DEFAULT) -> DataFrame:
    """(check, metric, value, passed): one row per check and a summary row.

    A check whose column is absent fails.  Read the table from storage rather than from a long lazy
    plan: the checks scan it several times.
    """
    schema_ok = set(config.required_columns) <= set(df.columns)
    columns = {config.text, config.label} <= set(df.columns)

    def verdict(name: str, metric: str, rows: DataFrame, value: Column, passed: Column) -> DataFrame:
        return rows.agg(value.cast("double").alias("value"), F.coalesce(passed, F.lit(False)).alias("passed")).select(
            F.lit(name).alias("check"), F.lit(metric).alias("metric"), "value", "passed"
        )

    all_passed = F.bool_and("passed")
    checks = [
        verdict("schema", "rows", df, F.count(F.lit(1)), F.lit(schema_ok)),
        verdict("data_quality", "quality_score", check_quality(df, config), F.max("quality_score"), all_passed),
    ]
    if config.text in df.columns:
        checks.append(verdict("text_content", "diversity", check_text(df, config), F.max("diversity"), all_passed))
    if config.label in df.columns:
        checks.append(verdict("labels", "failed_labels", check_labels(df, config), F.count_if(~F.col("passed")), all_passed))
        checks.append(verdict("class_distribution", "balance_ratio", check_classes(df, config), F.max("balance_ratio"), all_passed))
    if not columns:
        absent = [("text_content", config.text), ("labels", config.label), ("class_distribution", config.label)]
        for name, column in absent:
            if column not in df.columns:
                checks.append(verdict(name, "column_missing", df, F.lit(None), F.lit(False)))
    rows = checks[0]
    for check in checks[1:]:
        rows = rows.unionByName(check)
    summary = rows.agg(
        (F.count_if("passed").cast("double") / F.count(F.lit(1))).alias("value"), F.bool_and("passed").alias("passed")
    ).select(F.lit("summary").alias("check"), F.lit("success_rate").alias("metric"), "value", "passed")
    return rows.unionByName(summary)
