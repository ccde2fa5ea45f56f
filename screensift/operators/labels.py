"""V1, V2, V7 (validation, predicates) and L1-L3 (labels)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from screensift.functions.text import is_blank


def parse_positive(value) -> int | float | str:
    """L2: positive-class literal typed as int, else float, else text (no truncation)."""
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, (int, float)):
        return value
    s = str(value).strip()
    try:
        return int(s)
    except ValueError:
        pass
    try:
        return float(s)
    except ValueError:
        return s


def positive_predicate(col: Column, dtype: T.DataType, positive) -> Column:
    v = parse_positive(positive)
    numeric = isinstance(dtype, (T.NumericType, T.BooleanType))
    if numeric:
        if isinstance(v, str):
            return F.lit(False)
        return col.cast("double") == F.lit(float(v))
    text_match = F.trim(col) == F.lit(str(positive).strip())
    if isinstance(v, (int, float)):
        return text_match | (col.try_cast("double") == F.lit(float(v)))
    return text_match


def binarize(df: DataFrame, label_col: str = "label", positive="1") -> DataFrame:
    """L1: label -> 1 when it equals the positive value, else 0 (NULL included)."""
    pred = positive_predicate(F.col(label_col), df.schema[label_col].dataType, positive)
    return df.withColumn(label_col, F.coalesce(pred, F.lit(False)).cast("int"))


def class_weight(labels: DataFrame, label_col: str = "label") -> DataFrame:
    """L3: (n_neg, n_pos, weight = n_neg / n_pos); fails clearly without positives."""
    agg = labels.agg(
        F.count_if(F.col(label_col) == 0).cast("bigint").alias("n_neg"),
        F.count_if(F.col(label_col) == 1).cast("bigint").alias("n_pos"),
    )
    return agg.withColumn(
        "weight",
        F.when(F.col("n_pos") == 0, F.raise_error(F.lit("class weight: no positive labels")))
        .otherwise(F.col("n_neg") / F.col("n_pos")).cast("double"),
    )


def weight_column(labels: DataFrame, weight: Column, label_col: str = "label") -> DataFrame:
    """Instance weight for Spark ML ``weightCol``: positives get n_neg/n_pos."""
    return labels.withColumn("weight", F.when(F.col(label_col) == 1, weight).otherwise(F.lit(1.0)))


def empty_rows(records: DataFrame, title: str = "title", abstract: str = "abstract") -> DataFrame:
    """V1 quarantine: rows whose title and abstract are both NULL/blank."""
    return records.filter(is_blank(F.col(title)) & is_blank(F.col(abstract)))


def empty_row_summary(records: DataFrame, title: str = "title", abstract: str = "abstract") -> DataFrame:
    bt, ba = is_blank(F.col(title)), is_blank(F.col(abstract))
    return records.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(bt).cast("bigint").alias("n_blank_title"),
        F.count_if(ba).cast("bigint").alias("n_blank_abstract"),
        F.count_if(bt & ba).cast("bigint").alias("n_empty"),
    )


def check_no_empty_rows(records: DataFrame, title: str = "title", abstract: str = "abstract") -> None:
    """V1: abort when any row is empty in both fields (fails fast on the first one)."""
    bad = empty_rows(records, title, abstract).select("doc_id").limit(1).collect()
    if bad:
        raise ValueError(f"row with empty title and abstract, doc_id={bad[0][0]}")


def row_conservation(inputs: DataFrame, outputs: DataFrame, part_col: str = "part") -> DataFrame:
    """V2: per part, rows in vs distinct doc_id out (they must be equal)."""
    n_in = inputs.groupBy(part_col).agg(F.count(F.lit(1)).alias("n_input"))
    n_out = outputs.groupBy(part_col).agg(F.countDistinct("doc_id").alias("n_output"))
    return n_in.join(n_out, part_col, "full").select(
        part_col,
        F.coalesce("n_input", F.lit(0)).cast("bigint").alias("n_input"),
        F.coalesce("n_output", F.lit(0)).cast("bigint").alias("n_output"),
    )


def threshold_predict(scores: DataFrame, threshold: float | Column, score_col: str = "score") -> DataFrame:
    """V7: pred = 1 when score >= threshold."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return scores.withColumn("pred", (F.col(score_col) >= t).cast("int"))
