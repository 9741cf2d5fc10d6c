"""Feature metadata: one row per feature with its type, use, imputation, transformation and group."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.sources.spreadsheet import ROW, SUFFIXES, by_position, read_spreadsheet

# Attribute rows of the wide sheet, in sheet order, and accepted words.
ATTRIBUTES = ("type", "use", "imputation", "transformation", "super_category")
ATTRIBUTE_LABELS = {"category_transformation": "transformation"}
NUMERIC_TYPES = ("float", "number")
KEEP_MISSING_WORDS = ("leave as n/a", "unknown", "none", "nan", "")


def wide_to_long(sheet: DataFrame, label: str) -> DataFrame:
    """Transpose a sheet with one column per feature and one row per attribute."""
    features = [name for name in sheet.columns if name != label]
    attribute = F.lower(F.trim(F.col(f"`{label}`")))
    for alias, name in ATTRIBUTE_LABELS.items():
        attribute = F.when(attribute == alias, F.lit(name)).otherwise(attribute)
    text = sheet.select(attribute.alias("attribute"), *[F.col(f"`{name}`").cast("string").alias(name) for name in features])
    # names may hold dots, so the columns are quoted
    cells = text.select("attribute", F.inline(F.array(*[F.struct(F.lit(name).alias("feature_name"), F.col(f"`{name}`").alias("value")) for name in features])))
    table = cells.groupBy("feature_name").pivot("attribute", list(ATTRIBUTES)).agg(F.first("value"))
    return normalise(table)


def normalise(table: DataFrame) -> DataFrame:
    """The six metadata columns with their types; blank cells become empty text."""
    columns = [F.col("feature_name").cast("string").alias("feature_name")]
    for name in ATTRIBUTES:
        column = F.col(name) if name in table.columns else F.lit(None)
        if name == "use":
            columns.append(F.coalesce(column.cast("string").try_cast("double").cast("int"), F.lit(0)).alias("use"))
        else:
            columns.append(F.coalesce(column.cast("string"), F.lit("")).alias(name))
    return table.select(*columns)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Read a sheet (spreadsheet, CSV, JSON or Parquet) in the long or the wide layout.

    A wide spreadsheet whose rows are not labelled by attribute has them in the order of ``ATTRIBUTES``.
    """
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower()
    try:
        if suffix == "json":
            sheet = spark.read.json(path)
        elif suffix == "parquet":
            sheet = spark.read.parquet(path)
        elif suffix in SUFFIXES:
            sheet = read_spreadsheet(spark, path)
        else:
            sheet = spark.read.option("header", True).option("escape", '"').csv(path)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"feature metadata {path} not found") from err
        raise ValueError(f"cannot read feature metadata {path}: {err}") from err
    if "feature_name" in sheet.columns:
        return normalise(sheet)
    label = next((name for name in sheet.columns if name in ("Unnamed: 0", "_c0", "attribute")), None)
    if label is None and suffix not in SUFFIXES:
        raise ValueError(f"feature metadata {path} has neither a feature_name nor an attribute column")
    labels = {row[0] for row in sheet.select(F.lower(F.trim(F.col(f"`{label}`")))).collect()} if label else set()
    missing = set(ATTRIBUTES) - {ATTRIBUTE_LABELS.get(text, text) for text in labels}
    if missing and suffix in SUFFIXES:
        label = label or "Unnamed: 0"
        sheet = by_position(sheet, ATTRIBUTES, label)
    elif missing:
        raise ValueError(f"feature metadata {path} lacks the rows {sorted(missing)}")
    sheet = sheet.drop(ROW)
    order = {name: i for i, name in enumerate(n for n in sheet.columns if n != label)}
    position = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])[F.col("feature_name")]
    return wide_to_long(sheet, label).orderBy(position)


def route_features(metadata: DataFrame, ids: Iterable[str], target: str | None) -> DataFrame:
    """Which preprocessing group every used feature belongs to, as a table.

    Groups: num, cat, onehot, onehot_na, bin, remainder (kept as it is), none (type without a rule).
    """
    excluded = [*ids, *([target] if target else [])]
    keep = F.lower(F.coalesce("imputation", F.lit(""))).isin(*KEEP_MISSING_WORDS)
    numeric = F.col("type").isin(*NUMERIC_TYPES)
    one_hot = F.lower(F.coalesce("transformation", F.lit(""))) == "one-hot"
    group = (
        F.when((F.col("type") == "category") & one_hot, F.when(keep, F.lit("onehot_na")).otherwise(F.lit("onehot")))
        .when(numeric | F.col("type").isin("category", "bool"), F.when(keep, F.lit("remainder")))
        .otherwise(F.lit("none"))
    )
    group = F.coalesce(group, F.when(numeric, F.lit("num")).when(F.col("type") == "category", F.lit("cat")).otherwise(F.lit("bin")))
    used = metadata.where(F.col("use") == 1)
    if excluded:
        used = used.where(~F.col("feature_name").isin(*excluded))
    return used.select("feature_name", "type", group.alias("feature_group"), keep.alias("keep_missing"))


@dataclass
class FeaturePlan:
    """Feature lists that drive the generated expressions, in metadata order."""

    ids: list[str]
    target: str | None
    numeric: list[str] = field(default_factory=list)
    categorical: list[str] = field(default_factory=list)
    one_hot: list[str] = field(default_factory=list)
    binary: list[str] = field(default_factory=list)
    keep_missing: list[str] = field(default_factory=list)
    features: list[str] = field(default_factory=list)
    super_category: dict[str, str] = field(default_factory=dict)

    @classmethod
    def from_rows(cls, rows: Iterable[Mapping[str, Any]], ids: Iterable[str], target: str | None) -> FeaturePlan:
        plan = cls(list(ids), target)
        lists = {"category": plan.categorical, "bool": plan.binary, **dict.fromkeys(NUMERIC_TYPES, plan.numeric)}
        for row in rows:
            name = row["feature_name"]
            if row["use"] != 1 or name in plan.ids or name == target:
                continue
            plan.features.append(name)
            plan.super_category[name] = row["super_category"] or ""
            if row["type"] not in lists:
                continue
            one_hot = row["type"] == "category" and (row["transformation"] or "").lower() == "one-hot"
            (plan.one_hot if one_hot else lists[row["type"]]).append(name)
            if (row["imputation"] or "").lower() in KEEP_MISSING_WORDS:
                plan.keep_missing.append(name)
        return plan

    @classmethod
    def from_metadata(cls, metadata: DataFrame, ids: Iterable[str], target: str | None) -> FeaturePlan:
        """Collect the metadata: one row per column of the table, so bounded by its width."""
        return cls.from_rows([row.asDict() for row in metadata.collect()], ids, target)
