"""Per-column preprocessing: fit statistics with a few aggregates, apply them as one projection.

Fitting reads the table twice at most, once for all numeric moments and once for
all category counts, whatever the number of columns and folds. For
cross-validation the same two passes give the statistics of every training set:
moments of the other folds are merged with the parallel variance formula, and
category counts of the held-out fold are left out. No fold is copied.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce
from operator import add
from typing import Any

from pyspark import StorageLevel
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions.coerce import is_unparsable, to_number
from gridloom.operators.ranks import row_numbers
from gridloom.operators.typing import require_columns
from gridloom.sources.metadata import FeaturePlan
from gridloom.sources.writers import read_document, write_document

# How a dictionary is stored and looked up; none of these sizes changes a code.
LITERAL_CATEGORIES = 64  # dictionaries up to this size are written into the plan, larger ones are joined
COLLECTED_CATEGORIES = 10_000  # categories of one column the driver may hold; one-hot columns beyond are one sparse vector
COLLECTED_TOTAL = 200_000  # categories of all columns the driver may hold

# Codes of a category are ranks of mean labels, which a tree splits by threshold. Fixed value: rows of the overall mean
# that are added to each category, so that rare ones do not take the extremes.
CATEGORY_SMOOTH = 10.0
CATEGORY_BINS = 256  # codes that the learner tells apart
# A number that may be missing stands in the vector twice, missing below and above all others, so that a split can send it either way.
MISSING_LOW, MISSING_HIGH = -1e300, 1e300
HIGH_COPY = "__high"
NUMERIC_KINDS = ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double")

Moments = tuple[int, float, float]  # count, mean, sum of squared deviations


def merge_moments(parts: Iterable[Moments]) -> Moments:
    """Combine counts, means and squared deviations of disjoint row sets."""
    n, mean, m2 = 0, 0.0, 0.0
    for n_b, mean_b, m2_b in parts:
        if n_b == 0:
            continue
        total, delta = n + n_b, mean_b - mean
        mean += delta * n_b / total
        m2 += m2_b + delta * delta * n * n_b / total
        n = total
    return n, mean, m2


def fold_moments(df: DataFrame, columns: Sequence[str], fold: str | None = None) -> DataFrame:
    """Count, mean and population variance of every column, per fold, in one aggregate."""
    stats = []
    for i, name in enumerate(columns):
        column = F.col(f"`{name}`").cast("double")
        stats += [F.count(column).alias(f"n{i}"), F.avg(column).alias(f"mean{i}"), F.var_pop(column).alias(f"var{i}")]
    return (df.groupBy(fold) if fold else df.groupBy()).agg(*stats)


def category_counts(df: DataFrame, columns: Sequence[str], n_folds: int, fold: str | None = None, label: Column | None = None) -> DataFrame:
    """``(column_index, value, n, s)`` with one count and one sum of labels per fold; combined before the shuffle."""
    cells = F.array(*[F.struct(F.lit(i).alias("column_index"), F.col(f"`{c}`").cast("string").alias("value")) for i, c in enumerate(columns)])
    fold_column = F.col(fold) if fold else F.lit(0)
    long = df.select(fold_column.alias("fold"), (F.lit(0.0) if label is None else label).alias("y"), F.inline(cells))
    in_fold = [F.col("fold") == f for f in range(n_folds)]
    sums = [F.coalesce(F.sum(F.when(inside, F.col("y"))), F.lit(0.0)) for inside in in_fold]
    return long.groupBy("column_index", "value").agg(F.array(*[F.count_if(inside) for inside in in_fold]).alias("n"), F.array(*sums).alias("s"))


def smoothed(total: Any, n: Any, prior: Any) -> Any:
    """Mean label of a category, drawn towards the overall mean; for numbers and columns."""
    return (total + prior * CATEGORY_SMOOTH) / (n + CATEGORY_SMOOTH)


@dataclass
class FittedEncoder:
    """Fitted statistics of one training set."""

    plan: FeaturePlan
    moments: dict[str, tuple[float, float]] = field(default_factory=dict)  # mean, standard deviation
    modes: dict[str, str] = field(default_factory=dict)
    categories: dict[str, list[str]] = field(default_factory=dict)
    orders: dict[str, list[str | None]] = field(default_factory=dict)  # values of a plain category by code; None: missing
    unknown: dict[str, float] = field(default_factory=dict)  # code of missing and unknown values
    saw_missing: list[str] = field(default_factory=list)  # category columns with missing training cells
    remainder: list[str] = field(default_factory=list)
    kinds: dict[str, str] = field(default_factory=dict)  # Spark type of the remainder columns
    categorical_mappings: dict[str, Any] = field(default_factory=dict)
    dictionaries: dict[str, DataFrame] = field(default_factory=dict)  # value, code; too large for the driver

    # --- inputs ---

    @property
    def inputs(self) -> list[str]:
        """Columns the fitted expressions read."""
        plan = self.plan
        listed = [*plan.numeric, *plan.categorical, *plan.one_hot, *plan.binary]
        return list(dict.fromkeys([*listed, *self.remainder]))

    def _kept(self, names: Sequence[str], keep: bool) -> list[str]:
        return [name for name in names if (name in self.plan.keep_missing) == keep]

    # --- flat output ---

    def _scaled(self, name: str) -> Column:
        mean, std = self.moments[name]
        return F.coalesce((F.col(f"`{name}`").cast("double") - F.lit(mean)) / F.lit(std), F.lit(0.0))

    def _one_hot_names(self) -> list[tuple[str, str, list[str]]]:
        """(label, source feature, slot names) of every one-hot column, in output order."""
        out = []
        for keep in (False, True):
            for name in self._kept(self.plan.one_hot, keep):
                if keep or name in self.modes:
                    label = f"onehot_na__{name}" if keep else f"onehot__{name}"
                    names = [f"{label}_{c}" for c in self.categories.get(name, [])]
                    out.append((label, name, [*names, f"{label}_nan"] if keep and name in self.saw_missing else names))
        return out

    def _one_hot(self) -> list[tuple[str, Column, str]]:
        """One column per value; a sparse vector, added by :meth:`_with_wide`, for more than ``COLLECTED_CATEGORIES``."""
        slots = []
        for label, name, names in self._one_hot_names():
            known = self.categories.get(name, [])
            if len(known) > COLLECTED_CATEGORIES:
                slots.append((label, F.col(f"`{label}`"), name))
                continue
            value = F.col(f"`{name}`").cast("string")
            if name not in self.plan.keep_missing:
                value = F.coalesce(value, F.lit(self.modes[name]))
            slots += [(slot, F.coalesce((value == c).cast("double"), F.lit(0.0)), name) for slot, c in zip(names, known)]
            if len(names) > len(known):
                slots.append((names[-1], value.isNull().cast("double"), name))
        return slots

    def _with_wide(self, df: DataFrame) -> DataFrame:
        """Adds the sparse vectors, looked up in the dictionary; an unknown value has no entry."""
        for label, name, names in self._one_hot_names():
            known = self.categories.get(name, [])
            if len(known) <= COLLECTED_CATEGORIES:
                continue
            kept = name in self.plan.keep_missing
            value = F.col(f"`{name}`").cast("string")
            value = value if kept else F.coalesce(value, F.lit(self.modes[name]))
            df, found = self._joined(df, name, value, list(zip(known, map(float, range(len(known))))), label)
            missing = float(len(known)) if len(names) > len(known) else float(len(names))
            code = F.when(value.isNull(), F.lit(missing)).otherwise(F.coalesce(found, F.lit(float(len(names)))))
            column = f"__hot_{label}"
            df = df.withColumn(column, code.alias(column, metadata={"ml_attr": {"name": column, "type": "nominal", "num_vals": len(names)}}))
            # the place behind the last value is that of invalid ones, which is then left out
            encoder = OneHotEncoder(inputCol=column, outputCol=label, dropLast=True, handleInvalid="keep")
            df = encoder.fit(df).transform(df)
        return df

    @staticmethod
    def _joined(df: DataFrame, name: str, value: Column, dictionary: DataFrame | list, label: str) -> tuple[DataFrame, Column]:
        """``df`` with the code of ``value`` from a dictionary; a list's size is known, so Spark's own threshold decides about a broadcast."""
        if isinstance(dictionary, list):
            dictionary = df.sparkSession.createDataFrame(dictionary, "value string, code double")
        code, text, key = f"__code_{label}", f"__text_{label}", f"__key_{label}"
        right = dictionary.select(F.col("value").alias(key), F.col("code").alias(code))
        joined = df.withColumn(text, value).join(right, F.col(f"`{text}`") == F.col(f"`{key}`"), "left")
        return joined, F.col(f"`{code}`")

    def _numbers(self) -> list[tuple[str, Column, str]]:
        names = self._kept(self.plan.numeric, keep=False)
        return [(f"num__{name}", self._scaled(name), name) for name in names if name in self.moments]

    def _binaries(self) -> list[tuple[str, Column, str]]:
        names = self._kept(self.plan.binary, keep=False)
        return [(f"bin__{name}", F.coalesce(F.col(f"`{name}`").cast("double"), F.lit(0.0)), name) for name in names]

    def _plain_categories(self) -> list[str]:
        return [name for name in self._kept(self.plan.categorical, keep=False) if name in self.modes]

    def flat_columns(self) -> list[tuple[str, Column, str]]:
        """(output name, expression, source feature), in output order."""
        cats = [(f"cat__{c}", F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(self.modes[c])), c) for c in self._plain_categories()]
        rest = []
        for name in self.remainder:
            column = F.col(f"`{name}`")
            rest.append((f"remainder__{name}", column.cast("double") if self.kinds[name] == "boolean" else column, name))
        return [*self._numbers(), *cats, *self._one_hot(), *self._binaries(), *rest]

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """The transformed table: kept columns first, then the named feature columns.

        Missing cells of leave-as-missing features stay missing. Columns that were
        not fitted are ignored; fitted columns must exist. A one-hot column of more than
        ``COLLECTED_CATEGORIES`` values is one sparse vector.
        """
        require_columns(df, self.inputs, "feature columns")
        return self._with_wide(df).select(*[F.col(f"`{name}`") for name in keep], *[expr.alias(name) for name, expr, _ in self.flat_columns()])

    # --- model-ready output ---

    def _coded(self, name: str) -> bool:
        return name in self.orders or name in self.dictionaries

    def _code(self, df: DataFrame, name: str) -> tuple[DataFrame, Column]:
        """Category code of a column; missing and unknown values share one."""
        value, label = F.col(f"`{name}`").cast("string"), f"cat__{name}"
        if name in self._plain_categories():
            value = F.coalesce(value, F.lit(self.modes[name]))
        unknown = F.lit(float(self.unknown[name]))
        order = self.orders.get(name)
        if order is not None and len(order) <= LITERAL_CATEGORIES:
            values = F.array(*[F.lit(c) for c in order]).cast("array<string>")
            return df, F.coalesce((F.nullif(F.array_position(values, value), F.lit(0)) - 1).cast("double"), unknown)
        known = self.dictionaries[name] if order is None else [(c, float(i)) for i, c in enumerate(order) if c is not None]
        df, code = self._joined(df, name, value, known, label)
        return df, F.coalesce(code, unknown)

    def feature_frame(self, df: DataFrame, keep: Sequence[str] = (), out: str = "features") -> DataFrame:
        """Kept columns and one feature vector without missing entries.

        Leave-as-missing numbers stand in two slots, missing below and above all values; plain
        categories become the rank of their mean label. Both are split by threshold.
        """
        require_columns(df, self.inputs, "feature columns")
        df = self._with_wide(df)
        slots = [(name, expr) for name, expr, _ in self._numbers()]
        for name in self._plain_categories():
            df, code = self._code(df, name)
            slots.append((f"cat__{name}", code))
        slots += [(name, expr) for name, expr, _ in self._one_hot()]
        slots += [(name, expr) for name, expr, _ in self._binaries()]
        for name in self.remainder:
            label = f"remainder__{name}"
            if self._coded(name):
                df, code = self._code(df, name)
                slots.append((label, code))
            elif self.kinds[name] in NUMERIC_KINDS:
                value = F.col(f"`{name}`").cast("double")
                value = F.when(~F.isnan(value), value)
                slots += [(label, F.coalesce(value, F.lit(MISSING_LOW))), (f"{label}{HIGH_COPY}", F.coalesce(value, F.lit(MISSING_HIGH)))]
        flat = df.select(*[F.col(f"`{name}`") for name in keep], *[expr.alias(label) for label, expr in slots])
        return VectorAssembler(inputCols=[label for label, _ in slots], outputCol=out).transform(flat).select(*keep, out)

    def vector_slots(self) -> list[tuple[str, str]]:
        """(slot name, source feature) of every vector entry, in order."""
        slots = [(name, source) for name, _, source in self._numbers()]
        slots += [(f"cat__{name}", name) for name in self._plain_categories()]
        slots += [(name, source) for _, source, names in self._one_hot_names() for name in names]
        slots += [(name, source) for name, _, source in self._binaries()]
        for name in self.remainder:
            if self._coded(name):
                slots.append((f"remainder__{name}", name))
            elif self.kinds[name] in NUMERIC_KINDS:
                slots += [(f"remainder__{name}", name), (f"remainder__{name}{HIGH_COPY}", name)]
        return slots

    def max_arity(self) -> int:
        """Bins that the tree learner needs to tell category codes apart; 0 without categories."""
        return CATEGORY_BINS if any(map(self._coded, [*self._plain_categories(), *self.remainder])) else 0

    # --- persistence ---

    def to_dict(self) -> dict[str, Any]:
        state = {name: value for name, value in self.__dict__.items() if name not in ("plan", "dictionaries", "categorical_mappings")}
        state["plan"] = asdict(self.plan)
        state["dictionary_columns"] = sorted(self.dictionaries)
        return {"preprocessor": state, "categorical_mappings": self.categorical_mappings}

    @classmethod
    def from_dict(cls, document: dict[str, Any]) -> FittedEncoder:
        """Accepts the current document and the older bare one without the mappings."""
        state = dict(document.get("preprocessor", document))
        state.pop("dictionary_columns", None)
        plan = FeaturePlan(**state.pop("plan"))
        moments = {name: tuple(pair) for name, pair in state.pop("moments").items()}
        if "orders" not in state:  # older documents number plain categories by their names
            state["orders"] = {name: known for name, known in state["categories"].items() if name not in plan.one_hot}
            state["unknown"] = {name: float(len(known)) for name, known in state["orders"].items()}
        return cls(plan=plan, moments=moments, categorical_mappings=document.get("categorical_mappings", {}), **state)

    def save(self, spark: SparkSession, path: str) -> str:
        for i, name in enumerate(sorted(self.dictionaries)):
            self.dictionaries[name].write.mode("overwrite").parquet(f"{path}/dictionary_{i}")
        write_document(spark, self.to_dict(), f"{path}/state")
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FittedEncoder:
        document = read_document(spark, f"{path}/state")
        fitted = cls.from_dict(document)
        columns = document.get("preprocessor", document).get("dictionary_columns", [])
        fitted.dictionaries = {name: spark.read.parquet(f"{path}/dictionary_{i}") for i, name in enumerate(columns)}
        return fitted


class FeatureEncoder:
    """Unfitted preprocessing of the features in a plan.

    ``keep_unused`` also passes through columns that the plan does not use. Dictionaries of more than ``collected``
    values (``COLLECTED_CATEGORIES``) stay tables, with the same codes.
    """

    def __init__(self, plan: FeaturePlan, keep_unused: bool = False, collected: int | None = None):
        self.plan = plan
        self.keep_unused = keep_unused
        self.collected = collected

    def fit(self, df: DataFrame) -> FittedEncoder:
        """Fit on all rows."""
        return self._fit(df, None, 1)[0]

    def fit_folds(self, df: DataFrame, n_folds: int, fold: str = "fold") -> list[FittedEncoder]:
        """One fitted encoder per fold, each from the rows of the other folds."""
        return self._fit(df, fold, n_folds)

    def _remainder(self, df: DataFrame, fold: str | None) -> list[str]:
        plan = self.plan
        listed = [*plan.numeric, *plan.categorical, *plan.binary, *plan.one_hot]
        kept = set(plan.keep_missing) - set(plan.one_hot)
        skipped = {*plan.ids, plan.target, fold}
        unused = {c for c in df.columns if c not in listed and c not in skipped} if self.keep_unused else set()
        return [name for name in df.columns if name in kept or name in unused]

    def _fit(self, df: DataFrame, fold: str | None, n_folds: int) -> list[FittedEncoder]:
        plan = self.plan
        cats = [*plan.categorical, *plan.one_hot]
        require_columns(df, [*plan.numeric, *cats, *plan.binary], "feature columns")
        dtypes = dict(df.dtypes)
        remainder = self._remainder(df, fold)
        fitted = [FittedEncoder(plan, remainder=remainder, kinds={c: dtypes[c] for c in remainder}) for _ in range(n_folds)]
        if plan.numeric:
            self._fit_moments(df, fold, fitted)
        if cats:
            self._fit_categories(df, cats, fold, fitted)
        return fitted

    def _fit_moments(self, df: DataFrame, fold: str | None, fitted: list[FittedEncoder]) -> None:
        rows = fold_moments(df, self.plan.numeric, fold).collect()
        for f, encoder in enumerate(fitted):
            training = rows if fold is None else [row for row in rows if row[fold] != f]
            for i, name in enumerate(self.plan.numeric):
                parts = [(r[f"n{i}"], r[f"mean{i}"], r[f"var{i}"] * r[f"n{i}"]) for r in training if r[f"n{i}"]]
                n, mean, m2 = merge_moments(parts)
                if n:
                    std = math.sqrt(m2 / n)
                    # a constant column is centred only; rounding noise counts as constant
                    constant = std <= 10 * 2.220446049250313e-16 * max(abs(mean), 1e-300)
                    encoder.moments[name] = (mean, 1.0 if constant else std)

    def _label(self, df: DataFrame) -> Column:
        """The target as a number, 0 where it is none."""
        target = self.plan.target
        if target not in df.columns or not isinstance(df.schema[target].dataType, (T.NumericType, T.BooleanType)):
            return F.lit(0.0)
        return F.coalesce(F.col(f"`{target}`").cast("double"), F.lit(0.0))

    def _fit_categories(self, df: DataFrame, cats: list[str], fold: str | None, fitted: list[FittedEncoder]) -> None:
        n_folds = len(fitted)
        most = COLLECTED_CATEGORIES if self.collected is None else self.collected
        counts = category_counts(df, cats, n_folds, fold, self._label(df))

        def training(column: str, f: int) -> Column:
            parts = [F.col(column)[i] for i in range(n_folds) if fold is None or i != f]
            return reduce(add, parts) if parts else F.lit(0)

        # counts and label sums of the training set of every fold
        counts = counts.select("column_index", "value", *[F.array(*[training(c, f) for f in range(n_folds)]).alias(c) for c in ("n", "s")])
        counts = counts.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            sizes = {row["column_index"]: row["n"] for row in counts.groupBy("column_index").agg(F.count("*").alias("n")).collect()}
            # a one-hot column is as wide as its values, so the driver holds their names in any case
            collected = [i for i in sizes if cats[i] in self.plan.one_hot]
            total = 0
            for i in sorted(set(sizes) - set(collected), key=lambda i: (sizes[i], i)):
                if sizes[i] <= most and total + sizes[i] <= COLLECTED_TOTAL:
                    collected.append(i)
                    total += sizes[i]
            rows = counts.where(F.col("column_index").isin(collected)).collect() if collected else []
            by_column: dict[int, list[Any]] = {i: [] for i in collected}
            for row in rows:
                by_column[row["column_index"]].append(row)
            for i, entries in by_column.items():
                for f, encoder in enumerate(fitted):
                    self._fit_small(cats[i], {r["value"]: (r["n"][f], r["s"][f]) for r in entries if r["n"][f]}, encoder)
            for i in sorted(set(sizes) - set(collected)):
                for f, encoder in enumerate(fitted):
                    one = counts.where((F.col("column_index") == i) & (F.col("n")[f] > 0))
                    self._fit_large(one.select("value", F.col("n")[f].alias("n"), F.col("s")[f].alias("s")), cats[i], encoder)
        finally:
            counts.unpersist()

    def _fit_small(self, name: str, seen: dict[str | None, tuple[int, float]], encoder: FittedEncoder) -> None:
        """A dictionary on the driver, from counts and label sums of one training set."""
        present = {v: n for v, (n, _) in seen.items() if v is not None}
        if None in seen:
            encoder.saw_missing.append(name)
        if present:
            encoder.modes[name] = min(present, key=lambda v: (-present[v], v))
        if name in self.plan.one_hot:
            encoder.categories[name] = sorted(present)
            return
        if name not in self.plan.keep_missing and None in seen and present:  # missing cells become the mode
            (n, s), (m, t), mode = seen[None], seen[encoder.modes[name]], encoder.modes[name]
            seen = {**{v: x for v, x in seen.items() if v is not None}, mode: (n + m, s + t)}
        prior = sum(s for _, s in seen.values()) / max(1, sum(n for n, _ in seen.values()))
        means = {v: smoothed(s, n, prior) for v, (n, s) in seen.items()}
        order = sorted(means, key=lambda v: (means[v], v is not None, v or ""))
        encoder.categories[name] = sorted(present)
        encoder.orders[name] = order
        encoder.unknown[name] = float(order.index(None)) if None in seen else sum(m < prior for m in means.values()) - 0.5

    def _fit_large(self, counts: DataFrame, name: str, encoder: FittedEncoder) -> None:
        """The same dictionary as a table: the mode by an aggregate, codes numbered range by range."""
        totals = counts.agg(
            F.min(F.when(F.col("value").isNotNull(), F.struct((-F.col("n")).alias("n"), F.col("value"), F.col("s")))).alias("best"),
            F.max(F.when(F.col("value").isNull(), F.struct("n", "s"))).alias("missing"),
            F.sum("n").alias("n"), F.sum("s").alias("s"),
        ).first()
        best, missing = totals["best"], totals["missing"]
        if missing is not None:
            encoder.saw_missing.append(name)
        if best is not None:
            encoder.modes[name] = best["value"]
        rows, kept = counts, missing is not None
        if name not in self.plan.keep_missing and missing is not None and best is not None:
            at_mode = F.col("value") == best["value"]
            rows = rows.where(F.col("value").isNotNull()).withColumns(
                {"n": F.when(at_mode, F.col("n") + missing["n"]).otherwise(F.col("n")), "s": F.when(at_mode, F.lit(missing["s"]) + F.col("s")).otherwise(F.col("s"))}
            )
            kept = False
        prior = (totals["s"] or 0.0) / max(1, totals["n"] or 0)
        rows = rows.select("value", smoothed(F.col("s"), F.col("n"), F.lit(prior)).alias("m"))
        numbered = row_numbers(rows, [F.col("m"), F.col("value")], "__row").select("value", "m", (F.col("__row") - 1).cast("double").alias("code"))
        facts = numbered.agg(F.max(F.when(F.col("value").isNull(), F.col("code"))).alias("missing"), F.count_if(F.col("m") < prior).alias("below")).first()
        encoder.dictionaries[name] = numbered.where(F.col("value").isNotNull()).select("value", "code")
        encoder.unknown[name] = facts["missing"] if kept else facts["below"] - 0.5


def out_of_fold(df: DataFrame, fitted: Sequence[FittedEncoder], keep: Sequence[str], fold: str = "fold") -> DataFrame:
    """Scaled numbers and imputed plain categories of every row, with the statistics of its own training set.

    The per-fold statistics are short literal arrays indexed by the fold number, so
    all validation rows are encoded in one narrow pass instead of one pass per fold.
    """
    first = fitted[0]
    position = F.col(fold)
    columns = []
    for name in first._kept(first.plan.numeric, keep=False):
        stats = [encoder.moments.get(name) for encoder in fitted]
        mean = F.array(*[F.lit(s[0] if s else None).cast("double") for s in stats])[position]
        std = F.array(*[F.lit(s[1] if s else None).cast("double") for s in stats])[position]
        columns.append(F.coalesce((F.col(f"`{name}`").cast("double") - mean) / std, F.lit(0.0)).alias(f"num__{name}"))
    for name in first._kept(first.plan.categorical, keep=False):
        mode = F.array(*[F.lit(encoder.modes.get(name)).cast("string") for encoder in fitted])[position]
        columns.append(F.coalesce(F.col(f"`{name}`").cast("string"), mode).alias(f"cat__{name}"))
    return df.select(*[F.col(f"`{c}`") for c in keep], *columns)


# --- generic ordinal encoding ------------------------------------------------


def first_seen_dictionary(df: DataFrame, column: str, order: Sequence[str]) -> DataFrame:
    """``(value, code)``: the values of a column numbered 0, 1, … by the first row that holds them."""
    firsts = (
        df.select(F.col(f"`{column}`").cast("string").alias("value"), F.struct(*order).alias("first"))
        .groupBy("value")
        .agg(F.min("first").alias("first"))
    )
    numbered = row_numbers(firsts, [F.col("first"), F.col("value")], "__row")
    return numbered.select("value", (F.col("__row") - 1).alias("code"))


def apply_dictionary(df: DataFrame, column: str, dictionary: DataFrame, out: str) -> DataFrame:
    """Look codes up with a left join (missing is a value of its own); unseen values become NULL."""
    right = dictionary.select(F.col("value").alias("__value"), F.col("code").alias(out))
    return df.join(right, F.col(f"`{column}`").cast("string").eqNullSafe(F.col("__value")), "left").drop("__value")


def encode_non_numeric(
    df: DataFrame, columns: Sequence[str], order: Sequence[str], dictionaries: dict[str, DataFrame] | None = None
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Make text columns numeric: parsed if every value is a number, first-seen codes otherwise.

    Stored dictionaries are reused, new ones are returned with them, so that a later
    table is encoded alike. One aggregate decides about all columns.
    """
    known = dict(dictionaries or {})
    row = df.agg(*[F.count_if(is_unparsable(F.col(f"`{c}`").cast("string"))).alias(f"bad{i}") for i, c in enumerate(columns)]).first()
    for i, name in enumerate(columns):
        if row[f"bad{i}"] == 0 and name not in known:
            df = df.withColumn(name, to_number(F.col(f"`{name}`"), df.schema[name].dataType))
            continue
        if name not in known:
            known[name] = first_seen_dictionary(df, name, order)
        positions = df.columns
        df = apply_dictionary(df, name, known[name], "__code").drop(name).withColumnRenamed("__code", name).select(*positions)
    return df, known
