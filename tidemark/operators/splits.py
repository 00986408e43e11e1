"""Train/dev/test membership as one ``split`` column, from one specification of how rows are dealt."""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..fixed_values import (
    ID_COLUMNS, SAVED_ID_COLUMNS, SAVED_TARGET_COLUMNS, SPLIT_INDICATOR_COLUMNS, SUBSCRIPTION_ID_COLUMNS,
)
from ..functions.columns import md5_number
from ..session import materialise
from .quantiles import grouped_ranks

#: Classes whose cut-off keys are broadcast.
BROADCAST_CLASSES = 1_000_000


class EmptySplitError(ValueError):
    pass


@dataclass(frozen=True)
class SplitSpec:
    """Either by date (``test_after`` is set) or by draw; checked when it is made, never later.

    By date, days after ``test_after`` are test and those after ``dev_after`` dev. By draw, ``test`` and ``dev``
    are shares of the rows, kept in every class. Without a dev rule there are two parts. ``or_draw`` names the error
    in a date rule's outcome that makes the rows be drawn instead.
    """

    test: float = 1.0 - 0.7 - 0.15
    dev: float | None = 0.15
    seed: int = 42
    date_col: str | None = None
    test_after: str | None = None
    dev_after: str | None = None
    or_draw: type[Exception] | None = None

    def __post_init__(self):
        shares = [self.test, *([] if self.dev is None else [self.dev])]
        if min(shares) <= 0 or sum(shares) >= 1:
            raise ValueError(f"shares of test and dev must be positive and leave rows to train: {shares}")
        if (self.date_col is None) != (self.test_after is None):
            raise ValueError("a split by date needs date_col and the last day before test")

    @classmethod
    def configured(cls, config: Mapping, dataset: str = "telco", parts: int = 3, date_col: str | None = None) -> SplitSpec:
        """From a run's ``split`` settings: strategy, sizes, seed, date column and its two last days.

        Sizes default to .70 train and .15 dev; test is what they leave unless given. Subscription data split by date unless told
        otherwise, but tables of two parts by draw.
        """
        given = {k: v for k, v in config.items() if v is not None}
        train, dev = float(given.get("train_size", 0.70)), float(given.get("dev_size", 0.15))
        test = float(given.get("test_size", 1.0 - train - dev))
        if train <= 0 or train + dev + test > 1.0 + 1e-8:
            raise ValueError("split sizes must be positive and add up to 1 at most")
        drawn = cls(test, dev if parts == 3 else None, int(given.get("random_state", 42)))
        usual = "time" if dataset.lower() == "subscription" and parts == 3 else "random"
        strategy = given.get("strategy", usual)
        if strategy == "random":
            return drawn
        if strategy != "time":
            raise ValueError(f"unknown split strategy '{strategy}'")
        # Three parts fall back when asked to, whatever is wrong; two parts unless told not to, when a part is empty.
        error = ValueError if parts == 3 else EmptySplitError
        falls_back = given.get("fallback", "none" if parts == 3 else "random") == "random"
        days = {"date_col": given.get("date_col", date_col), "test_after": given.get("dev_end"), "dev_after": given.get("train_end") if parts == 3 else None}
        if None in (days["date_col"], days["test_after"]) or parts == 3 and days["dev_after"] is None:
            if falls_back and parts == 3:
                return drawn
            raise ValueError("a split by date needs date_col, dev_end and, for three parts, train_end")
        return replace(drawn, **days, or_draw=error if falls_back else None)

    @property
    def names(self) -> list[str]:
        second = self.dev_after if self.test_after else self.dev
        return ["train", "test"] if second is None else ["train", "dev", "test"]


def assign(df: DataFrame, spec: SplitSpec, label: str, id_col: str) -> DataFrame:
    """``df`` with its ``split`` column. By date, rows without one fall out, and one aggregate finds empty parts."""
    if spec.test_after is None:
        return _drawn(df, spec, label, id_col)
    try:
        return _dated(df, spec)
    except Exception as error:
        if spec.or_draw is None or not isinstance(error, spec.or_draw):
            raise
        warnings.warn(f"{error}; rows are drawn instead", stacklevel=2)
        return _drawn(df, spec, label, id_col)


def test_rows(df: DataFrame, spec: SplitSpec, label: str, id_col: str) -> DataFrame:
    """The rows that ``assign`` calls test, without the column. By date only these are looked at."""
    if spec.test_after is None:
        return _drawn(df, spec, label, id_col).filter("split = 'test'").drop("split")
    late = _by_date(df, spec).filter("split = 'test'").drop("split")
    if late.isEmpty():
        raise EmptySplitError(f"no row is later than {spec.test_after}")
    return late


test_rows.__test__ = False  # not a test


def _by_date(df: DataFrame, spec: SplitSpec) -> DataFrame:
    if spec.date_col not in df.columns:
        raise ValueError(f"no column {spec.date_col} to split by")
    day = F.col(spec.date_col).try_cast("date")
    part = F.when(day > F.lit(spec.test_after).cast("date"), "test")
    if spec.dev_after is not None:
        part = part.when(day > F.lit(spec.dev_after).cast("date"), "dev")
    return df.withColumn("split", part.otherwise("train")).filter(day.isNotNull())


def _dated(df: DataFrame, spec: SplitSpec) -> DataFrame:
    out = _by_date(df, spec)
    found = out.agg(F.collect_set("split")).first()[0]
    if missing := [part for part in spec.names if part not in found]:
        raise EmptySplitError(f"split by date leaves {' and '.join(missing)} empty")
    return out


def split_key(id_col: str, seed: int) -> Column:
    """A 60-bit number per id and seed: the order in which rows are drawn."""
    return md5_number(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")), 15)


def _allotted(classes: DataFrame, label: str, n: str, share: Column, name: str) -> DataFrame:
    """Adds ``name``: ceil of ``share`` of all ``n``, shared over the classes in proportion, the largest remainders first.

    The windows run over one row per class.
    """
    everything = Window.partitionBy()
    exact = classes.withColumn("_all", F.sum(n).over(everything)).withColumn("_part", F.ceil(F.col("_all") * share))
    exact = exact.withColumn("_exact", (F.col("_part") * F.col(n)).cast("double") / F.col("_all")).withColumn("_floor", F.floor("_exact"))
    order = Window.orderBy(F.col("_floor") - F.col("_exact"), F.col(label).cast("string"))
    spare = F.col("_part") - F.sum("_floor").over(everything)
    given = F.col("_floor") + (F.row_number().over(order) <= spare).cast("bigint")
    return exact.withColumn(name, F.coalesce(given, F.lit(0))).drop("_all", "_part", "_exact", "_floor")


def _drawn(df: DataFrame, spec: SplitSpec, label: str, id_col: str) -> DataFrame:
    """Exact counts per class that move no rows: of a class the smallest draw keys are test and the next ones dev.

    A row per class and part holds its cut-off key; the split is a comparison with those of the row's class.
    """
    counts = df.groupBy(F.col(label).alias("_class")).agg(F.count("*").alias("_n"))
    sized = _allotted(counts, "_class", "_n", F.lit(spec.test), "_test")
    if spec.dev is not None:
        rest = sized.withColumn("_rest", F.col("_n") - F.col("_test"))
        sized = _allotted(rest, "_class", "_rest", F.lit(spec.dev / (1.0 - spec.test)), "_dev")
    upto = {"test": F.col("_test") - 1} | ({} if spec.dev is None else {"dev": F.col("_test") + F.col("_dev") - 1})
    wanted = F.array(*[F.struct(F.lit(part).alias("part"), rank.alias("rank")) for part, rank in upto.items()])
    ranks = sized.select("_class", F.explode(wanted).alias("w")).select("_class", "w.part", "w.rank")
    keyed = df.select(F.col(label).alias("_class"), split_key(id_col, spec.seed).alias("value"))
    cuts = grouped_ranks(keyed, "_class", ranks).groupBy("_class").pivot("part", list(upto)).agg(F.first("value"))
    cuts = materialise(cuts.select(F.col("_class").alias("_cut_class"), *[F.col(p).alias(f"_cut_{p}") for p in upto]), "cuts")
    if cuts.count() <= BROADCAST_CLASSES:  # a row per class; with more of them the rows are joined by class
        cuts = F.broadcast(cuts)
    marked = df.withColumn("_draw", split_key(id_col, spec.seed)).join(cuts, F.col(label).eqNullSafe(F.col("_cut_class")), "left")
    part = F.lit("train")
    for name in reversed(upto):
        part = F.when(F.col("_draw") <= F.col(f"_cut_{name}"), name).otherwise(part)
    return marked.select(*df.columns, part.alias("split"))


# ---------------------------------------------------------------- saved splits


class SavedSplit:
    """A stored split: which of its rows are test, and the rows of other data that they name."""

    def __init__(self, stored: DataFrame):
        self.stored = stored

    @property
    def test(self) -> DataFrame:
        """By the indicator column if there is one, else by the flag; a table with neither is all test."""
        present = [c for c in SPLIT_INDICATOR_COLUMNS if c in self.stored.columns]
        tests = [F.contains(F.lower(F.col(c).cast("string")), F.lit("test")) for c in present]
        tests += [F.col("is_test").cast("boolean")] if "is_test" in self.stored.columns else []
        return self.stored.filter(tests[0]) if tests else self.stored

    def _column(self, names: list[str | None]) -> str | None:
        return next((c for c in names if c in self.stored.columns), None)

    def complete(self, features: list[str]) -> bool:
        return not set(features).difference(self.stored.columns)

    def own_rows(self, features: list[str], target: str, label: str, like: DataFrame) -> DataFrame:
        """Its own test rows, the target under the name and type that ``label`` has in ``like``."""
        source = self._column([target, *SAVED_TARGET_COLUMNS])
        if source is None:
            raise ValueError(f"the saved split has the features but no target such as {target}")
        return self.test.select(*features, F.col(source).cast(like.schema[label].dataType).alias(label))

    def named_rows(self, df: DataFrame, id_col: str | None) -> DataFrame:
        """The rows of ``df`` whose ids are among its test ids, compared as text."""
        source = self._column([id_col, *SAVED_ID_COLUMNS])
        if id_col is None or source is None:
            raise ValueError("the saved split shares no id with the data")
        ids = self.test.select(F.col(source).cast("string").alias("_saved_id"))
        rows = df.join(ids, F.col(id_col).cast("string") == F.col("_saved_id"), "left_semi")
        if rows.isEmpty():
            raise ValueError("no row of the data has an id of the saved split")
        return rows

    def select(self, df: DataFrame, features: list[str], id_col: str | None, target: str, label: str) -> DataFrame:
        return self.own_rows(features, target, label, df) if self.complete(features) else self.named_rows(df, id_col)


# ---------------------------------------------------------------- columns


def find_id_column(columns: list[str], dataset: str) -> str | None:
    candidates = (SUBSCRIPTION_ID_COLUMNS if dataset == "subscription" else []) + ID_COLUMNS
    return next((c for c in candidates if c in columns), None)


def validate_features(columns: list[str], expected: list[str] | None) -> None:
    """Raise when the feature columns differ from those the model was trained on."""
    if not expected:
        return
    missing, extra = sorted(set(expected) - set(columns)), sorted(set(columns) - set(expected))
    if missing or extra:
        raise ValueError(f"feature columns differ from training; missing: {missing}, unexpected: {extra}")
