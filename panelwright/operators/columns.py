"""Choosing columns: by list, by keyword, by type, by period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions.numeric import col, numeric_columns, present

# Default keywords, in priority order.
DEFAULT_FEATURE_KEYWORDS = [
    "renewable",
    "water productivity",
    "population",
    "urban",
    "rural",
    "agricultural land",
    "arable",
    "precipitation",
    "forest",
    "greenhouse",
]

# Name parts that mark indicators mathematically tied to the target.
FEATURE_BLACKLIST = [
    "annual freshwater withdrawals, agriculture",
    "annual freshwater withdrawals, domestic",
    "annual freshwater withdrawals, industry",
    "annual freshwater withdrawals, total",
    "level of water stress",
]

# Target name parts, preferred ones first.
TARGET_FIRST_CHOICE = ["water stress"]
TARGET_SECOND_CHOICE = ["freshwater", "withdraw"]


def select_features(df: DataFrame, names: list[str],
                    keys: list[str] = ["entity", "period"]) -> DataFrame:
    """Keys plus the existing columns of ``names``, in the order of ``names``."""
    chosen = [n for n in present(df, names) if n not in keys]
    return df.select(*[col(c) for c in [*present(df, keys), *chosen]])


def target_candidates(catalog: DataFrame, first: list[str] = TARGET_FIRST_CHOICE,
                      second: list[str] = TARGET_SECOND_CHOICE,
                      name: str = "indicator") -> DataFrame:
    """One row ``target``: best name by choice tier, then by name order; no row if none fits."""
    lower = F.lower(col(name))

    def any_of(words: list[str]):
        hit = F.lit(False)
        for w in words:
            hit = hit | lower.contains(w.lower())
        return hit

    tier = F.when(any_of(first), 1).when(any_of(second), 2)
    return (
        catalog.select(col(name).alias("target"), tier.alias("tier"))
        .filter("tier is not null")
        .agg(F.min_by("target", F.struct("tier", "target")).alias("target"))
        .filter("target is not null")
    )


def choose_target(catalog: DataFrame, **choices) -> str | None:
    found = target_candidates(catalog, **choices).first()
    return found["target"] if found else None


def keyword_columns(catalog: DataFrame, keywords: list[str] = DEFAULT_FEATURE_KEYWORDS,
                    max_features: int = 12, blacklist: list[str] = FEATURE_BLACKLIST,
                    name: str = "indicator") -> DataFrame:
    """Names matching a keyword, by (first keyword, name) order.

    ``catalog`` has one row per name.  ``max_features=0`` means no limit.
    """
    if max_features < 0:
        raise ValueError("max_features must be non-negative")
    lower = F.lower(col(name))
    blocked = F.lit(False)
    for b in blacklist:
        blocked = blocked | lower.contains(b.lower())
    priority = F.coalesce(*[
        F.when(lower.contains(k.lower()), F.lit(i)) for i, k in enumerate(keywords)
    ])
    hits = (
        catalog.filter(~blocked)
        .select(col(name).alias("feature"), priority.alias("keyword_pos"))
        .filter("keyword_pos is not null")
        .orderBy("keyword_pos", "feature")
    )
    return hits.limit(max_features) if max_features else hits


def choose_columns_by_keywords(catalog: DataFrame, keywords: list[str] = DEFAULT_FEATURE_KEYWORDS,
                               max_features: int = 12, blacklist: list[str] = FEATURE_BLACKLIST,
                               name: str = "indicator") -> list[str]:
    found = keyword_columns(catalog, keywords, max_features, blacklist, name)
    return [r["feature"] for r in found.collect()]


def modeling_frame(df: DataFrame, target: str, features: list[str] | None = None,
                   keywords: list[str] = DEFAULT_FEATURE_KEYWORDS, max_features: int = 12,
                   blacklist: list[str] = FEATURE_BLACKLIST,
                   keys: list[str] = ["entity", "period"]) -> DataFrame:
    """Narrow to keys, features and target.

    An explicit list overrides keywords; the target never is a feature; unknown
    names are dropped; a missing target is an error.
    """
    if target not in df.columns:
        raise ValueError(f"target {target!r} is not a column of the panel")
    if features is None:
        names = [c for c in df.columns if c not in keys]
        catalog = df.sparkSession.createDataFrame([(n,) for n in names], "indicator string")
        features = choose_columns_by_keywords(catalog, keywords, max_features, blacklist)
    chosen = [f for f in features if f != target]
    return select_features(df, [*chosen, target], keys)


def numeric_only(df: DataFrame, period: str = "period") -> DataFrame:
    """Numeric columns, the period excluded."""
    return df.select(*[col(c) for c in numeric_columns(df, [period])])


def first_features(df: DataFrame, target: str, k: int = 5,
                   keys: list[str] = ["entity", "period"]) -> list[str]:
    """The first ``k`` columns that are neither key nor target."""
    return [c for c in df.columns if c not in keys and c != target][:k]


def period_range(df: DataFrame, start: int | None = None, end: int | None = None,
                 period: str = "period") -> DataFrame:
    """Rows with ``start <= period <= end``; a plain comparison, so it reaches the scan."""
    if start is not None:
        df = df.filter(col(period) >= start)
    if end is not None:
        df = df.filter(col(period) <= end)
    return df


def add_year_column(df: DataFrame, period: str = "period", name: str = "year") -> DataFrame:
    """The period as an integer feature."""
    return df.withColumn(name, col(period).cast("int"))
