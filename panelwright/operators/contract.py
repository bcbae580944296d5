"""What a scoring request looks like and which values it may hold."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions.numeric import col, stripped
from panelwright.operators.extrapolate import TREND_METHODS


@dataclass(frozen=True)
class RequestFeature:
    """A request field: its panel column, fallback value and allowed range."""

    name: str
    column: str
    default: float
    low: float
    high: float


@dataclass(frozen=True)
class Contract:
    features: tuple[RequestFeature, ...]
    target: str
    period_feature: str = "year"
    period_low: int = 1960
    period_high: int = 2100
    scenario_low: int = 2020
    shares: tuple[str, ...] = ()   # fields whose sum may not exceed ``share_limit``
    share_limit: float = 100.0
    model_name_length: int = 50
    max_span: int = 100
    scenario_period: int = 2030    # asked for when a scenario request names no period

    @property
    def model_features(self) -> list[str]:
        return [self.period_feature, *[f.column for f in self.features]]


# The published serving contract - names, fallbacks and ranges.
WATER_STRESS = Contract(
    features=(
        RequestFeature(
            "water_productivity",
            "Water productivity, total (constant 2015 US$ GDP per cubic meter of total freshwater withdrawal)",
            8.0, 0.0, 100.0),
        RequestFeature(
            "freshwater_withdrawals_agriculture",
            "Annual freshwater withdrawals, agriculture (% of total freshwater withdrawal)",
            75.0, 0.0, 100.0),
        RequestFeature(
            "freshwater_withdrawals_industry",
            "Annual freshwater withdrawals, industry (% of total freshwater withdrawal)",
            5.0, 0.0, 100.0),
        RequestFeature(
            "renewable_freshwater_resources",
            "Renewable internal freshwater resources, total (billion cubic meters)",
            4.195, 0.0, 1000.0),
    ),
    target="Level of water stress: freshwater withdrawal as a proportion of available freshwater resources",
    shares=("freshwater_withdrawals_agriculture", "freshwater_withdrawals_industry"),
)


def _outside(value: Column, low, high) -> Column:
    """True for present values outside the range; NaN counts as outside."""
    return value.isNotNull() & ~((value >= low) & (value <= high) & ~F.isnan(value.cast("double")))


def request_rules(contract: Contract, columns: list[str], models: list[str],
                  scenario: bool = False, period: str = "period") -> dict[str, Column]:
    """Rule code to violation test."""
    low = contract.scenario_low if scenario else contract.period_low
    rules = {
        "period_missing": col(period).isNull(),
        "period_range": _outside(col(period), low, contract.period_high),
    }
    for f in contract.features:
        if f.name in columns:
            rules[f"{f.name}_range"] = _outside(col(f.name), f.low, f.high)
    if contract.shares and set(contract.shares) <= set(columns):
        total = sum((col(s) for s in contract.shares[1:]), col(contract.shares[0]))
        rules["share_sum"] = F.coalesce(total > contract.share_limit, F.lit(False))
    if "model_name" in columns:
        named = stripped(col("model_name"))
        rules["model_name_length"] = F.length("model_name") > contract.model_name_length
        rules["model_unknown"] = (named != "") & ~named.isin(models)
    if scenario and "method" in columns:
        rules["method_unknown"] = ~col("method").isin(TREND_METHODS)
    return rules


def validate_requests(requests: DataFrame, contract: Contract, models: list[str],
                      scenario: bool = False, period: str = "period") -> DataFrame:
    """Add ``violations`` (codes of broken rules) and tidy the model name (stripped, blank is NULL).

    A scenario request without a method asks for ``linear``, one without a period
    for the contract's ``scenario_period``.
    """
    if "violations" in requests.columns:
        raise ValueError("request column name 'violations' is reserved")
    if scenario:
        requests = requests.withColumn(period, F.coalesce(col(period), F.lit(contract.scenario_period)))
        method = col("method") if "method" in requests.columns else F.lit(None).cast("string")
        requests = requests.withColumn("method", F.coalesce(method, F.lit(TREND_METHODS[0])))
    rules = request_rules(contract, requests.columns, models, scenario, period)
    out = requests.withColumn("violations", F.array_compact(F.array(*[
        F.when(test, F.lit(code)) for code, test in rules.items()
    ])))
    if "model_name" in requests.columns:
        named = stripped(col("model_name"))
        out = out.withColumn("model_name", F.when(named != "", named))
    return out


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean requests, and the rejected ones with their codes."""
    return checked.filter(F.size("violations") == 0).drop("violations"), checked.filter(F.size("violations") > 0)
