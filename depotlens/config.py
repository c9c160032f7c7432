"""Every constant that is part of the semantics, as one frozen parameter object."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from decimal import Decimal

# The fulfilment store dimension.
STORES = (
    ("LON", "London Dark Store", "Greater London", "United Kingdom", 51.5072, -0.1276, 8000, date(2020, 1, 15)),
    ("MAN", "Manchester Dark Store", "North West England", "United Kingdom", 53.4808, -2.2426, 6500, date(2020, 3, 1)),
    ("EDI", "Edinburgh Dark Store", "Scotland", "United Kingdom", 55.9533, -3.1883, 5000, date(2020, 6, 1)),
    ("DUB", "Dublin Dark Store", "Leinster", "Ireland", 53.3498, -6.2603, 4500, date(2020, 9, 1)),
    ("AMS", "Amsterdam Dark Store", "North Holland", "Netherlands", 52.3676, 4.9041, 7000, date(2021, 1, 10)),
    ("FAR", "Global Fallback Fulfillment", "N/A", "N/A", 51.5072, -0.1276, 3000, date(2021, 5, 1)),
)

# Countries served by the continental store.
CONTINENTAL_COUNTRIES = (
    "Germany",
    "France",
    "Netherlands",
    "Belgium",
    "Spain",
    "Switzerland",
    "Austria",
    "Portugal",
    "Italy",
    "Poland",
    "Denmark",
    "Sweden",
    "Finland",
    "Norway",
    "Czech Republic",
    "Greece",
    "Lithuania",
)


@dataclass(frozen=True)
class RoutingRule:
    """Home-country orders are hashed over ``home_stores``; other countries map to one store each."""

    home_country: str = "United Kingdom"
    home_stores: tuple[str, ...] = ("LON", "MAN", "EDI")
    country_groups: tuple[tuple[str, tuple[str, ...]], ...] = (
        ("DUB", ("Ireland", "EIRE")),
        ("AMS", CONTINENTAL_COUNTRIES),
    )
    fallback_store: str = "FAR"
    # A nullable integer key read as floating point prints as "17850.0"; turn on to hash that text.
    float_key_compat: bool = False


@dataclass(frozen=True)
class EngineConfig:
    routing: RoutingRule = field(default_factory=RoutingRule)
    stores: tuple[tuple, ...] = STORES

    # Transaction validation
    quantity_range: tuple[int, int] = (1, 100_000)
    price_range: tuple[Decimal, Decimal] = (Decimal("0.001"), Decimal("100000"))
    max_invalid_ratio: float = 0.02

    # Items: revenue is quantity x first price, or the sum over the lines
    line_revenue: bool = False

    # Panel and stock replay
    top_n_products: int = 150
    top_n_per_store: bool = False
    # Rank the top products on the days before this date only; the default looks at all days, test days included.
    top_as_of: date | None = None
    starting_stock: int = 300
    par_level: int = 300

    # Marts
    cogs_rate: Decimal = Decimal("0.42")
    opex_per_sqft: Decimal = Decimal("4.0")
    days_per_year: float = 365.0

    # Forecast
    test_start: date = date(2011, 10, 15)
    # The length of the test window; None lets it run to the end of the data, so replays hold every day since.
    test_days: int | None = 56
    min_density: float = 0.4
    seasonal_weeks: int = 4
    min_seasonal_lags: int = 1
    numeric_features: tuple[str, ...] = (
        "lag_1",
        "lag_7",
        "rolling_mean_7",
        "rolling_std_7",
        "day_of_week",
        "reference_unit_price",
    )
    categorical_features: tuple[str, ...] = ("store_id",)
    trees: int = 300
    tree_depth: int = 5
    learning_rate: float = 0.1
    seed: int = 7
    # Rolling origins of the model search: folds before the test window, and their length.
    search_folds: int = 3
    search_fold_days: int = 28
    model_name: str = "boosted_trees_demand_model"
    baseline_name: str = "seasonal_naive_dow"

    # Reorder policies
    lookahead_days: int = 7
    safety_z: float = 1.65
    max_restock: int | None = None
    fixed_policy: str = "fixed_restock_300"
    forecast_policy: str = "forecast_plus_safety_buffer"
