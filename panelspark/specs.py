"""Declarative specs: grains, metric families, quality bounds and the raw catalog.

A family is data, not code: one generic pipeline (``plans.panels``) runs
every family at every grain from these specs.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values (must equal the source system's conventions) -------------
GRAINS = ["metro", "state", "county", "city", "zip"]
GRAIN_FILTER = {"metro": "msa", "state": "state", "county": "county", "city": "city", "zip": "zip"}
GRAIN_LABEL = {
    "metro": "Metro Area (MSA)",
    "state": "State",
    "county": "County",
    "city": "City",
    "zip": "ZIP Code",
}
# File-name region token per grain in the raw catalog.
CATALOG_REGIONS = ["Metro", "State", "County", "City", "Zip"]

# pandas 2.x default NA tokens: read_csv turns these cells into NULL in every column.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Date-format patterns of the validators (Python ``re.match`` semantics).
YEAR_RE = r"^\d{4}$"
QUARTER_RE = r"^\d{4}-Q[1-4]$"
MONTH_RE = r"^\d{4}-(0[1-9]|1[0-2])$"
WEEK_RE = r"^\d{4}-W(0[1-9]|[1-4]\d|5[0-3])$"
DATE_RE = r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])$"
# ---------------------------------------------------------------------------

KEY_COLUMNS = ["date", "region_id"]
NOT_NULL_COLUMNS = ["date", "region_id", "region_name"]


@dataclass(frozen=True)
class Family:
    name: str
    variants: dict  # raw prefix -> value column, first variant defines the grid
    title: str
    description: str
    column_descriptions: dict
    ranges: dict  # value column -> (lo, hi); None = open side
    min_year: int
    max_year: int
    min_rows: dict  # grain -> floor
    default_min_rows: int
    not_null_values: tuple = ()
    positive: tuple = ()  # strictly > 0

    @property
    def value_columns(self) -> list:
        return list(self.variants.values())

    def dataset_id(self, grain: str) -> str:
        return f"{self.name}_{grain}"

    def metadata(self, grain: str, columns: list) -> dict:
        label = GRAIN_LABEL[grain]
        descs = {
            "date": "End of month date (YYYY-MM-DD)",
            "region_id": "Region identifier",
            "region_name": f"{label} name",
            "state_code": "Two-letter US state code",
            **self.column_descriptions,
        }
        # Describe only columns that exist: a missing variant must not make
        # publishing fail after the data is written.
        return {
            "id": self.dataset_id(grain),
            "title": f"{self.title} by {label}",
            "description": self.description.format(label=label.lower()),
            "column_descriptions": {k: v for k, v in descs.items() if k in columns},
        }


# --- fixed values: the four families (variant files -> columns, column
# descriptions, value bounds, year windows, row floors per grain) ------------
HOME_VALUE = Family(
    name="home_value",
    variants={
        "zhvi_all_homes": "all_homes",
        "zhvi_sfr": "single_family",
        "zhvi_condo": "condo",
        "zhvi_1bed": "bed_1",
        "zhvi_2bed": "bed_2",
        "zhvi_3bed": "bed_3",
        "zhvi_4bed": "bed_4",
        "zhvi_5bed_plus": "bed_5_plus",
        "zhvi_bottom_tier": "bottom_tier",
        "zhvi_top_tier": "top_tier",
    },
    title="Home Value Index",
    description="Home value index by {label}: typical home value for property types, bedroom counts and price tiers.",
    column_descriptions={
        "all_homes": "Typical home value for all homes (SFR + Condo), mid-tier (35th-65th percentile)",
        "single_family": "Typical home value for single-family residences, mid-tier",
        "condo": "Typical home value for condos/co-ops, mid-tier",
        "bed_1": "Typical home value for 1-bedroom homes",
        "bed_2": "Typical home value for 2-bedroom homes",
        "bed_3": "Typical home value for 3-bedroom homes",
        "bed_4": "Typical home value for 4-bedroom homes",
        "bed_5_plus": "Typical home value for 5+ bedroom homes",
        "bottom_tier": "Typical home value for bottom-tier (5th-35th percentile)",
        "top_tier": "Typical home value for top-tier (65th-95th percentile)",
    },
    ranges={c: (0, 50_000_000) for c in [
        "all_homes", "single_family", "condo", "bed_1", "bed_2", "bed_3", "bed_4",
        "bed_5_plus", "bottom_tier", "top_tier"]},
    min_year=1990,
    max_year=2030,
    min_rows={"metro": 10000, "state": 1000, "county": 50000, "city": 100000, "zip": 500000},
    default_min_rows=1000,
)

RENT = Family(
    name="rent",
    variants={"zori": "rent"},
    title="Observed Rent Index",
    description="Observed rent index by {label}: typical observed market rate rent.",
    column_descriptions={"rent": "Typical monthly rent in USD"},
    ranges={"rent": (100, 200_000)},
    min_year=2010,
    max_year=2030,
    min_rows={"metro": 5000, "state": 500, "county": 10000, "city": 50000, "zip": 100000},
    default_min_rows=500,
    not_null_values=("rent",),
    positive=("rent",),
)

INVENTORY = Family(
    name="inventory",
    variants={
        "inventory_for_sale": "for_sale_inventory",
        "new_listings": "new_listings",
        "new_pending": "new_pending",
    },
    title="Housing Inventory",
    description="Housing inventory metrics by {label}: for-sale inventory, new listings and new pending sales.",
    column_descriptions={
        "for_sale_inventory": "Number of for-sale listings active during the month",
        "new_listings": "Number of new listings during the month",
        "new_pending": "Number of listings that went pending during the month",
    },
    ranges={c: (0, 10_000_000) for c in ["for_sale_inventory", "new_listings", "new_pending"]},
    min_year=2010,
    max_year=2030,
    min_rows={"metro": 5000, "state": 500, "county": 20000, "city": 50000, "zip": 100000},
    default_min_rows=500,
)

SALES = Family(
    name="sales",
    variants={
        "median_list_price": "median_list_price",
        "median_sale_price": "median_sale_price",
        "sales_count": "sales_count",
        "pct_sold_above_list": "pct_sold_above_list",
        "pct_sold_below_list": "pct_sold_below_list",
        "days_to_pending": "days_to_pending",
        "price_cut_share": "pct_price_cut",
    },
    title="Sales Metrics",
    description="Sales and pricing metrics by {label}: list and sale prices, sales counts, days to pending, price cuts.",
    column_descriptions={
        "median_list_price": "Median list price in USD",
        "median_sale_price": "Median sale price in USD",
        "sales_count": "Estimated number of sales (nowcast)",
        "pct_sold_above_list": "Percent of sales above final list price",
        "pct_sold_below_list": "Percent of sales below final list price",
        "days_to_pending": "Mean days from listing to pending",
        "pct_price_cut": "Percent of listings with a price cut",
    },
    ranges={
        "median_list_price": (0, 100_000_000),
        "median_sale_price": (0, 100_000_000),
        "pct_sold_above_list": (0, 100),
        "pct_sold_below_list": (0, 100),
        "pct_price_cut": (0, 100),
        "days_to_pending": (0, 365),
        "sales_count": (0, None),
    },
    min_year=2010,
    max_year=2030,
    min_rows={"metro": 5000, "state": 500, "county": 20000, "city": 50000, "zip": 100000},
    default_min_rows=500,
)

# ---------------------------------------------------------------------------

FAMILIES = {f.name: f for f in (HOME_VALUE, RENT, INVENTORY, SALES)}


@dataclass(frozen=True)
class CatalogEntry:
    dataset_id: str
    folder: str
    pattern: str  # "{region}" placeholder
    description: str = ""


# --- fixed values: raw catalog (folder, file pattern) per metric -----------
CATALOG = [
    CatalogEntry("zhvi_all_homes", "zhvi", "{region}_zhvi_uc_sfrcondo_tier_0.33_0.67_sm_sa_month.csv", "Home value, all homes, mid tier"),
    CatalogEntry("zhvi_sfr", "zhvi", "{region}_zhvi_uc_sfr_tier_0.33_0.67_sm_sa_month.csv", "Home value, single family, mid tier"),
    CatalogEntry("zhvi_condo", "zhvi", "{region}_zhvi_uc_condo_tier_0.33_0.67_sm_sa_month.csv", "Home value, condo, mid tier"),
    CatalogEntry("zhvi_1bed", "zhvi", "{region}_zhvi_bdrmcnt_1_uc_sfrcondo_tier_0.33_0.67_sm_sa_month.csv", "Home value, 1 bedroom"),
    CatalogEntry("zhvi_2bed", "zhvi", "{region}_zhvi_bdrmcnt_2_uc_sfrcondo_tier_0.33_0.67_sm_sa_month.csv", "Home value, 2 bedroom"),
    CatalogEntry("zhvi_3bed", "zhvi", "{region}_zhvi_bdrmcnt_3_uc_sfrcondo_tier_0.33_0.67_sm_sa_month.csv", "Home value, 3 bedroom"),
    CatalogEntry("zhvi_4bed", "zhvi", "{region}_zhvi_bdrmcnt_4_uc_sfrcondo_tier_0.33_0.67_sm_sa_month.csv", "Home value, 4 bedroom"),
    CatalogEntry("zhvi_5bed_plus", "zhvi", "{region}_zhvi_bdrmcnt_5_uc_sfrcondo_tier_0.33_0.67_sm_sa_month.csv", "Home value, 5+ bedroom"),
    CatalogEntry("zhvi_bottom_tier", "zhvi", "{region}_zhvi_uc_sfrcondo_tier_0.0_0.33_sm_sa_month.csv", "Home value, bottom tier"),
    CatalogEntry("zhvi_top_tier", "zhvi", "{region}_zhvi_uc_sfrcondo_tier_0.67_1.0_sm_sa_month.csv", "Home value, top tier"),
    CatalogEntry("zori", "zori", "{region}_zori_uc_sfrcondomfr_sm_sa_month.csv", "Observed rent index"),
    CatalogEntry("inventory_for_sale", "invt_fs", "{region}_invt_fs_uc_sfrcondo_sm_month.csv", "For-sale inventory"),
    CatalogEntry("new_listings", "new_listings", "{region}_new_listings_uc_sfrcondo_sm_month.csv", "New listings count"),
    CatalogEntry("new_pending", "new_pending", "{region}_new_pending_uc_sfrcondo_sm_month.csv", "New pending sales"),
    CatalogEntry("median_list_price", "mlp", "{region}_mlp_uc_sfrcondo_sm_month.csv", "Median list price"),
    CatalogEntry("median_sale_price", "median_sale_price", "{region}_median_sale_price_uc_sfrcondo_sm_sa_month.csv", "Median sale price"),
    CatalogEntry("sales_count", "sales_count_now", "{region}_sales_count_now_uc_sfrcondo_month.csv", "Sales count nowcast"),
    CatalogEntry("pct_sold_above_list", "pct_sold_above_list", "{region}_pct_sold_above_list_uc_sfrcondo_sm_month.csv", "Percent sold above list"),
    CatalogEntry("pct_sold_below_list", "pct_sold_below_list", "{region}_pct_sold_below_list_uc_sfrcondo_sm_month.csv", "Percent sold below list"),
    CatalogEntry("days_to_pending", "mean_doz_pending", "{region}_mean_doz_pending_uc_sfrcondo_sm_month.csv", "Mean days to pending"),
    CatalogEntry("price_cut_share", "perc_listings_price_cut", "{region}_perc_listings_price_cut_uc_sfrcondo_sm_month.csv", "Percent of listings with a price cut"),
]
# ---------------------------------------------------------------------------
