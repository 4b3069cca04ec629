"""Display names of asset classes.

All tables below are fixed values: results depend on them literally. Codes
without a name are shown as their words.
"""

from __future__ import annotations

# --- fixed values: names of categories --------------------------------------------------------
CATEGORY_NAMES = {
    "ALT_COMMODITIES": "Alternatives: Commodities",
    "ALT_HEDGE_FUNDS": "Alternatives: Hedge Funds",
    "ALT_INFRASTRUCTURE": "Alternatives: Infrastructure",
    "ALT_PRIVATE_CREDIT": "Alternatives: Private Credit",
    "ALT_PRIVATE_EQUITY": "Alternatives: Private Equity",
    "ALT_REAL_ESTATE_GLOBAL": "Alternatives: Real Estate",
    "ALT_REAL_ESTATE_APAC": "Alternatives: Real Estate (APAC)",
    "ALT_REAL_ESTATE_NA": "Alternatives: Real Estate (North America)",
    "ALT_REAL_ESTATE_UK": "Alternatives: Real Estate (UK)",
    "ALT_REAL_ESTATE_EU": "Alternatives: Real Estate (EU)",
    "ALT_REAL_ESTATE_RESIDENTIAL": "Alternatives: Residential Real Estate",
    "ALT_RE_INFRA": "Alternatives: Real Estate/Infrastructure",
    "EQ_DM_CAPS": "Equities: Developed Market Caps",
    "EQ_DM": "Equities: Developed Markets",
    "EQ_EM": "Equities: Emerging Markets",
    "EQ_FACTORS": "Equities: Factors",
    "EQ_GEOS": "Equities: Geographies",
    "EQ_SECTORS": "Equities: Sectors",
    "EQ_THEMATICS": "Equities: Thematics",
    "FI_DURATION": "Fixed Income: Duration",
    "FI_GEO": "Fixed Income: Geography",
    "FI_HY": "Fixed Income: High Yield",
    "FI_IG": "Fixed Income: Investment Grade",
    "FI_SOV_GLOBAL": "Fixed Income: Sovereigns",
    "FI_SOV_APAC": "Fixed Income: Sovereigns (APAC)",
    "FI_SOV_EUROPE": "Fixed Income: Sovereigns (Europe)",
    "FI_SOV_NA": "Fixed Income: Sovereigns (North America)",
    "FI_SOV_US": "Fixed Income: US Sovereigns",
    "FI_SPECIALTY": "Fixed Income: Specialty",
    "FX_CURRENCIES": "Currencies",
    "CURR": "Currencies",
    "AA_BROAD": "Asset Allocation",
}

# --- fixed values: names of sub-assets --------------------------------------------------------
SUB_ASSET_NAMES = {
    "GOLD": "Gold", "SILVER": "Silver", "OIL_CRUDE": "Crude Oil", "NATURAL_GAS": "Natural Gas", "COPPER": "Copper",
    "AGRICULTURE": "Agriculture", "COMMODITIES_BROAD": "Broad Commodities",
    "RE_OFFICE": "Office", "RE_RETAIL": "Retail", "RE_INDUSTRIAL": "Industrial/Logistics", "RE_RESIDENTIAL": "Residential",
    "RE_DATA_CENTERS": "Data Centers", "RE_HOSPITALITY": "Hospitality",
    "EQ_US": "US Equities", "EQ_EUROPE": "European Equities", "EQ_UK": "UK Equities", "EQ_JAPAN": "Japan Equities",
    "EQ_AUSTRALIA": "Australia Equities", "EQ_CANADA": "Canada Equities",
    "EQ_EM_BROAD": "EM Equities (Broad)", "EQ_CHINA": "China Equities", "EQ_INDIA": "India Equities", "EQ_LATAM": "LatAm Equities",
    "EQ_EM_ASIA_EX_CHINA": "EM Asia ex-China", "EQ_EMEA": "EMEA Equities",
    "EQ_VALUE": "Value", "EQ_GROWTH": "Growth", "EQ_QUALITY": "Quality", "EQ_MOMENTUM": "Momentum", "EQ_LOW_VOL": "Low Volatility",
    "EQ_SIZE_SMALL": "Small Cap", "EQ_SIZE_MID": "Mid Cap", "EQ_SIZE_LARGE": "Large Cap", "EQ_DIVIDEND": "Dividend/Income",
    "EQ_TECH": "Technology", "EQ_HEALTHCARE": "Healthcare", "EQ_FINANCIALS": "Financials", "EQ_ENERGY": "Energy",
    "EQ_INDUSTRIALS": "Industrials", "EQ_MATERIALS": "Materials", "EQ_CONSUMER_DISC": "Consumer Discretionary",
    "EQ_CONSUMER_STAPLES": "Consumer Staples", "EQ_UTILITIES": "Utilities", "EQ_REAL_ESTATE": "Real Estate (Equities)",
    "EQ_COMMUNICATION": "Communication Services",
    "EURO_GOVT_BONDS": "Euro Government Bonds", "GERMAN_BUNDS": "German Bunds", "FRENCH_OATS": "French Government Bonds",
    "ITALIAN_BTPS": "Italian BTPs", "SPANISH_BONOS": "Spanish Bonos", "UK_GILTS": "UK Gilts", "SWISS_GOVT": "Swiss Government Bonds",
    "EUROPE_PERIPHERY": "European Periphery", "EUROPE_CORE": "European Core", "EUROPE_DURATION": "Europe Duration",
    "POLISH_BONDS": "Polish Government Bonds",
    "JGB": "Japanese Government Bonds", "JAPAN_DURATION": "Japan Duration", "AUSTRALIA_GOVT": "Australian Government Bonds",
    "CHINA_GOVT": "Chinese Government Bonds",
    "US_TREASURIES": "US Treasuries", "US_TIPS": "US TIPS", "US_DURATION": "US Duration", "CANADA_GOVT": "Canadian Government Bonds",
    "IG_US": "US Investment Grade", "IG_EUROPE": "European Investment Grade", "IG_GLOBAL": "Global Investment Grade",
    "IG_FINANCIALS": "IG Financials", "IG_NON_FIN": "IG Non-Financials",
    "HY_US": "US High Yield", "HY_EUROPE": "European High Yield", "HY_GLOBAL": "Global High Yield", "HY_EM": "EM High Yield",
    "EM_SOVEREIGN_HARD": "EM Sovereign (Hard Currency)", "EM_SOVEREIGN_LOCAL": "EM Sovereign (Local Currency)",
    "EM_CORPORATE": "EM Corporate Bonds", "MBS": "Mortgage-Backed Securities", "ABS": "Asset-Backed Securities",
    "CLO": "Collateralized Loan Obligations", "CONVERTIBLES": "Convertible Bonds", "INFLATION_LINKED": "Inflation-Linked Bonds",
    "USD": "US Dollar", "EUR": "Euro", "GBP": "British Pound", "JPY": "Japanese Yen", "CHF": "Swiss Franc", "AUD": "Australian Dollar",
    "CAD": "Canadian Dollar", "CNY": "Chinese Yuan", "EM_FX_BASKET": "EM Currency Basket", "EM_FX": "EM Currencies",
    "ASIA_FX_BASKET": "Asia Currency Basket", "DIGITAL_ASSETS": "Digital Assets/Bitcoin",
    "UST_10Y": "US 10-Year Treasuries", "UST_2Y": "US 2-Year Treasuries", "UST_30Y": "US 30-Year Treasuries", "EU_PERIPHERY": "European Periphery",
}

# --- fixed values: classes of badges and dots -------------------------------------------------
BADGES = {
    "OVERWEIGHT": "positive", "NET_POSITIVE": "positive", "HIGH": "positive", "UNDERWEIGHT": "negative", "NET_NEGATIVE": "negative", "LOW": "negative",
    "UNCERTAIN": "warning", "MEDIUM": "medium",
}
