"""Fixed values of the published report: reference amounts, asset lists, column lists and the fundamentals template."""

from __future__ import annotations

FIAT_TRILLIONS = {
    "United States": 5.73,
    "China": 5.11,
    "Eurozone": 5.19,
    "Japan": 4.20,
    "United Kingdom": 1.09,
    "Switzerland": 0.58,
    "India": 0.56,
    "Australia": 0.24,
    "Russia": 0.30,
    "Hong Kong": 0.25,
    "Global Fiat Supply": 26.1,
}
METAL_OUNCES = {"Gold": 6_100_000_000, "Silver": 30_900_000_000}
METAL_SYMBOLS = {"Gold": "GC=F", "Silver": "SI=F"}
GOLD_SPLIT = {"Jewellery": 47.0, "Private Investment": 22.0, "Official Country Holdings": 17.0, "Other": 14.0}

MOVING_AVERAGE_COLUMNS = (
    "hash_rate",
    "daily_active_addresses_sending",
    "tx_count_sum_24h",
    "transfer_volume_sum_24h_usd",
    "fees_average_24h_usd",
    "fees_average_24h",
    "subsidy_sum_24h",
    "coinbase_sum_24h_usd",
    "nvt_price",
    "nvt_price_adj",
)
ANALYSIS_COLUMNS = (
    "price_close",
    "hash_rate",
    "tx_count_sum_24h",
    "transfer_volume_sum_24h_usd",
    "daily_active_addresses_sending",
    "addrs_over_10k_sats_addr_count",
    "addrs_over_1btc_addr_count",
    "coinbase_sum_24h_usd",
    "fees_sum_24h_usd",
    "supply_pct_1_year_plus",
    "velocity_usd",
    "coindays_destroyed_sum_24h",
    "adjusted_bdd",
    "vocd",
    "mvocd",
    "hodl_bank_calc",
    "reserve_risk_calc",
    "VtyDayRet30d",
    "VtyDayRet180d",
)
# Assets whose closes are analysed beside the network's own columns, in the published order.
ANALYSIS_SYMBOLS = ("SPY", "QQQ", "VTI", "VXUS", "XLK", "XLF", "XLE", "XLRE", "DX-Y.NYB", "GLD", "AGG", "^SPGSCI", "MSTR", "XYZ", "COIN", "WGMI")
# Symbols of the landed closes, by kind. Stocks also have a value column.
SYMBOLS = {
    "stocks": (
        "AAPL", "MSFT", "GOOGL", "AMZN", "NVDA", "AVGO", "TSLA", "LLY", "MU", "META", "BRK-A", "BRK-B", "TSM", "SPCX", "2222.SR",
        "005930.KS", "V", "JPM", "PYPL", "GS", "COIN", "XYZ", "MSTR", "MARA", "RIOT",
    ),
    "etfs": (
        "BITQ", "CLOU", "ARKK", "XLK", "QQQ", "IUIT.L", "VTI", "TLT", "LQD", "JNK", "GLD", "XLF", "XLRE", "SHY", "XLE", "FANG.AX", "SPY",
        "IEMG", "AGG", "WGMI", "VXUS",
    ),
    "indices": ("^GSPC", "^VIX", "^IXIC", "^TNX", "^TYX", "^FVX", "^IRX", "^SPGSCI"),
    "commodities": ("GC=F", "CL=F", "SI=F"),
    "forex": (
        "DX-Y.NYB", "AUDUSD=X", "CHFUSD=X", "CNYUSD=X", "EURUSD=X", "GBPUSD=X", "HKDUSD=X", "INRUSD=X", "JPYUSD=X", "RUBUSD=X",
    ),
    "crypto": ("ethereum", "ripple", "dogecoin", "binancecoin", "tether"),
}
GROWTH_COLUMNS = ("price_close", "realized_price", "thermocap_price", "200_day_ma_price_close", "Lagged_Energy_Value")
GROWTH_SYMBOLS = ("SPY", "QQQ", "XLK", "XLF", "GLD", "AGG", "DX-Y.NYB", "WGMI")
REQUIRED_BASE_COLUMNS = (
    "price_close",
    "market_cap",
    "supply",
    "realized_cap",
    "hash_rate",
    "addr_count",
    "addrs_over_100k_sats_addr_count",
    "addrs_over_1m_sats_addr_count",
    "addrs_over_10m_sats_addr_count",
)

BENCHMARK_LABEL = "Bitcoin - [BTC]"
PERFORMANCE_ASSETS = {
    "Equity Market Indexes": {
        "S&P 500 Index ETF - [SPY]": "SPY",
        "Nasdaq-100 ETF - [QQQ]": "QQQ",
        "US Total Stock Market ETF - [VTI]": "VTI",
        "International Stock ETF - [VXUS]": "VXUS",
    },
    "Sectors": {
        "Technology Sector ETF - [XLK]": "XLK",
        "Financials Sector ETF - [XLF]": "XLF",
        "Energy Sector ETF - [XLE]": "XLE",
        "Real Estate Sector ETF - [XLRE]": "XLRE",
    },
    "Macro Asset Classes": {
        "US Dollar Index - [DXY]": "DX-Y.NYB",
        "Gold ETF - [GLD]": "GLD",
        "Aggregate Bond ETF - [AGG]": "AGG",
        "S&P GSCI Commodity Index - [SPGSCI]": "^SPGSCI",
    },
    "Bitcoin Industry Performance": {
        "MicroStrategy - [MSTR]": "MSTR",
        "Block - [XYZ]": "XYZ",
        "Coinbase - [COIN]": "COIN",
        "Bitcoin Miners ETF - [WGMI]": "WGMI",
    },
}

VALUED_MONEY = {"Switzerland M0": "Switzerland", "UK M0": "United_Kingdom", "US M0": "United_States"}
VALUED_METALS = {"Total Silver Market": "silver", "Total Gold Market": "gold"}
VALUED_COMPANIES = {
    "Apple": "AAPL",
    "Amazon": "AMZN",
    "Meta": "META",
    "NVIDIA": "NVDA",
    "Broadcom": "AVGO",
    "Tesla": "TSLA",
    "Eli Lilly": "LLY",
    "Micron": "MU",
    "TSMC": "TSM",
    "SpaceX": "SPCX",
    "Saudi Aramco": "2222.SR",
    "Samsung Electronics": "005930.KS",
    "Berkshire Hathaway Class B": "BRK-B",
    "JPMorgan": "JPM",
    "Visa": "V",
}
SHARE_ALIASES = {"META": ["FB", "META"], "XYZ": ["SQ", "XYZ"]}
CAP_FX_PAIRS = {"2222.SR": "SARUSD=X", "005930.KS": "KRWUSD=X"}

FUNDAMENTALS = {
    "Network Performance": {
        "Total Address Count": ("addrs_over_1sat_addr_count", "number"),
        "Address Count > $10": ("addrs_over_10k_sats_addr_count", "number"),
        "Active Addresses": ("daily_active_addresses_sending", "number"),
        "Supply Held 1+ Year %": ("supply_pct_1_year_plus", "percent_point"),
        "Transaction Count": ("tx_count_sum_24h", "number"),
        "Transaction Volume": ("transfer_volume_sum_24h_usd", "currency"),
        "Transaction Fee USD": ("fees_sum_24h_usd", "currency"),
    },
    "Network Security": {
        "Hash Rate": ("hash_rate", "hashrate_ehs"),
        "Network Difficulty": ("difficulty", "difficulty_t"),
        "Miner Revenue": ("coinbase_sum_24h_usd", "currency"),
        "Fee % Of Reward": ("pct_fee_of_reward", "percent_point"),
    },
    "Network Economics": {
        "Bitcoin Supply": ("supply", "number"),
        "% Supply Issued": ("pct_supply_issued", "percent_ratio"),
        "Bitcoin Mined Per Day": ("subsidy_sum_24h", "number"),
        "Annual Inflation Rate": ("inflation_rate", "percent_point"),
        "Velocity": ("velocity_usd", "number2"),
    },
    "Network Valuation": {
        "Market Cap": ("market_cap", "currency"),
        "Bitcoin Price": ("price_close", "currency"),
        "Realized Price": ("realized_price", "currency"),
        "Thermocap Price": ("thermocap_price", "currency"),
    },
}


def close_columns() -> dict[str, str]:
    """Symbol -> its close column in the wide table."""
    return {s: f"{s}_close" for members in SYMBOLS.values() for s in members}


def cap_columns() -> dict[str, str]:
    """Company -> its value column in the wide table."""
    return {s: f"{s}_MarketCap" for s in SYMBOLS["stocks"]}


def analysis_columns() -> tuple[str, ...]:
    """All columns whose changes are published: the network's own, then the closes of the analysed assets."""
    return (*ANALYSIS_COLUMNS, *[f"{s}_close" for s in ANALYSIS_SYMBOLS])


def performance_assets(benchmark: str) -> list[tuple[str, str, str]]:
    """(category, label, entity) rows; the benchmark opens every category."""
    return [
        row
        for category, members in PERFORMANCE_ASSETS.items()
        for row in [(category, BENCHMARK_LABEL, benchmark), *[(category, label, symbol) for label, symbol in members.items()]]
    ]


def valued_assets() -> list[tuple[str, str, str]]:
    """(name, implied-price column, cap column) rows of the relative valuation."""
    rows = [("Bitcoin", "price_close", "market_cap")]
    rows += [(n, f"{c}_btc_price", f"{c}_cap") for n, c in VALUED_MONEY.items()]
    rows += [(n, f"{m}_marketcap_btc_price", f"{m}_marketcap_billion_usd") for n, m in VALUED_METALS.items()]
    return rows + [(n, f"{t}_mc_btc_price", f"{t}_MarketCap") for n, t in VALUED_COMPANIES.items()]
