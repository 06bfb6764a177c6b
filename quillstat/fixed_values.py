"""Values that results depend on. All of them are parameters of the functions
that use them; these are the defaults."""

from __future__ import annotations

from typing import NamedTuple


class Currency(NamedTuple):
    address: str
    label: str
    rate: str  # USD per token, kept as text so that it becomes an exact decimal
    decimals: int  # the raw amount counts units of 10^-decimals tokens


# Currencies with a known scale and a constant USD rate.
CURRENCIES = (
    Currency("0x0d500B1d8E8eF31E21C99d1Db9A6444d3ADf1270", "WMATIC", "0.8", 18),
    Currency("0x7ceB23fD6bC0adD59E62ac25578270cFf1b9f619", "WETH", "1939", 18),
    Currency("0xD838290e877E0188a4A44700463419ED96c16107", "NCT", "1.14", 18),
    Currency("0x8f3Cf7ad23Cd3CaDbD9735AFf958023239c6A063", "DAI", "1", 18),
    Currency("0x2791Bca1f2de4661ED88A30C99A7a9449Aa84174", "USDC", "1", 6),
)

# Profiles whose creator marts are built.
ALLOWLIST = (
    "0x01bbee",
    "0x0f85",
    "0x05",
    "0x73b1",
    "0x011e55",
    "0x8807",
    "0x0184ed",
    "0x218b",
    "0xbee1",
    "0x69f9",
    "0x43c3",
    "0x0155a4",
)

# Profiles looked at in the handle history.
HISTORY_PROFILES = ("0x0f85", "0x010c69", "0x05", "0x139f")

# First and last day of the date dimension.
FIRST_DAY = "2022-01-01"
LAST_DAY = "2025-12-31"

# Points per interaction; every other type counts 0.
ENGAGEMENT_POINTS = {
    "FOLLOW": 111,
    "PAID COLLECT": 100,
    "COMMENT": 60,
    "QUOTE": 45,
    "FREE COLLECT": 40,
    "MIRROR": 35,
    "MENTION": 15,
    "UPVOTE": 15,
}

# Interaction types of the high tier.
HIGH_VALUE_TYPES = ("COMMENT", "MIRROR", "PAID COLLECT", "FREE COLLECT", "QUOTE", "FOLLOW")
