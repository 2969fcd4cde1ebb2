"""Names, labels, tables and limits that results depend on."""

from __future__ import annotations

# Event type and handler key of relay payments, native coin and its price id.
RELAY_EVENT_TYPE = "lava_relay_payment"
RELAY_HANDLER = "lava_relay_payment"
NATIVE_DENOM = "ulava"
NATIVE_PRICE_ID = "lava-network"

# Known denoms as (raw denom, display denom, factor, price id).
DENOM_SEED = [
    ("ulava", "lava", 1000000, "lava-network"),
    ("uatom", "atom", 1000000, "cosmos"),
    ("uosmo", "osmo", 1000000, "osmosis"),
    ("ujuno", "juno", 1000000, "juno-network"),
    ("ustars", "stars", 1000000, "stargaze"),
    ("uakt", "akt", 1000000, "akash-network"),
    ("uhuahua", "huahua", 1000000, "chihuahua-token"),
    ("uevmos", "evmos", 1000000000000000000, "evmos"),
    ("inj", "inj", 1000000000000000000, "injective-protocol"),
    ("aevmos", "evmos", 1000000000000000000, "evmos"),
    ("basecro", "cro", 100000000, "crypto-com-chain"),
    ("uscrt", "scrt", 1000000, "secret"),
    ("uiris", "iris", 1000000, "iris-network"),
    ("uregen", "regen", 1000000, "regen"),
    ("uion", "ion", 1000000, "ion"),
    ("nanolike", "like", 1000000000, "likecoin"),
    ("uaxl", "axl", 1000000, "axelar"),
    ("uband", "band", 1000000, "band-protocol"),
    ("ubld", "bld", 1000000, "agoric"),
    ("ucmdx", "cmdx", 1000000, "comdex"),
    ("ucre", "cre", 1000000, "crescent-network"),
    ("uxprt", "xprt", 1000000, "persistence"),
    ("uusdc", "usdc", 1000000, "usd-coin"),
    ("unit-move", "move", 10000000, "movement"),
]

# The suppressed test denom.
SUPPRESSED_TEST_DENOM = (
    "ibc/E3FCBEDDBAC500B1BAB90395C7D1E4F33D9B9ECFE82A16ED7D7D141A0152323F",
    "test",
    1,
)

# Reward source labels and kinds; unknown labels count as subscription.
SOURCE_KINDS = {"Boost": 0, "Pools": 1, "Subscription": 2}
SOURCE_KIND_DEFAULT = 2
SOURCE_KIND_TOTAL = 3

# Chain messages that mean "this replica cannot answer".
REPLICA_MESSAGES = [
    "version does not exist",
    "version mismatch",
    "no commit info found",
    "not implemented",
]

# Substrings of network errors worth retrying.
RETRYABLE_NETWORK_TEXT = [
    "connection reset",
    "connection refused",
    "context deadline exceeded",
    "EOF",
    "timeout",
    "tls: ",
    "no such host",
    "i/o timeout",
    "broken pipe",
]

# HTTP codes of the rewards service that mean pruned state.
STATE_PRUNED_CODES = [404, 500, 501, 502, 503, 504]

# Window, floor and ring size of the request metrics.
RATE_WINDOW_SECONDS = 60
RATE_FLOOR_SECONDS = 0.25
LATENCY_RING = 512

# Longest failure text kept.
REASON_LIMIT = 250

# Heights per bucket of the interval operators: a (key, bucket) window never holds more
# than this many rows, and a chain of a billion heights has under eight thousand buckets.
HEIGHT_BUCKET = 1 << 17
