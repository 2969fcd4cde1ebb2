"""Text rules: hashes, reasons, credentials."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chainloom.constants import REASON_LIMIT

_BASE64 = r"^([A-Za-z0-9+/]{4})*([A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?\z"
_HEX_PAIRS = r"^([0-9a-fA-F]{2})*\z"


def strict_base64(text: Column) -> Column:
    """Bytes of padded standard base64 (line breaks ignored); NULL when malformed."""
    joined = F.regexp_replace(text, r"[\r\n]", "")
    return F.when(joined.rlike(_BASE64), F.unbase64(joined))


def tx_hash_of_raw(text: Column) -> Column:
    """Upper-case hex SHA-256 of the bytes behind base64 text; NULL when the text is bad."""
    return F.upper(F.sha2(strict_base64(text), 256))


def hash_is_valid(tx_hash: Column) -> Column:
    return tx_hash.rlike(_HEX_PAIRS)


def tx_hash_bytes(tx_hash: Column, height: Column) -> Column:
    """Hash bytes; an empty hash becomes 24 x FF followed by the big-endian height; bad hex NULL."""
    sentinel = F.concat(F.lit("FF" * 24), F.lpad(F.hex(height), 16, "0"))
    return F.when(tx_hash == "", F.unhex(sentinel)).when(hash_is_valid(tx_hash), F.unhex(tx_hash))


def truncate_utf8(text: Column, limit: int = REASON_LIMIT) -> Column:
    """Text of at most ``limit`` bytes; longer text is cut at ``limit`` bytes and marked.

    A character split by the cut is left out, so the result stays valid text.
    """
    cut = F.substring(F.encode(text, "UTF-8"), 1, limit)
    # bytes of an unfinished last character are dropped before decoding
    whole = F.regexp_replace(
        F.hex(cut),
        r"^((?:..)*?)(?:[CDEF].|[EF].[89AB].|F.[89AB].[89AB].)\z",
        "$1",
    )
    unfinished = F.hex(cut).rlike(
        r"^(?:..)*(?:[CDEF].|[EF].[89AB].|F.[89AB].[89AB].)\z"
    )
    kept = F.when(unfinished, F.decode(F.unhex(whole), "UTF-8")).otherwise(F.decode(cut, "UTF-8"))
    return F.when(F.octet_length(text) <= limit, text).otherwise(F.concat(kept, F.lit("…")))


def safe_reason(
    kind: Column, height: Column, status: Column, low: Column, high: Column, message: Column
) -> Column:
    """Short failure text without URLs or bodies for known error kinds, else the cut message."""
    return (
        F.when(
            kind == "height_pruned",
            F.format_string("height %d pruned (http %d)", height, status),
        )
        .when(kind == "http_status", F.format_string("http %d", status))
        .when(
            kind == "no_source_covers",
            F.format_string("no endpoint covers heights %d-%d", low, high),
        )
        .otherwise(truncate_utf8(message))
    )


def redact_userinfo(url: Column) -> Column:
    """Replace the password of ``user:password@host`` in a URL by ``***``."""
    return F.regexp_replace(
        url, r"^((?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#:@]*):[^/?#]*@", "$1:***@"
    )
