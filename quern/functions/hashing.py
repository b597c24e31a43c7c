"""Digests of text and records, deterministic samples, identifiers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions.text import entity_shape, normalized

#: Short forms of source types in record ids.
SOURCE_CODES = {"translated": "tr", "original_turkish": "ot", "turkey_native": "tn"}
ID_LIMIT = 999_999


def exact_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def normalized_hash(text: Column) -> Column:
    return F.sha2(normalized(text), 256)


def shape_hash(text: Column, entities: Mapping[str, Sequence[str]]) -> Column:
    """Digest of the normalized text with entities replaced by their types."""
    return F.sha2(entity_shape(text, entities), 256)


def combined_hash(text: Column, fingerprints: Column) -> Column:
    """Digest of the normalized text with its sorted schema fingerprints; without any, a colon remains."""
    return F.sha2(F.concat(normalized_hash(text), F.lit(":"), F.array_join(F.array_sort(fingerprints), ":")), 256)


def sample_share(key: Column) -> Column:
    """A number in [0, 1) from the first twelve hex digits of the key's digest."""
    return F.conv(F.substring(F.sha2(key.cast("string"), 256), 1, 12), 16, 10).cast("double") / F.lit(float(16**12))


def sampled(key: Column, rate: float) -> Column:
    return F.lit(rate > 0) & (sample_share(key) < rate)


def record_id(code: Column, number: Column, kind: str = "tctr", limited: bool = True) -> Column:
    """kind_code_NNNNNN for 1 to ID_LIMIT, null beyond; numbers that aren't limited go on with more digits."""
    own = F.format_string(f"{kind}_%s_%06d", code, number)
    return F.when(number.between(1, ID_LIMIT) if limited else number >= 1, own)


def valid_record_id(value: Column, source_type: Column, kind: str = "tctr") -> Column:
    code = F.create_map(*[F.lit(x) for kv in SOURCE_CODES.items() for x in kv])[source_type]
    found = F.regexp_extract(value, f"^{kind}_(tr|ot|tn)_([0-9]{{6}})$", 1)
    return F.coalesce((found != "") & (found == code) & (F.right(value, F.lit(6)) != "000000"), F.lit(False))
