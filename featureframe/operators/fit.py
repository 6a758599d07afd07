"""Fit values of one file to the type the result schema asks for."""

from __future__ import annotations

import datetime
import decimal

import pyarrow as pa
import pyarrow.compute as pc

_FAILED = (pa.ArrowException, OverflowError, TypeError, ValueError, KeyError, decimal.InvalidOperation)
# Texts of truth values
_BOOLEANS = dict.fromkeys(("true", "t", "yes", "y", "1"), True) | dict.fromkeys(("false", "f", "no", "n", "0"), False)


def fit(values: pa.Array | list, target: pa.DataType) -> pa.Array:
    """``values`` as ``target``; what cannot be converted becomes null."""
    try:
        array = values
        if isinstance(values, list):
            # dates are read from text only: Arrow would take numbers as days since 1970
            direct = pa.string() if pa.types.is_temporal(target) else None if pa.types.is_boolean(target) else target
            array = pa.array(values, direct)
        if pa.types.is_date(target) and pa.types.is_string(array.type):
            array = pc.replace_substring(array, "/", "-")
        if array.type == target:
            return array
        if pa.types.is_floating(array.type) and pa.types.is_integer(target):
            array = pc.if_else(pc.is_finite(array), pc.trunc(array), None)
        return array.cast(target)
    except _FAILED:
        items = values if isinstance(values, list) else values.to_pylist()
        return pa.array([_convert(item, target) for item in items], target)


def _convert(value: object, target: pa.DataType) -> object:
    if value is None:
        return None
    try:
        return pa.scalar(_as(value, target), target).as_py()
    except _FAILED:
        return None


def _as(value: object, target: pa.DataType) -> object:
    if isinstance(value, bytes) and not pa.types.is_binary(target):
        value = value.decode("utf-8", "replace")
    if pa.types.is_boolean(target):
        return _BOOLEANS[value.strip().lower()] if isinstance(value, str) else bool(value)
    if pa.types.is_integer(target):
        return int(value) if isinstance(value, str) and value.strip().lstrip("+-").isdigit() else int(float(value))
    if pa.types.is_floating(target):
        return float(value)
    if pa.types.is_date(target):
        return datetime.date.fromisoformat(str(value).replace("/", "-")[:10])
    if pa.types.is_timestamp(target):
        moment = datetime.datetime.fromisoformat(str(value).replace("/", "-"))
        return moment if moment.tzinfo or not target.tz else moment.replace(tzinfo=datetime.timezone.utc)
    if pa.types.is_decimal(target):
        return decimal.Decimal(str(value)).quantize(decimal.Decimal(1).scaleb(-target.scale))
    if pa.types.is_string(target):
        return str(value).lower() if isinstance(value, bool) else str(value)
    if pa.types.is_binary(target) and isinstance(value, str):
        return value.encode("utf-8")
    return value
