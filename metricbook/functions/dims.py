"""Dimensions ("coordinates") as canonical JSON text.

Spark cannot join, group or partition a window on VARIANT, and cannot compare
MAP values, so dimensions travel as a canonical JSON string: keys sorted, no
spaces, null entries dropped, every value a string.  Equal objects give equal
strings, so plain equi-joins, ``groupBy`` and ``Window.partitionBy`` work.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAP_TYPE = "map<string,string>"
#: A string (kept), or a number's fraction without the zeros at its end.
_STRING_OR_FRACTION = r'("(?:[^"\\]|\\.)*")|(?<=\d)(\.\d*[1-9])0+(?![\d.eE])|(?<=\d)()\.0+(?![\d.eE])'


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def from_columns(names: list[str] | tuple[str, ...], alias: dict[str, str] | None = None) -> Column:
    """Canonical object from columns; NULL columns are left out of the object.

    This is what makes grouping-set subtotals lose their rolled-up keys.
    ``alias`` maps a key name to the source column when they differ.
    """
    alias = alias or {}
    fields = [F.col(alias.get(k, k)).cast("string").alias(k) for k in sorted(names)]
    if not fields:
        return F.lit("{}")
    return F.to_json(F.struct(*fields))


def entries(json_text) -> Column:
    """Sorted (key, value) entries of a JSON object, null values removed; parses the text once.

    A repeated key keeps its last value, as a JSON parser does.  Values that are objects
    or arrays are canonical at every depth (:func:`_nested`).  Not-an-object
    or unparsable text gives NULL.  Put it in a column of its own when several
    of the functions below are applied to one row.
    """
    def last_of_each(all_: Column) -> Column:
        return F.filter(all_, lambda e, i: ~F.exists(F.slice(all_, i + 2, F.size(all_)), lambda later: later.key == e.key)
                        & e.value.isNotNull())
    parsed = F.map_entries(F.from_json(_col(json_text), MAP_TYPE))
    # transform over a one-element array: the parsed entries are used several times but computed once
    found = F.element_at(F.transform(F.array(parsed), last_of_each), 1)
    return F.array_sort(F.transform(found, lambda e: F.struct(e.key.alias("key"), _nested(e.value).alias("value"))))


def _nested(value: Column) -> Column:
    """One spelling of an object or array: keys sorted at every depth, arrays in their order, numbers written
    alike, no blanks. Other values as they are, also texts that only begin like JSON."""
    # A variant keeps the keys of its objects in order; fractions keep no zeros at their end.
    spelled = F.regexp_replace(F.to_json(F.try_parse_json(value)), _STRING_OR_FRACTION, "$1$2$3")
    return F.when(value.rlike(r"^\s*[{\[]"), F.coalesce(spelled, value)).otherwise(value)


def canonical_of(e: Column) -> Column:
    """Canonical text of :func:`entries`."""
    return F.when(e.isNotNull(), F.to_json(F.map_from_entries(e)))


def canonical(json_text) -> Column:
    """Canonical text of a JSON object column (idempotent, key-order free)."""
    return F.element_at(F.transform(F.array(entries(json_text)), canonical_of), 1)


#: Column metadata that says a dimensions column holds canonical text already.
CANONICAL = {"canonical_dimensions": True}


def canonical_any(c, field) -> Column:
    """Canonicalise a dimensions column stored as text, map, struct or variant.

    ``field`` is its StructField; text marked as canonical is passed through.
    """
    if field.metadata.get("canonical_dimensions"):
        return _col(c)
    if field.dataType.simpleString().split("<")[0] in ("map", "struct", "variant"):
        c = F.to_json(_col(c))
    return canonical(c)


def keys_of(e: Column) -> Column:
    return F.coalesce(F.transform(e, lambda x: x.key), F.array().cast("array<string>"))


def values_of(e: Column) -> Column:
    return F.transform(e, lambda x: x.value)


def keys(json_text) -> Column:
    """Sorted keys (OBJECT_KEYS); NULL object -> empty array."""
    return keys_of(entries(json_text))


def values(json_text) -> Column:
    """Values in sorted-key order (OBJECT_VALUES)."""
    return values_of(entries(json_text))


def metric_name(indicator, e: Column) -> Column:
    """``INDICATOR by k1 x k2``, or ``INDICATOR by *`` for the all-up coordinate."""
    joined = F.array_join(keys_of(e), " x ")
    return F.concat_ws(" ", _col(indicator), F.lit("by"),
                       F.coalesce(F.nullif(joined, F.lit("")), F.lit("*")))


def coordinates(e: Column) -> Column:
    """Values joined by ``,``; ``''`` when the object has none."""
    return F.coalesce(F.array_join(values_of(e), ","), F.lit(""))


def display_name(readable, indicator, e: Column) -> Column:
    """``Readable - v1, v2`` or ``Readable - Global``.

    A missing readable name falls back to the indicator.
    """
    vals = F.array_join(values_of(e), ", ")
    dim = F.when(F.trim(F.coalesce(vals, F.lit(""))) == "", F.lit("Global")).otherwise(vals)
    return F.concat(F.coalesce(_col(readable), _col(indicator)), F.lit(" - "), dim)


def get_key(json_text, key: str) -> Column:
    """Value of one key (JSON path ``col:key``)."""
    return F.get(F.filter(entries(json_text), lambda x: x.key == key), F.lit(0)).value
