"""Map source names to the columns of a record type."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.functions import canonical_flag, canonical_time, table_time
from callweave.specs import RecordSpec

POLICIES = ("first_present", "first_non_null")


def _check_policy(policy: str) -> None:
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}, not {policy!r}")


def _standard_value(spec: RecordSpec, field: str, raw: Column, times: bool = False) -> Column:
    kind = spec.kind(field)
    if kind == "timestamp":
        return table_time(raw) if times else canonical_time(raw)
    if kind == "boolean":
        return canonical_flag(raw)
    return raw


def _targets(spec: RecordSpec, keys: Column, legacy: bool) -> Column:
    """The column each key of a record feeds, in record order; null for foreign keys."""
    pairs = [F.lit(part) for pair in spec.name_lookup(legacy).items() for part in pair]
    lookup = F.create_map(*pairs)
    return F.transform(keys, lambda key: lookup[key])


def resolve_records(
    df: DataFrame,
    spec: RecordSpec,
    record: str = "record",
    policy: str = "first_present",
    keep: Sequence[str] = (),
    legacy: bool = False,
    times: bool = False,
) -> DataFrame:
    """Ragged records (``map<string,string>``) as standard rows.

    Of several names for one column the first in record order wins;
    ``first_present`` takes it even where its value is null. Records without
    any known name are left out (``unmapped_records`` returns them). ``keep``
    names further columns to carry along. With ``times`` event times come as timestamps, for
    cleaning in the same plan: what can't be read is null then, and no text is made of the rest.

    Keys are translated once per record; each column is then one position
    lookup, so the cost does not grow with the number of accepted names.
    """
    _check_policy(policy)
    # Through a generator, so that the translation is computed once per record:
    # a plain projection would be merged into the filter and every column.
    once = F.struct(
        _targets(spec, F.map_keys(record), legacy).alias("_targets"), F.map_values(record).alias("_values")
    )
    rows = df.select(*keep, F.inline(F.array(once))).where(F.exists("_targets", lambda t: t.isNotNull()))
    if policy == "first_non_null":
        filled = F.zip_with("_targets", "_values", lambda t, v: F.when(v.isNotNull(), t))
        rows = rows.select(*keep, filled.alias("_targets"), "_values")
    picked = rows.select(
        *keep,
        *[
            F.get("_values", (F.array_position("_targets", field) - 1).cast("int")).alias(field)
            for field in spec.fields
        ],
    )
    return picked.select(*keep, *[_standard_value(spec, f, F.col(f), times).alias(f) for f in spec.fields])


def column_places(names: Column, spec: RecordSpec, legacy: bool = False) -> Column:
    """For each column of a record type the places, in order, of its names among ``names``."""
    lookup = F.create_map(*[F.lit(part) for pair in spec.name_lookup(legacy).items() for part in pair])

    def places(field: str) -> Column:
        return F.array_compact(F.transform(names, lambda name, i: F.when(lookup[name] == field, i)))

    return F.array(*[places(f) for f in spec.fields])


def resolve_values(
    df: DataFrame,
    spec: RecordSpec,
    values: str = "values",
    places: str = "places",
    policy: str = "first_non_null",
    keep: Sequence[str] = (),
    times: bool = False,
) -> DataFrame:
    """Rows by position (``values``, an array of text) as standard rows, given the ``column_places`` of their header.

    Names are looked up once per header, so a row costs one access per column. Policies as in ``resolve_records``."""
    _check_policy(policy)

    def raw(k: int) -> Column:
        at = F.get(F.col(places), F.lit(k))
        if policy == "first_present":
            return F.get(F.col(values), F.get(at, F.lit(0)))
        several = F.get(F.filter(F.transform(at, lambda i: F.get(F.col(values), i)), lambda v: v.isNotNull()), F.lit(0))
        return F.when(F.size(at) > 1, several).otherwise(F.get(F.col(values), F.get(at, F.lit(0))))  # mostly one, and no list is made

    picked = df.select(*keep, *[raw(k).alias(f) for k, f in enumerate(spec.fields)])
    return picked.select(*keep, *[_standard_value(spec, f, F.col(f), times).alias(f) for f in spec.fields])


def unmapped_records(df: DataFrame, spec: RecordSpec, record: str = "record", legacy: bool = False) -> DataFrame:
    """Records in which no name is known: the complement of ``resolve_records``."""
    known = F.arrays_overlap(F.map_keys(record), F.array(*[F.lit(n) for n in spec.name_lookup(legacy)]))
    return df.where(~F.coalesce(known, F.lit(False)))


def missing_fields(spec: RecordSpec, record: str = "record", legacy: bool = False) -> Column:
    """The columns for which a record carries no name, in table order; none for a record without any
    known name, which is foreign and left out as a whole."""
    have = _targets(spec, F.map_keys(record), legacy)
    lacking = F.array_except(F.array(*[F.lit(f) for f in spec.fields]), have)
    return F.when(F.size(lacking) < len(spec.fields), lacking).otherwise(F.array().cast("array<string>"))


def resolve_wide(
    df: DataFrame,
    spec: RecordSpec,
    policy: str = "first_non_null",
    keep: Sequence[str] = (),
    legacy: bool = False,
    times: bool = False,
) -> DataFrame:
    """Flat text columns as standard rows; column order stands for record order.

    Every row of a flat file carries every name, so ``first_present`` is the
    first known column whatever it holds, and ``first_non_null`` the first one
    filled. Unknown columns are not read at all. ``times`` as in ``resolve_records``.
    """
    _check_policy(policy)
    lookup = spec.name_lookup(legacy)
    sources: dict[str, list[str]] = {}
    for name in df.columns:
        if name in lookup and name not in keep:
            sources.setdefault(lookup[name], []).append(name)

    def raw(field: str) -> Column:
        names = sources.get(field, [])
        if not names:
            return F.lit(None).cast("string")
        cols = [F.col(f"`{n}`") for n in names]
        return cols[0] if policy == "first_present" else F.coalesce(*cols)

    if not sources:
        return df.select(*keep, *[raw(f).alias(f) for f in spec.fields]).where(F.lit(False))
    picked = df.select(*[F.col(k).alias(f"_keep_{k}") for k in keep], *[raw(f).alias(f) for f in spec.fields])
    return picked.select(
        *[F.col(f"_keep_{k}").alias(k) for k in keep],
        *[_standard_value(spec, f, F.col(f), times).alias(f) for f in spec.fields],
    )


def name_positional(df: DataFrame, spec: RecordSpec) -> DataFrame:
    """Columns of a file without header take the table's names, in order."""
    named = list(spec.fields[: len(df.columns)]) + df.columns[len(spec.fields):]
    return df.toDF(*named)


def merge_standard(frames: Sequence[DataFrame], spec: RecordSpec) -> DataFrame:
    """All rows of several standard sets (no de-duplication), absent columns null."""
    if not frames:
        raise ValueError("nothing to merge")
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    extra = [c for c in merged.columns if c not in spec.fields]
    absent = {f.name: F.lit(None).cast(f.dataType) for f in spec.standard_schema if f.name not in merged.columns}
    return merged.withColumns(absent).select(*spec.fields, *extra)
