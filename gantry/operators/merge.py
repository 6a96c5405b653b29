"""Keyed merge of a batch into a table, as plain DataFrame joins.

Semantics: a source row updates every target row with an equal key; a source row
whose key is not in the target is inserted; target rows without a partner stay.
Keys are compared with ``=``, so a NULL key never matches: such source rows are
always inserted and such target rows always stay. Equal source keys that match
nothing are all inserted; equal source keys that match are an error
(:func:`checked_merge`).

Two plans give the same rows:

* **Left join and anti join**, the general one. The target is the left side and
  the batch the right, so a batch under Spark's broadcast threshold causes no
  shuffle of the target, and a key repeated in the target can be split by AQE's
  skew join. Keys reach the insert test de-duplicated (``distinct`` combines
  before the shuffle): a key that fills a third of the target is one row there.
* **One full outer join**, about twice as fast when both sides must be shuffled
  anyway. It can neither broadcast nor split a hot key, and is used only where the
  keys of both sides are known to be unique.

NULL keys go around the joins in both, instead of all hashing to one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOT_SHARE = 1000


class AmbiguousMergeError(Exception):
    """Several source rows match the same target row."""


class MergeSchemaError(Exception):
    """The source lacks a column of the target, or has values that the target's type cannot hold."""


def quoted(name: str) -> str:
    """A column name that may hold dots, as Spark reads it back."""
    return "`" + name.replace("`", "``") + "`"


def _column(name: str, side: str | None = None) -> Column:
    return F.col(f"{side}.{quoted(name)}" if side else quoted(name))


_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]


def _widened(column: Column, source: T.DataType, target: T.DataType, name: str) -> Column:
    """A source value in the target's type, if that type holds every value of the source's.

    Integers of 64 bits fit a double column as long as they are exact in it; one that
    is not stops the job.
    """
    if isinstance(source, T.NullType):
        return column.cast(target)
    if source in _WHOLE and target in _WHOLE and _WHOLE.index(source) < _WHOLE.index(target):
        return column.cast(target)
    if target == T.DoubleType() and (source == T.FloatType() or source in _WHOLE[:3]):
        return column.cast(target)
    if target == T.DoubleType() and source == T.LongType():
        exact = column.isNull() | (F.try_add(column.cast(target), F.lit(0.0)).try_cast(source) == column)
        inexact = F.raise_error(F.concat(F.lit(f"{name}: no double equals "), column.cast("string")))
        return F.when(exact, column.cast(target)).otherwise(inexact)
    if isinstance(source, T.DecimalType) and isinstance(target, T.DecimalType):
        whole = target.precision - target.scale >= source.precision - source.scale
        if whole and target.scale >= source.scale:
            return column.cast(target)
    raise MergeSchemaError(f"{name}: {source.simpleString()} does not fit {target.simpleString()} of the target")


def merged_type(target: T.DataType, source: T.DataType, name: str) -> T.DataType:
    """The type that holds both: structs take the fields of both sides, at any depth.

    Fields go by name, the target's first. Other types must be the target's, or fit into it.
    """
    if isinstance(target, T.StructType) and isinstance(source, T.StructType):
        fields = []
        for f in target.fields:
            kind = merged_type(f.dataType, source[f.name].dataType, f"{name}.{f.name}") if f.name in source.names else f.dataType
            fields.append(T.StructField(f.name, kind))
        return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in source.fields if f.name not in target.names])
    if isinstance(target, T.ArrayType) and isinstance(source, T.ArrayType):
        return T.ArrayType(merged_type(target.elementType, source.elementType, f"{name}.element"))
    if isinstance(target, T.MapType) and isinstance(source, T.MapType) and target.keyType == source.keyType:
        return T.MapType(target.keyType, merged_type(target.valueType, source.valueType, f"{name}.value"))
    if isinstance(target, T.NullType):
        return source
    if source != target:
        _widened(F.lit(None), source, target, name)  # refuses what does not fit
    return target


def fitted(column: Column, kind: T.DataType, wanted: T.DataType, name: str) -> Column:
    """A value of one type as a value of a type that :func:`merged_type` made of it; new fields are NULL."""
    if kind.simpleString() == wanted.simpleString():
        return column
    if isinstance(wanted, T.StructType) and isinstance(kind, T.StructType):
        parts = [
            fitted(column.getField(f.name), kind[f.name].dataType, f.dataType, f"{name}.{f.name}").alias(f.name)
            if f.name in kind.names
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in wanted.fields
        ]
        return F.when(column.isNotNull(), F.struct(*parts))
    if isinstance(wanted, T.ArrayType) and isinstance(kind, T.ArrayType):
        return F.transform(column, lambda e: fitted(e, kind.elementType, wanted.elementType, f"{name}.element"))
    if isinstance(wanted, T.MapType) and isinstance(kind, T.MapType):
        return F.transform_values(column, lambda _, v: fitted(v, kind.valueType, wanted.valueType, f"{name}.value"))
    return _widened(column, kind, wanted, name)


def _updated(old: Column, new: Column, was: T.DataType, kind: T.DataType, wanted: T.DataType, name: str) -> Column:
    """The value of a matched row: the source's, and the target's for fields the source does not have."""
    if isinstance(wanted, T.StructType) and isinstance(kind, T.StructType) and isinstance(was, T.StructType):
        parts = []
        for f in wanted.fields:
            inner = f"{name}.{f.name}"
            if f.name not in kind.names:
                value = fitted(old.getField(f.name), was[f.name].dataType, f.dataType, inner)
            elif f.name not in was.names:
                value = fitted(new.getField(f.name), kind[f.name].dataType, f.dataType, inner)
            else:
                types = was[f.name].dataType, kind[f.name].dataType, f.dataType
                value = _updated(old.getField(f.name), new.getField(f.name), *types, inner)
            parts.append(value.alias(f.name))
        return F.when(new.isNotNull(), F.struct(*parts))
    return fitted(new, kind, wanted, name)


def _conform(source: DataFrame, target: DataFrame, schema_mode: str) -> DataFrame:
    """The source restricted to the merged columns; where columns do not nest, in the target's types."""
    if schema_mode not in ("strict", "evolve"):
        raise ValueError(f"unknown schema mode {schema_mode!r}")
    missing = [c for c in target.columns if c not in source.columns]
    if missing and schema_mode == "strict":
        raise MergeSchemaError(f"source lacks target columns: {', '.join(missing)}")
    kept = [c for c in target.columns if c in source.columns]
    if schema_mode == "evolve":
        kept += [c for c in source.columns if c not in target.columns]
    columns = []
    for c in kept:
        kind = source.schema[c].dataType
        wanted = target.schema[c].dataType if c in target.columns else kind
        nested = isinstance(wanted, (T.StructType, T.ArrayType, T.MapType))
        if kind.simpleString() == wanted.simpleString() or (nested and schema_mode == "evolve"):
            columns.append(_column(c))
        else:
            columns.append(_widened(_column(c), kind, wanted, c).alias(c))
    return source.select(columns)


def _merged_types(target: DataFrame, source: DataFrame, columns: list[str]) -> dict[str, T.DataType]:
    """The type of each merged column, from the two sides that have it."""
    found = {}
    for c in columns:
        kinds = [df.schema[c].dataType for df in (target, source) if c in df.columns]
        found[c] = kinds[0] if len(kinds) == 1 else merged_type(*kinds, c)
    return found


def _padded(df: DataFrame, other: DataFrame, columns: list[str], types: dict[str, T.DataType]) -> DataFrame:
    """The given columns in their merged types, NULL where only the other side has one."""
    return df.select(
        [
            fitted(_column(c), df.schema[c].dataType, types[c], c).alias(c) if c in df.columns else F.lit(None).cast(types[c]).alias(c)
            for c in columns
        ]
    )


def _keyed(df: DataFrame, key: str) -> DataFrame:
    return df.filter(_column(key).isNotNull())


def _keyless(df: DataFrame, key: str) -> DataFrame:
    return df.filter(_column(key).isNull())


def _joined(
    target: DataFrame, source: DataFrame, key: str, columns: list[str], how: str, types: dict[str, T.DataType]
) -> DataFrame:
    """Target joined to source, each row with its merged values."""
    matched = _column(key, "s").isNotNull()
    picked = []
    for c in columns:
        if c not in source.columns:
            value = _column(c, "t")
        elif c not in target.columns:
            value = _column(c, "s")
        else:
            # By match and not by coalesce: a NULL in the source overwrites a
            # value in the target.
            was, kind = target.schema[c].dataType, source.schema[c].dataType
            new = _updated(_column(c, "t"), _column(c, "s"), was, kind, types[c], c)
            value = F.when(matched, new).otherwise(fitted(_column(c, "t"), was, types[c], c))
        picked.append(value.alias(c))
    equal = _column(key, "t") == _column(key, "s")
    return target.alias("t").join(source.alias("s"), equal, how).select(picked)


def _broadcastable(df: DataFrame) -> bool:
    """Whether Spark's own size estimate lets it broadcast these rows."""
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return estimate <= limit


def _taken_keys(target: DataFrame, source: DataFrame, key: str, unique: bool, small_source: bool) -> DataFrame:
    """Distinct target keys, enough of them to tell which source rows are new.

    With a source small enough to broadcast, only those it holds as well: that
    test runs before the shuffle, which then has no more keys than source rows.
    """
    present = _keyed(target.select(_column(key)), key)
    if not unique:
        present = present.distinct()
    if not small_source:
        return present
    return present.join(_keyed(source.select(_column(key)), key), key, "left_semi")


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    schema_mode: str = "strict",
    update: bool = True,
    insert: bool = True,
    unique_keys: bool = False,
    small_source: bool | None = None,
) -> DataFrame:
    """The target after merging the source into it.

    ``strict``: the source must have every target column, extra source columns
    are ignored. ``evolve``: the result has the columns of both; a matched row
    keeps its target value where the source has no such column, and rows from
    the side that lacks a column hold NULL there. The same holds for the fields of
    structs, at any depth; elements of arrays and values of maps are replaced whole.

    ``update`` and ``insert`` switch the two clauses off one by one.

    Matching source keys must be unique; use :func:`checked_merge` where that is
    not known. ``unique_keys`` says that neither side repeats a key, which allows
    faster plans; if it is not so, the rows are the same but hot keys are slow.
    ``small_source`` says whether the source can be broadcast; by default Spark's
    size estimate does. The rows are the same either way.
    """
    source = _conform(source, target, schema_mode)
    columns = target.columns + [c for c in source.columns if c not in target.columns]
    types = _merged_types(target, source, columns)
    keyed = _keyed(source, key)

    if small_source is None:
        small_source = _broadcastable(source)
    if update and insert and unique_keys and not small_source:
        merged = _joined(_keyed(target, key), keyed, key, columns, "full_outer", types)
        merged = merged.union(_padded(_keyless(target, key), source, columns, types))
        return merged.union(_padded(_keyless(source, key), target, columns, types))

    if update:
        merged = _joined(_keyed(target, key), keyed, key, columns, "left", types)
        merged = merged.union(_padded(_keyless(target, key), source, columns, types))
    else:
        merged = _padded(target, source, columns, types)
    if insert:
        # Reads the same rows and columns as the join above, so that one shuffle
        # of the source serves both.
        new = keyed.join(_taken_keys(target, keyed, key, unique_keys, small_source), key, "left_anti")
        merged = merged.union(_padded(new, target, columns, types))
        merged = merged.union(_padded(_keyless(source, key), target, columns, types))
    return merged


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Non-null keys held by more than one row: (key, copies)."""
    counted = _keyed(df, key).groupBy(_column(key)).agg(F.count(F.lit(1)).alias("copies"))
    return counted.filter(F.col("copies") > 1)


def has_unique_keys(df: DataFrame, key: str) -> bool:
    """Whether no two rows share a non-null key."""
    return repeated_keys(df, key).isEmpty()


def ambiguous_keys(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Target keys matched by more than one source row: (key, copies)."""
    present = _keyed(target.select(_column(key)), key).distinct()
    return repeated_keys(source, key).join(present, key, "left_semi")


def split_hot(source: DataFrame, key: str) -> tuple[DataFrame, DataFrame | None]:
    """The source without its hot keys, and the rows of those keys.

    A key is hot if it holds more than one in ``HOT_SHARE`` of the rows, so there
    are fewer than ``HOT_SHARE`` of them whatever the size of the source, and the
    list can be broadcast. None if there is no hot key.
    """
    copies = repeated_keys(source, key)
    rows = source.count()
    hot = [r[key] for r in copies.filter(F.col("copies") * HOT_SHARE > rows).collect()]
    if not hot:
        return source, None
    schema = source.select(_column(key)).schema
    keys = F.broadcast(source.sparkSession.createDataFrame([(k,) for k in hot], schema))
    return source.join(keys, key, "left_anti"), source.join(keys, key, "left_semi")


def checked_merge(
    target: DataFrame,
    source: DataFrame,
    key: str,
    schema_mode: str = "strict",
    target_unique: bool = False,
    source_unique: bool = False,
    small_source: bool | None = None,
) -> tuple[DataFrame, bool]:
    """:func:`merge_upsert` for a source whose keys may repeat.

    Returns the merged rows and whether their keys are known to be unique.
    ``target_unique`` and ``source_unique`` say that of one side; a source not
    known to be unique is checked. Ambiguous keys are refused. What repeats and is not refused
    matches nothing: the rows of a hot key are then inserted straight away instead
    of being gathered in one task of a join.
    """
    if source_unique or has_unique_keys(source, key):
        merged = merge_upsert(target, source, key, schema_mode, unique_keys=target_unique, small_source=small_source)
        return merged, target_unique
    examples = ambiguous_keys(target, source, key).limit(5).collect()
    if examples:
        shown = ", ".join(f"{r[key]} ({r['copies']} rows)" for r in examples)
        raise AmbiguousMergeError(f"several source rows for one {key}: {shown}")
    rest, hot_rows = split_hot(source, key)
    merged = merge_upsert(target, rest, key, schema_mode, small_source=small_source)
    if hot_rows is not None:
        types = {f.name: f.dataType for f in merged.schema}
        merged = merged.union(_padded(_conform(hot_rows, target, schema_mode), target, merged.columns, types))
    return merged, False


def latest_per_key(df: DataFrame, key: str, *order: str | Column) -> DataFrame:
    """The last row of each key by ``order``; rows without a key are all kept.

    Ties are settled by the other columns, so the outcome does not depend on how
    rows are distributed. The maximum combines before the shuffle: one row per key
    and task moves, and a hot key is never gathered in one place.
    """
    row = F.struct(*(_column(c) for c in df.columns)).alias("row")
    last = (
        _keyed(df, key)
        .groupBy(_column(key).alias("__key"))
        .agg(F.max(F.struct(*order, row)).alias("__last"))
        .select("__last.row.*")
    )
    return last.unionByName(_keyless(df, key))
