"""Rescued data: input that does not fit the schema is kept beside the typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

RESCUED = "_rescued_data"
_CORRUPT = "_corrupt"


def rescue_json(lines: DataFrame, schema: T.StructType, text: str = "value") -> DataFrame:
    """Parse JSON lines into ``schema`` columns plus ``_rescued_data``.

    A field is rescued when its name is unknown or its value does not convert to the
    declared type (NaN and infinities are no values); a line that is not exactly one JSON
    object is rescued whole. ``_rescued_data`` is
    null exactly when the line fits. Works on batch and streaming frames alike and stays
    in the JVM. A line that fits costs one typed parse and one pass over its keys; only a
    misfit is taken apart field by field.
    """
    names = [f.name for f in schema]
    other = [c for c in lines.columns if c != text]
    watched = T.StructType([*schema, T.StructField(_CORRUPT, T.StringType())])
    staged = lines.select(
        *other,
        F.col(text),
        F.json_object_keys(text).alias("_keys"),
        F.from_json(text, watched, {"columnNameOfCorruptRecord": _CORRUPT}).alias("_typed"),
    )

    broken = [f.name for f in schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]

    def value_of(known: str) -> Column:
        got = F.col("_typed").getField(known)
        return F.when(~F.isnan(got) & (F.abs(got) < float("inf")), got) if known in broken else got

    def misfit(name: Column, value: Column) -> Column:
        unconverted = F.lit(False)
        for known in names:
            unconverted = unconverted | (
                (name == known) & value.isNotNull() & value_of(known).isNull())
        return ~name.isin(names) | unconverted

    known = F.array(*[F.lit(n) for n in names])
    fits = F.col("_typed").getField(_CORRUPT).isNull() & (
        F.size(F.array_except("_keys", known)) == 0
    )
    for name in broken:
        fits = fits & F.col("_typed").getField(name).isNull().eqNullSafe(value_of(name).isNull())
    fields = F.from_json(text, T.MapType(T.StringType(), T.StringType()))
    # the parser stops after the object; as the only item of an array nothing may follow it
    alone = F.json_array_length(F.concat(F.lit("["), F.col(text), F.lit("]")))
    is_object = F.col("_keys").isNotNull() & F.coalesce(alone == 1, F.lit(False))
    judged = staged.withColumn(
        "_left", F.when(is_object & ~fits, F.to_json(F.map_filter(fields, misfit)))
    )
    rescued = F.when(is_object & (F.col("_left") != "{}"), F.col("_left")).when(
        ~is_object | F.col("_left").isNotNull(), F.col(text)
    )
    values = [F.when(is_object, value_of(n)).alias(n) for n in names]
    return judged.select(*other, *values, rescued.alias(RESCUED))


def rescue_columns(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed files, read with their own columns, as ``schema`` columns plus ``_rescued_data``.

    A value is rescued when its column is not declared or when it does not convert to the
    declared type without loss of its meaning (a failed cast, NaN or infinity in a declared
    float). Columns that the files lack are null. ``_rescued_data`` is a JSON object of the
    rescued values and null exactly when the row fits. Works on batch and streaming frames.
    """
    own = {c.lower(): c for c in rows.columns}
    declared = {f.name.lower() for f in schema}
    values, left = [], []
    for field in schema:
        name = own.get(field.name.lower())
        if name is None:
            values.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        given = F.col(f"`{name}`")
        if rows.schema[name].dataType == field.dataType:
            got = given
        else:
            got = given.try_cast(field.dataType)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            got = F.when(~F.isnan(got) & (F.abs(got) < float("inf")), got)
        whole = isinstance(field.dataType, T.IntegralType)
        fraction = isinstance(rows.schema[name].dataType, T.FractionalType)
        if whole and fraction:
            got = F.when(got.cast(rows.schema[name].dataType) == given, got)
        values.append(got.alias(field.name))
        left.append(F.when(got.isNull(), given).alias(field.name))
    left += [F.col(f"`{c}`") for key, c in own.items() if key not in declared]
    rescued = F.nullif(F.to_json(F.struct(*left)), F.lit("{}")) if left else F.lit(None).cast("string")
    return rows.select(*values, rescued.alias(RESCUED))
