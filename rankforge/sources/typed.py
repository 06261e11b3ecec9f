"""Spec-driven typed read (S4), role projection (P2), dropping listed
features (P3) and field aliasing (P5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.spec import FeatureSpec

SPARK_TYPES = {"float": "double", "int64": "bigint", "string": "string"}


def typed_read(df: DataFrame, schema: list, keep=()) -> DataFrame:
    """``schema`` = [(name, dtype, shape, default)]: cast every declared
    column, fill the default for nulls and NaN (a vector of another length than
    declared is an error), use ``lit(default)`` for absent
    columns, an empty list for missing var-length lists (shape 0); unlisted
    columns are dropped, so the scan reads only declared columns."""
    present = set(df.columns)
    out = [F.col(k) for k in keep]
    for name, dtype, shape, default in schema:
        t = SPARK_TYPES[dtype]
        if shape == 0:
            t = f"array<{t}>"
            base = F.col(name).cast(t) if name in present else F.lit(None).cast(t)
            out.append(F.coalesce(base, F.array().cast(t)).alias(name))
            continue
        if shape > 1:
            t = f"array<{t}>"
            fill = F.array(*[F.lit(default)] * shape).cast(t)
        else:
            fill = F.lit(default).cast(t)
        base = F.col(name).cast(t) if name in present else F.lit(None).cast(t)
        if shape > 1:
            full = F.coalesce(base, fill)
            if dtype == "float":
                full = F.transform(full, lambda x: F.coalesce(F.nanvl(x, F.lit(float(default))), F.lit(float(default))))
            full = F.when(F.size(full) == shape, full).otherwise(F.raise_error(F.lit(f"{name}: vector length != {shape}")).cast(t))
        else:
            full = F.coalesce(F.nanvl(base, fill) if dtype == "float" else base, fill)
        out.append(full.alias(name))
    return df.select(*out)


def role_projection(compiled: DataFrame, spec: FeatureSpec, role: str, keep=()) -> DataFrame:
    """Columns of one model-input role, emitted features only (``is_out``)."""
    cols = [f.name for f in spec.role(role) if f.name in compiled.columns]
    return compiled.select(*keep, *cols)


def drop_listed(spec: FeatureSpec, names) -> FeatureSpec:
    return spec.drop(names)


def read_name_list(spark, path: str) -> list:
    """One feature name per line → distinct names (a tiny side file)."""
    rows = spark.read.text(path).select(F.trim("value").alias("n")).where(F.col("n") != "").distinct().collect()
    return sorted(r.n for r in rows)
