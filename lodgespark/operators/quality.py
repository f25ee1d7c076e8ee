"""Keys, references and types: the constraints of the serving tables as
Spark checks that return violation rows and counts instead of raising on
insert.

Joins against the parent table are ``left_semi`` / ``left_anti`` on the key:
AQE broadcasts the parent keys when they are small and keeps a shuffle join
(with skew splitting of hot child keys) when they are not.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DataType, DateType, IntegerType, LongType, ShortType, StructType)

from lodgespark.functions import scalars as S
from lodgespark.session import scratch_path


def _id_of(df: DataFrame, column: str) -> Column:
    """An identifier as bigint; a column that is one already is not parsed as text."""
    return df[column] if df.schema[column].dataType == LongType() else S.parse_id(df[column])


def _parent_keys(parents: DataFrame, parent_key: str) -> DataFrame:
    # Distinct keys: partial aggregation in each map task, then one shuffle.
    k = parents.select(_id_of(parents, parent_key).alias("__k"))
    return k.filter(F.col("__k").isNotNull()).distinct()


def semi_join_valid_parents(child: DataFrame, parents: DataFrame, child_key: str = "listing_id",
                            parent_key: str = "id") -> DataFrame:
    """Child rows whose key exists among the parents.  Keys are compared as
    identifiers; text that is none never matches."""
    keys = _parent_keys(parents, parent_key)
    return child.join(keys, _id_of(child, child_key) == keys["__k"], "left_semi")


def fk_orphans(child: DataFrame, parents: DataFrame, child_key: str = "listing_id",
               parent_key: str = "id") -> DataFrame:
    """Child rows whose non-null key has no parent (a foreign-key violation;
    a key that is no identifier has none).  A null key is not an orphan (SQL
    foreign keys ignore nulls)."""
    keys = _parent_keys(parents, parent_key)
    return child.filter(child[child_key].isNotNull()).join(keys, _id_of(child, child_key) == keys["__k"], "left_anti")


def reference_state(child: DataFrame, parents: DataFrame, child_key: str = "listing_id", parent_key: str = "id",
                    out_col: str = "reference") -> DataFrame:
    """``child`` with ``out_col``: 'ok', 'orphan' or 'null_key', every row
    exactly once, from one left join to the distinct parent keys."""
    keys = _parent_keys(parents, parent_key)
    out = child.join(keys, _id_of(child, child_key) == keys["__k"], "left")
    state = F.when(F.col(child_key).isNull(), "null_key").when(F.col("__k").isNull(), "orphan").otherwise("ok")
    return out.withColumn(out_col, state).drop("__k")


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values held by more than one row: (key..., rows)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias("rows"))
              .filter(F.col("rows") > 1))


def check_not_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """(column, violations) for the NOT NULL columns, from one aggregate."""
    cols = list(columns)
    one = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(f"v__{i}") for i, c in enumerate(cols)])
    structs = [F.struct(F.lit(c).alias("column"), F.coalesce(F.col(f"v__{i}"), F.lit(0)).cast("bigint")
                        .alias("violations")) for i, c in enumerate(cols)]
    return one.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


_INTEGRAL = (ByteType, ShortType, IntegerType, LongType)


def type_violation(col: str, target: DataType):
    """True where a non-null value does not fit ``target``: the cast gives
    null, or a non-integral number meets an integer column."""
    c = F.col(col)
    cast = S.parse_date(col) if isinstance(target, DateType) else c.try_cast(target)
    bad = c.isNotNull() & cast.isNull()
    if isinstance(target, _INTEGRAL):
        as_double = c.try_cast("double")
        bad = bad | (c.isNotNull() & as_double.isNotNull() & (as_double != F.floor(as_double)))
    return bad


def check_types(df: DataFrame, schema: StructType) -> DataFrame:
    """(column, target_type, violations) for every column of ``schema`` present."""
    fields = [f for f in schema.fields if f.name in df.columns]
    one = df.agg(*[F.sum(type_violation(f.name, f.dataType).cast("long")).alias(f"v__{i}")
                   for i, f in enumerate(fields)])
    structs = [F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("target_type"),
                        F.coalesce(F.col(f"v__{i}"), F.lit(0)).cast("bigint").alias("violations"))
               for i, f in enumerate(fields)]
    return one.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def quality_report(table: str, df: DataFrame, keys: list[str] | None = None,
                   not_null: Iterable[str] = (), parents: Mapping[str, tuple[DataFrame, str]] | None = None,
                   schema: StructType | None = None, policy: str = "fail") -> DataFrame:
    """One table of (table_name, rule, columns, violations, status) for all
    rules of one table: unique key (a grouped count), not-null and types (one
    aggregate together), references (an anti join per parent)."""
    parts = []
    if keys:
        dups = check_unique(df, keys).agg(F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("violations"))
        parts.append(dups.select(F.lit("unique").alias("rule"), F.lit(",".join(keys)).alias("columns"),
                                 F.col("violations").cast("bigint").alias("violations")))
    # not-null and type rules: one aggregate over the table
    rules = [("not_null", c, F.col(c).isNull()) for c in not_null]
    if schema is not None:
        rules += [("type", f.name, type_violation(f.name, f.dataType)) for f in schema.fields if f.name in df.columns]
    if rules:
        one = df.agg(*[F.sum(cond.cast("long")).alias(f"v__{i}") for i, (_, _, cond) in enumerate(rules)])
        structs = [F.struct(F.lit(r).alias("rule"), F.lit(c).alias("columns"),
                            F.coalesce(F.col(f"v__{i}"), F.lit(0)).cast("bigint").alias("violations"))
                   for i, (r, c, _) in enumerate(rules)]
        parts.append(one.select(F.explode(F.array(*structs)).alias("r")).select("r.*"))
    for col, (parent, pkey) in (parents or {}).items():
        orph = fk_orphans(df, parent, col, pkey).agg(F.count(F.lit(1)).cast("bigint").alias("violations"))
        parts.append(orph.select(F.lit("foreign_key").alias("rule"), F.lit(col).alias("columns"), "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.lit(table).alias("table_name"), "rule", "columns", "violations",
                      F.when(F.col("violations") > 0, F.lit(policy)).otherwise(F.lit("ok")).alias("status"))


def first_violation(df: DataFrame, schema: StructType, keys: list[str], not_null: Iterable[str] = (),
                    parents: Mapping[str, tuple[DataFrame, str]] | None = None, out_col: str = "violation",
                    place: Iterable[str] | None = None) -> DataFrame:
    """``df`` with ``out_col``: the first rule of the serving table a row
    breaks, or null.  Rules in order: a value that does not fit its type
    ('type:column'), a null in a NOT NULL column ('not_null:column'), a
    reference without a parent ('orphan:column'), and a key that an earlier
    row has ('duplicate_key', after the typed key).  Each row comes back once;
    no value is changed.

    ``place`` names columns that tell the rows apart and order them (their
    file and number in it, say); the first row of a key stays.
    """
    present = [f for f in schema.fields if f.name in df.columns]
    rule = F.lit(None).cast("string")
    for c in reversed([c for c in not_null if c in df.columns]):
        rule = F.when(F.col(c).isNull(), F.lit(f"not_null:{c}")).otherwise(rule)
    for f in reversed(present):
        if df.schema[f.name].dataType != f.dataType:
            rule = F.when(type_violation(f.name, f.dataType), F.lit(f"type:{f.name}")).otherwise(rule)
    df = df.withColumn(out_col, rule)
    for c, (parent, pkey) in (parents or {}).items():
        df = reference_state(df, parent, c, pkey, "__ref").withColumn(
            out_col, F.when(F.col(out_col).isNull() & (F.col("__ref") == "orphan"), F.lit(f"orphan:{c}")).otherwise(F.col(out_col))).drop("__ref")
    if all(k in df.columns for k in keys):
        if not place:
            raise ValueError("a key rule needs the columns that order the rows")
        df = _later_rows_of_a_key(df, {k: F.col(k).try_cast(schema[k].dataType) for k in keys}, out_col, list(place))
    return df


def _later_rows_of_a_key(df: DataFrame, typed_keys: Mapping[str, Column], out_col: str, place: list[str]) -> DataFrame:
    """``out_col`` 'duplicate_key' for rows that break no rule so far and are not the first of their typed key.

    1. A pass over the keys alone finds those of several rows.  Its counts
       combine in the map tasks, so a key of a third of all rows is one row a
       task there; no place of a row moves.
    2. The rows of these keys that break no rule give their first places.
    3. The rows meet the keys that several such rows have in one join.  Rows
       that break a rule already (junk keys, which are all null) are spread by
       their own hash instead of meeting at the null key, and a hot key of
       valid rows is on the side of the join that adaptive execution splits.

    The keys of 1 and 2 are stored under the checkpoint folder, so the joins
    are planned with their size: few keys are sent to the rows, which then do
    not move, and tables without a repeated key are not joined at all.
    """
    names = [f"__key{i}" for i in range(len(typed_keys))]
    keyed = df.withColumns(dict(zip(names, typed_keys.values())))
    several = _stored_keys(keyed.groupBy(*names).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(*names))
    if several.isEmpty():
        return df
    keyed = keyed.withColumn("__place", F.struct(*place))
    fine = F.col(out_col).isNull()

    def of(keys: DataFrame) -> tuple[DataFrame, Column]:
        same = F.col("__spread") == F.col("__spread_of")
        for n in names:
            same = same & F.col(n).eqNullSafe(F.col(f"{n}_of"))
        return keys.withColumn("__spread_of", F.xxhash64(*names)).withColumnsRenamed({n: f"{n}_of" for n in names}), same

    found, same = of(several)
    tried = keyed.where(fine).select(*names, "__place").withColumn("__spread", F.xxhash64(*names)).join(found, same, "left_semi")
    firsts = tried.groupBy(*names).agg(F.count(F.lit(1)).alias("__n"), F.min("__place").alias("__first"))
    found, same = of(_stored_keys(firsts.where("__n > 1").drop("__n")))
    spread = F.when(fine, F.xxhash64(*names)).otherwise(F.xxhash64("__place"))
    met = keyed.withColumn("__spread", spread).join(found, same, "left")
    later = fine & F.col("__first").isNotNull() & (F.col("__place") != F.col("__first"))
    helpers = [*names, *[f"{n}_of" for n in names], "__place", "__first", "__spread_of", "__spread"]
    return met.withColumn(out_col, F.when(later, "duplicate_key").otherwise(F.col(out_col))).drop(*helpers)


def _stored_keys(keys: DataFrame) -> DataFrame:
    path = scratch_path(keys.sparkSession, "repeated-keys")
    keys.write.parquet(path)
    return keys.sparkSession.read.schema(keys.schema).parquet(path)
