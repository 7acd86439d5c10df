"""Field rules over nested objects."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowframe.operators.columns import quoted

MISSING = "MissingMapping"
INVALID = "InvalidFormat"


def rules_from(spec: dict) -> dict[str, str]:
    """Rules {field: regex} from `{"validations": [[field, regex], ...]}`."""
    return {field: regex for field, regex in spec["validations"]}


def validate_fields(df: DataFrame, rules: Mapping[str, str], ids: Sequence[str]) -> DataFrame:
    """Every violation as a row: ids, field, value, violation.

    Each leaf field needs a rule under its name, `parent.child` inside a list, and its value
    must contain a match of the rule's pattern. The fields are known from the schema, so the
    rules are part of the expression and the whole check is one pass without a join. Elements of
    a list of plain values are checked under the list's name. Missing
    (null) values are not checked.
    """
    found = [v for f in df.schema.fields for v in violations(F.col(quoted(f.name)), f.dataType, f.name, rules)]
    every = F.concat(*found) if found else no_violations()
    return df.select(*ids, F.explode(every).alias("v")).select(*ids, "v.*")


def violations(value: Column, kind: T.DataType, name: str, rules: Mapping[str, str]) -> list[Column]:
    """Arrays of violations of one field, one array per leaf below it."""
    if isinstance(kind, T.StructType):
        return [v for f in kind.fields for v in violations(value[f.name], f.dataType, f"{name}.{f.name}", rules)]
    if isinstance(kind, T.ArrayType):
        if not isinstance(kind.elementType, T.StructType):
            checks = len(violations(F.lit(None), kind.elementType, name, rules))
            inside = [F.transform(value, element_check(kind.elementType, i, name, rules)) for i in range(checks)]
            return [F.coalesce(F.flatten(x), no_violations()) for x in inside]
        out = []
        for f in kind.elementType.fields:
            for i in range(len(violations(F.lit(None), f.dataType, "", rules))):
                inside = F.transform(value, child_check(f, i, f"{name}.{f.name}", rules))
                out.append(F.coalesce(F.flatten(inside), no_violations()))
        return out
    text = value.cast("string")
    kept = F.struct(F.lit(name).alias("field"), text.alias("value"), F.lit(INVALID if name in rules else MISSING).alias("violation"))
    bad = text.isNotNull() & ~text.rlike(rules[name]) if name in rules else text.isNotNull()
    return [F.when(bad, F.array(kept)).otherwise(no_violations())]


def child_check(child: T.StructField, i: int, name: str, rules: Mapping[str, str]):
    return lambda x: violations(x[child.name], child.dataType, name, rules)[i]


def element_check(kind: T.DataType, i: int, name: str, rules: Mapping[str, str]):
    return lambda x: violations(x, kind, name, rules)[i]


def no_violations() -> Column:
    return F.array().cast("array<struct<field:string,value:string,violation:string>>")
