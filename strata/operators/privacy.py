"""Column masking per audience (a dynamic view as a DataFrame function).

``policy`` maps a column to ``(rule, allowed_audiences)`` or
``(rule, allowed_audiences, params)``. An allowed audience sees the raw
value, every other known audience sees the rule's output, and an audience
nobody declared gets the strictest rule (NULL) for every policy column.
All rules are column expressions, so masking adds no job and no UDF.

Masking is closed by default: policy columns are found as Spark finds columns
(``CPF`` names ``cpf`` unless the session is case-sensitive), a policy column
the table lacks raises instead of letting a misspelt column through, and the
hash rule needs a salt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.masking import digits_masked, email_domain_only, hash_with_salt, nullify, partial



class PolicyError(ValueError):
    pass


def _salt(params: dict) -> str:
    if not params.get("salt"):
        raise PolicyError("the hash rule needs a salt")
    return params["salt"]


RULES = {
    "hash": lambda c, p: hash_with_salt(c, _salt(p)),
    "partial": lambda c, p: partial(c, p.get("keep_start", 1), p.get("keep_end", 0), p.get("fill", "*")),
    "email": lambda c, p: email_domain_only(c),
    "digits": lambda c, p: digits_masked(c, p.get("keep_last", 2)),
    "null": lambda c, p: nullify(c, p.get("_type")),
}


def mask_expr(col: str, rule: str, params: dict | None = None) -> Column:
    if rule not in RULES:
        raise ValueError(f"unknown masking rule {rule!r}")
    return RULES[rule](F.col(col), params or {})


def mask_columns(df: DataFrame, policy: dict, audience: str, audiences: list[str] | None = None) -> DataFrame:
    known = set(audiences or [])
    for spec in policy.values():
        known.update(spec[1])
    out = {}
    sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    fold = (lambda c: c) if sensitive else str.lower
    names: dict[str, list[str]] = {}
    for c in df.columns:
        names.setdefault(fold(c), []).append(c)
    for named, spec in policy.items():
        if fold(named) not in names:
            raise PolicyError(f"policy column {named!r} is not a column of the table: {df.columns}")
        rule, allowed = spec[0], set(spec[1])
        params = spec[2] if len(spec) > 2 else {}
        for col in names[fold(named)]:
            if audience not in known:
                out[col] = nullify(F.col(col), df.schema[col].dataType)
            elif audience not in allowed:
                out[col] = mask_expr(col, rule, {**params, "_type": df.schema[col].dataType})
            else:
                mask_expr(col, rule, {**params, "_type": df.schema[col].dataType})  # a faulty rule raises for every audience
    return df.withColumns(out) if out else df
