"""Table contracts: schemas, strict schema check, row-level rule violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, I, L = T.StringType(), T.IntegerType(), T.LongType()
STR_ARRAY = T.ArrayType(S, False)


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


RAW_PAGE = _struct(("url", S, False), ("raw_html", S, False), ("status", I, False),
                   ("fetched_at", S, False), ("depth", I, False))
PAGE = _struct(("url", S, False), ("title", S, False), ("markdown", S, False),
               ("content_hash", S, False), ("fetched_at", S, False), ("status", I, False),
               ("depth", I, False))
CHUNK = _struct(("chunk_id", S, False), ("url", S, False), ("heading_path", STR_ARRAY, False),
                ("text", S, False), ("token_estimate", I, False), ("chunk_hash", S, False),
                ("order", I, False))
CHANGE = _struct(("change_type", S, False), ("chunk_id", S, False), ("url", S, False),
                 ("heading_path", STR_ARRAY, False), ("text", S, False), ("chunk_hash", S, False))
SUMMARY = _struct(("added", L, False), ("modified", L, False), ("removed", L, False))
CHANGESET_HEADER = _struct(("run_at", S, False), ("prev_run_at", S, True), ("start_url", S, False),
                           ("summary", SUMMARY, False))
ENRICHED = _struct(("chunk_id", S, False), ("change_type", S, False), ("summary", S, False),
                   ("tags", STR_ARRAY, False))
INDEX_METADATA = _struct(("url", S, False), ("heading_path", S, False), ("chunk_hash", S, False))
INDEX_ROW = _struct(("id", S, False), ("document", S, False), ("metadata", INDEX_METADATA, False))

# Inputs that exist only in table form.
LINKS = _struct(("src_url", S, False), ("pos", I, False), ("dst_url", S, False))
ROBOTS = _struct(("host", S, False), ("text", S, False))
SITEMAP = _struct(("host", S, False), ("xml", S, False))
FETCH_LOG = _struct(("url", S, False), ("attempt", I, False), ("status", I, True))
SITES = _struct(("start_url", S, False), ("max_pages", I, False),
                ("include", STR_ARRAY, True), ("exclude", STR_ARRAY, True))

CHANGE_TYPES = ("added", "modified", "removed")
HASH_RULE = r"^sha256:[0-9a-f]{64}$"


class ContractError(ValueError):
    pass


def assert_schema(df: DataFrame, schema: T.StructType, *, allow_extra: bool = False) -> DataFrame:
    """Fail unless ``df`` has exactly the contract's columns with the contract's types.

    Names and data types are compared (nullability is a row rule, checked by
    :func:`contract_violations`).  Unknown columns are an error unless
    ``allow_extra`` is set.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in schema.fields}
    missing = [n for n in want if n not in have]
    wrong = [n for n in want if n in have and not _same_type(have[n], want[n])]
    extra = [n for n in have if n not in want]
    problems = []
    if missing:
        problems.append(f"missing {missing}")
    if wrong:
        problems.append("wrong type " + ", ".join(f"{n}: {have[n].simpleString()} != "
                                                  f"{want[n].simpleString()}" for n in wrong))
    if extra and not allow_extra:
        problems.append(f"unexpected {extra}")
    if problems:
        raise ContractError("; ".join(problems))
    return df


def _same_type(a: T.DataType, b: T.DataType) -> bool:
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return _same_type(a.elementType, b.elementType)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return [f.name for f in a.fields] == [f.name for f in b.fields] and all(
            _same_type(x.dataType, y.dataType) for x, y in zip(a.fields, b.fields))
    return a == b


def schema_json(schema: T.StructType) -> str:
    return schema.json()


def _rules(schema: T.StructType) -> list[tuple[str, Column]]:
    """(rule name, predicate that is true on a violating row) for a contract."""
    rules = []
    for f in schema.fields:
        if not f.nullable:
            rules.append((f"{f.name}_not_null", F.col(f"`{f.name}`").isNull()))
        if f.name in ("depth", "order", "token_estimate", "added", "modified", "removed"):
            rules.append((f"{f.name}_non_negative", F.col(f"`{f.name}`") < 0))
        if f.name == "change_type":
            rules.append(("change_type_enum", ~F.col("change_type").isin(*CHANGE_TYPES)))
        if f.name in ("content_hash", "chunk_hash"):
            rules.append((f"{f.name}_format", ~F.col(f.name).rlike(HASH_RULE)))
    return rules


def contract_violations(df: DataFrame, schema: T.StructType, key: str | list[str]) -> DataFrame:
    """One row ``(key..., rule)`` per broken value rule; empty when the table is clean.

    A narrow, map-only job: each row yields the names of the rules it breaks.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rules = _rules(schema)
    verdicts = F.array(*[F.when(pred, F.lit(name)) for name, pred in rules])
    return (df.select(*[F.col(k) for k in keys], F.explode(verdicts).alias("rule"))
              .where(F.col("rule").isNotNull()))


def _json_kinds(t: T.DataType) -> tuple[str, ...]:
    """Kinds of JSON values that a type takes, as a variant's schema names them (an empty array has no element kind)."""
    if isinstance(t, T.ArrayType):
        return ("ARRAY<VOID>", *[f"ARRAY<{k}>" for k in _json_kinds(t.elementType)])
    if isinstance(t, T.StructType):
        return ("OBJECT",)
    return {"string": ("STRING",), "boolean": ("BOOLEAN",), "double": ("DOUBLE", "DECIMAL", "BIGINT")}.get(t.simpleString(), ("BIGINT",))


def record_violations(lines: DataFrame, schema: T.StructType, value_col: str = "value") -> DataFrame:
    """One row ``(other columns..., field, rule)`` per way in which a JSON line is not a record of the contract.

    Rules: ``not_json`` (no object; the only finding of its line), ``missing``,
    ``unknown`` (a field that the contract doesn't have), ``null``, ``type``.
    Values are never converted: a number in quotes is text.
    """
    value = F.col(value_col)
    parsed = lines.withColumn("_v", F.try_parse_json(value)).withColumn("_names", F.json_object_keys(value))
    found = []
    for f in schema.fields:
        kind = F.regexp_extract(F.schema_of_variant(F.try_variant_get(F.col("_v"), f"$.{f.name}", "variant")), r"^(?:OBJECT|[A-Z]+(?:<[A-Z]+>)?)", 0)
        there = F.array_contains("_names", f.name)
        rule = (F.when(~there, F.lit("missing")).when(kind == "VOID", F.lit(None if f.nullable else "null"))
                .when(~kind.isin(*_json_kinds(f.dataType)), F.lit("type")))
        found.append(F.struct(F.lit(f.name).alias("field"), rule.alias("rule")))
    unknown = F.transform(F.array_except("_names", F.array(*[F.lit(n) for n in schema.fieldNames()])), lambda n: F.struct(n.alias("field"), F.lit("unknown").alias("rule")))
    broken = F.filter(F.concat(F.array(*found), unknown), lambda x: x["rule"].isNotNull())
    whole = F.when(F.col("_v").isNull() | F.col("_names").isNull(), F.array(F.struct(F.lit("").alias("field"), F.lit("not_json").alias("rule")))).otherwise(broken)
    keep = [c for c in lines.columns if c != value_col]
    return parsed.select(*keep, F.inline(whole))
