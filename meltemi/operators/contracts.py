"""Gold table contracts, read from documents: one aggregate per table answers every rule.

A contract is a document of the open data contract standard: fields with types, limits and valid values,
a least row count, and rules in SQL. Documents are JSON, or YAML where a parser is installed; the four of
the Gold tables are in meltemi/contracts, and others can be read from any folder Spark reaches. A changed
document changes the outcome; no code names a limit.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VIOLATION = "table string, check_name string, reason string"


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    low: float | None = None
    high: float | None = None
    values: tuple = ()


@dataclass(frozen=True)
class Contract:
    table: str
    fields: tuple[Field, ...]
    # (description, SQL predicate of a violating row)
    rules: tuple[tuple[str, str], ...] = field(default=())
    #: Rows the table must have more of.
    more_rows_than: int = 0


_COUNT_OF = re.compile(r"\s*select\s+count\(\*\)\s+from\s+\S+\s+where\s+(.+?)\s*;?\s*", re.IGNORECASE | re.DOTALL)


def contract_of(document: dict) -> Contract:
    """The contract a document states for its first table; a rule of a form that is not known raises."""
    table = document["schema"][0]
    rules, least = [], 0
    for q in table.get("quality", ()):
        if q.get("metric") == "rowCount" and "mustBeGreaterThan" in q:
            least = q["mustBeGreaterThan"]
        elif q.get("type") == "sql" and q.get("mustBe") == 0 and (found := _COUNT_OF.fullmatch(q["query"])):
            rules.append((q["description"], found[1]))
        else:
            raise ValueError(f"{table['name']}: no way to check {q}")
    fields = []
    for p in table["properties"]:
        limits, values = p.get("logicalTypeOptions", {}), ()
        for q in p.get("quality", ()):
            if q.get("metric") != "invalidValues" or q.get("mustBe") != 0:
                raise ValueError(f"{table['name']}.{p['name']}: no way to check {q}")
            values = tuple(q["arguments"]["validValues"])
        fields.append(Field(p["name"], p["logicalType"], limits.get("minimum"), limits.get("maximum"), values))
    return Contract(table["name"], tuple(fields), tuple(rules), least)


def parse_document(name: str, text: str) -> dict:
    if not name.endswith((".yaml", ".yml")):
        return json.loads(text)
    import yaml

    return yaml.safe_load(text)


def packaged() -> dict[str, Contract]:
    """The contracts that come with the library, by table."""
    files = sorted((f for f in resources.files("meltemi").joinpath("contracts").iterdir() if f.name.endswith(".json")), key=lambda f: f.name)
    found = [contract_of(parse_document(f.name, f.read_text("utf-8"))) for f in files]
    return {c.table: c for c in found}


def read_documents(spark: SparkSession, folder: str) -> dict[str, Contract]:
    """Contracts of a folder of documents, one per table."""
    files = spark.read.format("binaryFile").load(folder).select("path", "content").orderBy("path").collect()
    found = [contract_of(parse_document(f.path, bytes(f.content).decode())) for f in files]
    return {c.table: c for c in found}


CONTRACTS = packaged()
_KINDS = {"string": ("string",), "number": ("double", "float", "decimal"),
          "integer": ("bigint", "int", "smallint", "tinyint")}


def _count_if(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("long")


def check_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """Every check of a contract with its outcome. Nulls satisfy range and value rules."""
    t = contract.table
    sums: list[Column] = [F.count("*").alias("n_rows")]
    rows: list[Column] = []

    def result(name: str, reason: Column, passed: Column) -> None:
        rows.append(F.struct(F.lit(t).alias("table"), F.lit(name).alias("check_name"),
                             reason.alias("reason"), passed.alias("passed")))

    def counted(name: str, condition: Column, measure: str) -> None:
        alias = f"c{len(sums)}"
        sums.append(_count_if(condition).alias(alias))
        n = F.col(alias)
        reason = F.concat(F.lit(f"Actual {measure} was "), n.cast("string"), F.lit(", expected = 0"))
        result(name, reason, n == 0)

    n_rows = F.col("n_rows")
    result(
        f"Check that model {t} has row_count > {contract.more_rows_than}",
        F.concat(F.lit(f"Actual row_count({t}) was "), n_rows.cast("string"), F.lit(f", expected > {contract.more_rows_than}")),
        n_rows > contract.more_rows_than,
    )
    for f in contract.fields:
        here = f.name in df.columns
        result(f"Check that field '{f.name}' is present",
               F.lit("" if here else f"Required column '{f.name}' is missing"), F.lit(here))
        if not here:
            continue
        c, measure = F.col(f.name), f"invalid_count({f.name})"
        if f.low is not None:
            counted(f"Check that field {f.name} has a minimum of {f.low}", c < f.low, measure)
        if f.high is not None:
            counted(f"Check that field {f.name} has a maximum of {f.high}", c > f.high, measure)
        if f.values:
            counted(f"Check that field {f.name} has invalid_count = 0",
                    c.isNotNull() & ~c.isin(*f.values), measure)
    for description, predicate in contract.rules:
        counted(description, F.expr(predicate), f"custom_sql({t})")
    return df.agg(*sums).select(F.inline(F.array(*rows)))


RULES = """table string, position int, check_name string, kind string, field string, low double, high double, values array<string>"""
#: Stands for the row itself among its fields.
ROW = "*"


def rule_rows(spark: SparkSession, contracts: dict[str, Contract]) -> DataFrame:
    """Every rule of the contracts as a row."""
    rows = []
    for c in contracts.values():
        own = [(f"Check that model {c.table} has row_count > {c.more_rows_than}", "row count", ROW, float(c.more_rows_than), None, None)]
        for f in c.fields:
            own.append((f"Check that field '{f.name}' is present", "present", f.name, None, None, None))
            if f.low is not None:
                own.append((f"Check that field {f.name} has a minimum of {f.low}", "limit", f.name, float(f.low), None, None))
            if f.high is not None:
                own.append((f"Check that field {f.name} has a maximum of {f.high}", "limit", f.name, None, float(f.high), None))
            if f.values:
                own.append((f"Check that field {f.name} has invalid_count = 0", "values", f.name, None, None, [str(v) for v in f.values]))
        own += [(description, "sql", predicate, None, None, None) for description, predicate in c.rules]
        rows += [(c.table, k, *rule) for k, rule in enumerate(own)]
    return spark.createDataFrame(rows, RULES)


def check_rules(frames: dict[str, DataFrame], rules: DataFrame) -> DataFrame:
    """(table, check_name, reason, passed) of every rule of the tables given.

    A row of a table becomes one row per field, and one for itself; joined with the rules, of which
    there are as many as the documents state, each says whether it breaks its rule. Tasks send on one
    count per rule.
    """
    conditions = {(r.table, r.field) for r in rules.filter("kind = 'sql'").select("table", "field").collect()}
    entry = "struct<field: string, number: double, text: string>"
    parts, present = [], []
    for table, df in frames.items():
        entries = [F.struct(F.lit(ROW), F.lit(None).cast("double"), F.lit(None).cast("string")).cast(entry)]
        for f in df.schema.fields:
            c = F.col(f"`{f.name}`")
            if f.dataType.typeName() in ("array", "map", "struct", "binary", "variant"):
                c = F.lit(None)
            entries.append(F.struct(F.lit(f.name), c.try_cast("double"), c.cast("string")).cast(entry))
        for p in sorted(p for t, p in conditions if t == table):
            entries.append(F.struct(F.lit(p), F.when(F.expr(p), 1.0), F.lit(None).cast("string")).cast(entry))
        parts.append(df.select(F.lit(table).alias("table"), F.inline(F.array(*entries))))
        present.append((table, df.columns))
    held = F.broadcast(rules.filter("kind <> 'present'").select("table", "field", "position", "kind", "low", "high", "values"))
    number, text = F.col("number"), F.col("text")
    # A limit that is not set compares to null, which is not counted.
    broken = (
        F.when(F.col("kind") == "row count", True)
        .when(F.col("kind") == "limit", (number < F.col("low")) | (number > F.col("high")))
        .when(F.col("kind") == "values", text.isNotNull() & ~F.array_contains("values", text))
        .otherwise(number == 1.0)
    )
    counts = reduce(DataFrame.unionByName, parts).join(held, ["table", "field"]).groupBy("table", "position").agg(
        F.count(F.when(broken, 1)).alias("n"))
    spark = rules.sparkSession
    columns = spark.createDataFrame(present, "table string, columns array<string>")
    n, kind, name = F.coalesce("n", F.lit(0)), F.col("kind"), F.col("field")
    here = F.array_contains("columns", name)
    measure = F.when(kind == "sql", F.concat(F.lit("custom_sql("), "table", F.lit(")"))).otherwise(F.concat(F.lit("invalid_count("), name, F.lit(")")))
    least = F.col("low").cast("long").cast("string")
    reason = (
        F.when(kind == "row count", F.concat(F.lit("Actual row_count("), "table", F.lit(") was "), n.cast("string"), F.lit(", expected > "), least))
        .when(kind == "present", F.when(here, "").otherwise(F.concat(F.lit("Required column '"), name, F.lit("' is missing"))))
        .otherwise(F.concat(F.lit("Actual "), measure, F.lit(" was "), n.cast("string"), F.lit(", expected = 0")))
    )
    passed = F.when(kind == "row count", n > F.col("low")).when(kind == "present", here).otherwise(n == 0)
    checked = rules.join(F.broadcast(columns), "table").join(counts, ["table", "position"], "left")
    return checked.filter(kind.isin("row count", "present", "sql") | here).select("table", "check_name", reason.alias("reason"), passed.alias("passed"))


def type_warnings(df: DataFrame, contract: Contract) -> list[str]:
    """Columns whose type differs from the contract; these only warn."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return [
        f"{f.name}: {actual[f.name]} is not {f.kind}"
        for f in contract.fields
        if f.name in actual and not actual[f.name].startswith(_KINDS[f.kind])
    ]


def missing_partitions(df: DataFrame, wanted: DataFrame) -> DataFrame:
    """Requested partition dates a table does not hold."""
    return wanted.select("partition_date").distinct().join(
        df.select(F.col("partition_date").cast("string")).distinct(), "partition_date", "left_anti"
    )


def wanted_dates(spark: SparkSession, dates: list[str]) -> DataFrame:
    return spark.createDataFrame([(d,) for d in dates], "partition_date string")


def missing_partition_violations(df: DataFrame, table: str, wanted: DataFrame) -> DataFrame:
    """One violation naming all missing dates; the request list bounds its length."""
    gaps = missing_partitions(df, wanted).agg(F.array_sort(F.collect_list("partition_date")).alias("gaps"))
    names = F.concat(F.lit("['"), F.array_join("gaps", "', '"), F.lit("']"))
    return gaps.filter(F.size("gaps") > 0).select(
        F.lit(table).alias("table"), F.lit("missing requested partition(s)").alias("check_name"),
        names.alias("reason"),
    )


def violations(df: DataFrame, contract: Contract) -> DataFrame:
    return check_contract(df, contract).filter(~F.col("passed")).drop("passed")


def verify_gold(
    spark: SparkSession, readers: dict[str, Callable[[], DataFrame]], dates: list[str] | None = None, documents: str | None = None
) -> DataFrame:
    """Violations over all Gold tables, by the packaged contracts or those of a folder of documents.

    A table that cannot be read, or has no contract, is one violation.
    """
    contracts = read_documents(spark, documents) if documents else CONTRACTS
    parts = []
    for name, reader in readers.items():
        try:
            df = reader()
            parts.append(violations(df, contracts[name]))
            if dates and "partition_date" in df.columns:
                parts.append(missing_partition_violations(df, name, wanted_dates(spark, dates)))
        except Exception as error:  # any storage failure counts as a finding
            parts.append(spark.createDataFrame([(name, "cannot read table", str(error))], VIOLATION))
    return reduce(DataFrame.unionByName, parts)


def message(table: Column, check: Column, reason: Column) -> Column:
    return F.concat(F.lit("gold/"), table, F.lit(": "), check, F.lit(": "), reason)
