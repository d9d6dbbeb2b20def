"""The two row contracts, and their validation in one aggregate that reports every broken rule."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S, _D, _B, _TS, _L = T.StringType(), T.DoubleType(), T.BooleanType(), T.TimestampType(), T.LongType()

POSTING = T.StructType([
    T.StructField("posting_id", _S, False), T.StructField("source", _S, False), T.StructField("title", _S, False), T.StructField("company", _S), T.StructField("location_raw", _S),
    T.StructField("country", _S, False), T.StructField("region", _S), T.StructField("remote", _B), T.StructField("salary_min_eur", _D), T.StructField("salary_max_eur", _D),
    T.StructField("salary_period", _S), T.StructField("salary_annual_eur_p50", _D), T.StructField("salary_imputed", _B), T.StructField("posted_at", _TS, False), T.StructField("ingested_at", _TS, False),
    T.StructField("posting_url", _S, False), T.StructField("isco_code", _S), T.StructField("isco_match_method", _S), T.StructField("isco_match_score", _D), T.StructField("raw_payload", _S),
])

BENCHMARK = T.StructType([
    T.StructField("isco_code", _S, False), T.StructField("country", _S, False), T.StructField("period", _S, False), T.StructField("currency", _S, False), T.StructField("median_eur", _D, False),
    T.StructField("p25_eur", _D), T.StructField("p75_eur", _D), T.StructField("n_observations", _L), T.StructField("source", _S, False), T.StructField("source_url", _S, False), T.StructField("retrieved_at", _TS, False),
])

# What the contracts allow.
PERIODS = ("annual", "monthly", "weekly", "daily", "hourly")
METHODS = ("exact", "fuzzy", "llm", "none")
MOST_EUROS = 1e7


def _in(name: str, values: tuple[str, ...]) -> str:
    return f"{name} IN ({', '.join(repr(v) for v in values)})"


#: Rules beyond types and nulls, as SQL conditions that valid rows meet or leave unknown (null).
POSTING_RULES = {
    "title length": "char_length(title) BETWEEN 1 AND 500",
    "country length": "char_length(country) = 2",
    "salary_min_eur range": f"salary_min_eur BETWEEN 0 AND {MOST_EUROS}",
    "salary_max_eur range": f"salary_max_eur BETWEEN 0 AND {MOST_EUROS}",
    "salary_annual_eur_p50 range": f"salary_annual_eur_p50 BETWEEN 0 AND {MOST_EUROS}",
    "salary_period values": _in("salary_period", PERIODS),
    "posting_url prefix": "startswith(posting_url, 'http')",
    "isco_code form": "isco_code RLIKE '^[0-9]{4}$'",
    "isco_match_method values": _in("isco_match_method", METHODS),
    "isco_match_score range": "isco_match_score BETWEEN 0 AND 1",
}
BENCHMARK_RULES = {
    "isco_code form": "isco_code RLIKE '^[0-9]{4}$'",
    "country length": "char_length(country) = 2",
    "median_eur range": f"median_eur BETWEEN 0 AND {MOST_EUROS}",
    "p25_eur range": f"p25_eur BETWEEN 0 AND {MOST_EUROS}",
    "p75_eur range": f"p75_eur BETWEEN 0 AND {MOST_EUROS}",
    "n_observations range": "n_observations >= 0",
    "source_url prefix": "startswith(source_url, 'http')",
}


@dataclass(frozen=True)
class Contract:
    """A strict schema: the columns, the rules, and the column whose values must be unique, if any."""

    schema: T.StructType
    rules: dict[str, str]
    unique: str | None = None


POSTINGS = Contract(POSTING, POSTING_RULES, "posting_id")
BENCHMARKS = Contract(BENCHMARK, BENCHMARK_RULES)


class ContractError(ValueError):
    """Raised with all broken rules of a frame."""

    def __init__(self, broken: dict[str, int]):
        self.broken = broken
        super().__init__("; ".join(f"{k}: {n} rows" for k, n in broken.items()))


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """``df`` with the contract's columns in order and type; values that cannot be cast become null.

    Columns the contract lacks abort, as do missing ones."""
    extra = sorted(set(df.columns) - set(contract.schema.names))
    missing = sorted(set(contract.schema.names) - set(df.columns))
    if extra or missing:
        raise ContractError({f"column {c} not in schema": 0 for c in extra} | {f"column {c} missing": 0 for c in missing})
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in contract.schema])


def violations(df: DataFrame, contract: Contract) -> DataFrame:
    """rule, n_rows: how many rows break each rule, in one pass (a second for uniqueness, combined before it is shuffled)."""
    checks = {f"{f.name} not null": F.count_if(F.col(f.name).isNull()) for f in contract.schema if not f.nullable}
    checks |= {name: F.count_if(~F.expr(rule)) for name, rule in contract.rules.items()}
    one = df.agg(*[c.cast("long").alias(f"_{i}") for i, c in enumerate(checks.values())])
    rows = one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"_{i}").alias("n_rows")) for i, n in enumerate(checks)])).alias("r")).select("r.*")
    if contract.unique:
        twice = df.groupBy(contract.unique).agg((F.count("*") - 1).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))
        rows = rows.unionByName(twice.select(F.lit(f"{contract.unique} unique").alias("rule"), "n_rows"))
    return rows


def validate(df: DataFrame, contract: Contract) -> DataFrame:
    """``df`` conformed; raises ``ContractError`` listing every broken rule. At most one row per rule reaches the driver."""
    whole = conform(df, contract)
    broken = {r["rule"]: r["n_rows"] for r in violations(whole, contract).filter("n_rows > 0").collect()}
    if broken:
        raise ContractError(broken)
    return whole
