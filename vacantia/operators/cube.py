"""Statistics cubes: JSON-stat 2.0 (dense or sparse) and SDMX-JSON observations as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.functions import jsonshape as js
from vacantia.functions import lookup
from vacantia.runtime import once


def _codes(dimension: Column) -> Column:
    """The codes of a dimension in order; its index is a list of codes or an object of code to position."""
    index = js.member(js.member(dimension, "category"), "index")
    listed = F.try_variant_get(index, "$", "array<string>")
    mapped = F.try_variant_get(index, "$", "map<string,int>")
    pairs = F.array_sort(F.transform(F.map_entries(mapped), lambda e: F.struct(e["value"].alias("at"), e["key"].alias("code"))))
    single = F.map_keys(F.try_variant_get(dimension, "$.category.label", "map<string,string>"))
    return F.coalesce(listed, F.transform(pairs, lambda p: p["code"]), single)


def jsonstat_cells(df: DataFrame, text: str) -> DataFrame:
    """``df`` without ``text``, with pos, value, coords (map of dimension to code), at and last (maps of dimension to position and
    to its last position) of each cell that has a value.

    Values come as a list or as an object of flat position to value; null values, positions beyond the cube and
    documents that are no JSON-stat give no cells. The flat position is row-major: the last dimension runs fastest."""
    keep = [c for c in df.columns if c != text]
    x = once(df, "_v", js.parse(F.col(text))).drop(text)
    ids, sizes = F.try_variant_get("_v", "$.id", "array<string>"), F.try_variant_get("_v", "$.size", "array<int>")
    dims = F.try_variant_get("_v", "$.dimension", "map<string,variant>")
    x = once(x, "_d", F.struct(ids.alias("ids"), sizes.alias("sizes"), F.transform(ids, lambda i: _codes(F.try_element_at(dims, i))).alias("codes")))
    dense = F.transform(F.try_variant_get("_v", "$.value", "array<double>"), lambda v, i: F.struct(i.cast("int").alias("pos"), v.alias("value")))
    sparse = F.transform(F.map_entries(F.try_variant_get("_v", "$.value", "map<string,double>")), lambda e: F.struct(e["key"].try_cast("int").alias("pos"), e["value"].alias("value")))
    cells = F.coalesce(dense, sparse)
    x = x.select(*keep, "_d", F.explode(cells).alias("c")).filter("c.value IS NOT NULL AND c.pos >= 0")
    n = F.size("_d.sizes")
    stride = lambda k: F.aggregate(F.slice("_d.sizes", k + 2, F.greatest(n - k - 1, F.lit(0))), F.lit(1), lambda a, b: a * b)
    at = F.transform(F.sequence(F.lit(0), n - 1), lambda k: (F.floor(F.col("c.pos") / stride(k)) % F.get("_d.sizes", k)).cast("int"))
    total = F.aggregate("_d.sizes", F.lit(1), lambda a, b: a * b)
    x = x.filter((n > 0) & (F.col("c.pos") < total))
    coords = F.map_from_arrays("_d.ids", F.zip_with("_d.codes", at, lambda codes, i: F.get(codes, i)))
    ends = F.map_from_arrays("_d.ids", F.transform("_d.codes", lambda codes: F.size(codes) - 1))
    return x.select(*keep, F.col("c.pos").alias("pos"), F.col("c.value").alias("value"), coords.alias("coords"), F.map_from_arrays("_d.ids", at).alias("at"), ends.alias("last"))


def sdmx_observations(df: DataFrame, text: str) -> DataFrame:
    """``df`` without ``text``, with value, coords (dimension to code) and attributes (attribute to code) of each observation.

    The key ``i:j:k`` holds positions in the lists of the dimensions' values; an observation is its value followed by
    positions in the lists of attributes' values. Null values and positions without a code give null codes or no rows."""
    keep = [c for c in df.columns if c != text]
    x = once(df, "_v", js.parse(F.col(text))).drop(text)
    root = F.coalesce(js.member(F.col("_v"), "data"), F.col("_v"))
    first = F.get(js.items(js.member(root, "structures")), F.lit(0))
    structure = F.coalesce(first, js.member(root, "structure"))

    def lists(kind: str) -> Column:
        own = js.items(F.try_variant_get(structure, f"$.{kind}.observation", "variant"))
        return F.transform(own, lambda d: F.struct(js.text(d, "id").alias("id"), F.transform(js.items(js.member(d, "values")), lambda v: js.text(v, "id")).alias("codes")))

    observed = F.try_variant_get(F.get(js.items(js.member(root, "dataSets")), F.lit(0)), "$.observations", "map<string,array<double>>")
    x = once(x, "_d", F.struct(lists("dimensions").alias("dims"), lists("attributes").alias("attrs"), F.map_entries(observed).alias("obs")))
    x = x.select(*keep, "_d", F.explode("_d.obs").alias("o")).filter("o.value[0] IS NOT NULL")
    at = F.transform(F.split("o.key", ":"), lambda p: p.try_cast("int"))
    coords = F.map_from_entries(F.transform("_d.dims", lambda d, i: F.struct(d["id"], F.get(d["codes"], F.get(at, i)))))
    attributes = F.map_from_entries(F.transform("_d.attrs", lambda d, i: F.struct(d["id"], F.get(d["codes"], F.get("o.value", i + 1).cast("int")))))
    return x.select(*keep, F.get("o.value", F.lit(0)).alias("value"), coords.alias("coords"), attributes.alias("attributes"))


def named(dimensions: Column, start: str) -> Column:
    """The name of a cube's first dimension that begins with ``start``, as time dimensions carry their unit."""
    return F.get(F.filter(F.map_keys(dimensions), lambda k: k.startswith(start)), F.lit(0))


def latest(cells: DataFrame, time: str) -> DataFrame:
    """The cells at the last position of the dimension that begins with ``time``, with its code as ``period``.

    Positions count, not codes, which need not sort as text; a last period without any value leaves no cells."""
    here = once(cells, "_time", named(F.col("at"), time))
    return here.filter(F.col("at")[F.col("_time")] == F.col("last")[F.col("_time")]).withColumn("period", F.col("coords")[F.col("_time")]).drop("_time")


def weekly_wages(cells: DataFrame, codes: DataFrame, time: str, sector: tuple[str, str], bucket: str, statistic: tuple[str, str], url: str, retrieved) -> DataFrame:
    """Benchmark rows of a cube of weekly wages by three wide buckets: each asked code takes its bucket's latest value, times 52.

    ``codes`` has isco_code; codes without bucket (armed forces, others) give no rows, nor does an empty list."""
    c = F.col("coords")
    newest = latest(cells.filter((c[sector[0]] == sector[1]) & (c[statistic[0]] == statistic[1])), time).select("value", "period", c[bucket].alias("bucket"))
    asked = codes.select("isco_code").distinct().withColumn("bucket", lookup.wage_bucket(F.col("isco_code")))
    # one cell per bucket of one cube
    rows = asked.join(F.broadcast(newest), "bucket")
    return _benchmark(rows, F.lit("IE"), F.lit("EUR"), F.col("value") * 52.0, "cso", url, retrieved)


def yearly_pay(cells: DataFrame, codes: list[str], countries: list[str], occupation: str, area: str, time: str, url: str, retrieved) -> DataFrame:
    """Benchmark rows of a cube of yearly pay by four-digit occupation ('OC' and the code) and country, latest period.

    Empty lists ask for everything. Of further dimensions, which the request has narrowed to one code, the first counts."""
    c = F.col("coords")
    code = F.regexp_extract(c[occupation], r"^OC(\d{4})$", 1)
    others = F.forall(F.map_entries("at"), lambda e: e["key"].isin(occupation, area) | e["key"].startswith(time) | (e["value"] == 0))
    rows = latest(cells.filter(others), time).select("value", "period", code.alias("isco_code"), F.upper(c[area]).alias("country")).filter("isco_code <> ''")
    return _benchmark(_asked(rows, codes, countries), F.col("country"), F.lit("EUR"), F.col("value"), "eurostat", url, retrieved)


def observed_pay(observations: DataFrame, codes: list[str], countries: list[str], url: str, retrieved) -> DataFrame:
    """Benchmark rows of SDMX observations, in the currency their UNIT_MEASURE names (EUR if none); occupations are ISCO08 or OCC."""
    c = F.col("coords")
    rows = observations.select("value", c["TIME_PERIOD"].alias("period"), F.coalesce(c["ISCO08"], c["OCC"]).alias("isco_code"), F.upper(c["REF_AREA"]).alias("country"), F.coalesce(F.col("attributes")["UNIT_MEASURE"], F.lit("EUR")).alias("unit")).filter("isco_code RLIKE '^[0-9]{4}$'")
    rows = _asked(rows, codes, countries)
    return _benchmark(rows, F.col("country"), F.col("unit"), F.col("value"), "oecd", url, retrieved)


def _asked(rows: DataFrame, codes: list[str], countries: list[str]) -> DataFrame:
    if codes:
        rows = rows.filter(F.col("isco_code").isin(*codes))
    if countries:
        rows = rows.filter(F.col("country").isin(*[c.upper() for c in countries]))
    return rows


def _benchmark(rows: DataFrame, country: Column, currency: Column, pay: Column, source: str, url: str, retrieved) -> DataFrame:
    none = F.lit(None)
    return rows.select(
        "isco_code", country.alias("country"), "period", currency.alias("currency"), pay.cast("double").alias("median_eur"), none.cast("double").alias("p25_eur"), none.cast("double").alias("p75_eur"),
        none.cast("bigint").alias("n_observations"), F.lit(source).alias("source"), F.lit(url).alias("source_url"), (retrieved if isinstance(retrieved, Column) else F.lit(retrieved)).cast("timestamp").alias("retrieved_at"),
    )
