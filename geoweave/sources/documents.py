"""JSON documents: caches, line files with a metadata line, exports, query results, offices; and their writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoweave.functions import geo, ids
from geoweave.functions.text import non_empty, office_name


def cache(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Places of one document ``{metadata, places: [...]}``; ``schema`` is a place's fields."""
    doc = spark.read.schema(f"metadata map<string,string>, places array<struct<{schema}>>").json(path, multiLine=True)
    return doc.select(F.inline("places"))


def lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of a line file; metadata lines are told by their field, never by their position."""
    df = spark.read.schema(f"metadata string, {schema}").json(path)
    return df.where("metadata is null").drop("metadata")


def array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of one JSON array."""
    return spark.read.schema(schema).json(path, multiLine=True)


def adjacency(spark: SparkSession, path: str) -> DataFrame:
    """(child, parent) of one object that maps children to lists of parents."""
    t = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,array<string>>").alias("m"))
    return t.select(F.explode("m").alias("child", "parents")).select("child", F.explode("parents").alias("parent")).distinct()


def bindings(spark: SparkSession, path: str, variables: list[str]) -> DataFrame:
    """Rows of query results in the standard JSON result format; unbound variables are null."""
    fields = ", ".join(f"`{v}` struct<value:string>" for v in variables)
    doc = spark.read.schema(f"results struct<bindings: array<struct<{fields}>>>").json(path, multiLine=True)
    return doc.select(F.inline("results.bindings")).select(*[F.col(v)["value"].alias(v) for v in variables])


def entity_columns(b: DataFrame) -> DataFrame:
    """Bindings to entity columns: URI tails, points, dates cut at T, lists split at bars."""
    has = set(b.columns)
    out = [ids.qid(F.col("item")).alias("qid")] if "item" in has else []
    if "coord" in has:
        at = geo.parse_point(F.col("coord"))
        out += [at["lat"].alias("latitude"), at["lon"].alias("longitude")]
    for v in b.columns:
        if v in ("item", "coord"):
            continue
        if v.endswith("Date"):
            out.append(F.substring_index(F.regexp_replace(v, r"^\++", ""), "T", 1).alias(v))
        elif v.endswith("Names"):
            out.append(F.filter(F.split(v, r"\|"), lambda x: x != "").alias(v))
        elif v.endswith("Qid"):
            out.append(ids.qid(F.col(v)).alias(v))
        else:
            out.append(non_empty(F.col(v)).alias(v))
    return b.select(*out)


def alt_labels(labels: DataFrame, languages: tuple[str, ...] = ("en", "fr", "")) -> DataFrame:
    """(qid, names) of the labels in the given languages, distinct and sorted."""
    return labels.where(F.col("lang").isin(*languages)).groupBy("qid").agg(F.sort_array(F.collect_set("label")).alias("names"))


# Date formats of the office register.
_DATES = ["yyyy-MM-dd", "yyyy/MM/dd", "MM/dd/yyyy", "d MMM yyyy", "MMMM d, yyyy", "yyyy"]


def offices(spark: SparkSession, path: str) -> DataFrame:
    """Post offices of a CSV register; unreadable dates are null."""
    raw = spark.read.csv(path, header=True, schema="IdNumber string, Name string, Province string, EstablishedDate string, ClosingDate string")
    day = lambda c: F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in _DATES])
    return raw.select(
        F.col("IdNumber").try_cast("bigint").alias("idNumber"), F.col("Name").alias("name"), F.col("Province").alias("province"),
        F.year(day("EstablishedDate")).alias("establishedYear"), F.year(day("ClosingDate")).alias("closingYear"), F.col("ClosingDate").isNull().alias("isOpen"), office_name(F.col("Name")).alias("normalizedName"),
    )


# ---- sinks


def write_lines(df: DataFrame, path: str, metadata: dict | None = None) -> None:
    """Compressed line files; metadata goes to a sidecar folder of its own."""
    df.write.mode("overwrite").json(path, compression="gzip")
    if metadata is not None:
        df.sparkSession.createDataFrame([({k: str(v) for k, v in metadata.items()},), ], "metadata map<string,string>").coalesce(1).write.mode("overwrite").json(f"{path.rstrip('/')}_metadata")


def write_document(df: DataFrame, path: str, name: str, metadata: dict) -> None:
    """One JSON document ``{metadata, name: [...]}``, for results that one reader takes whole.

    The records stream through one task line by line; nothing gathers them in memory.
    """
    meta = F.create_map(*[F.lit(str(x)) for kv in metadata.items() for x in kv]) if metadata else F.create_map().cast("map<string,string>")
    frame = df.sparkSession.range(2).select(
        (F.col("id") * 2).alias("ord"), F.when(F.col("id") == 0, F.concat(F.lit('{"metadata":'), F.to_json(meta), F.lit(f',"{name}":['))).otherwise("]}").alias("value")
    )
    rows = df.select(F.lit(1).cast("long").alias("ord"), F.to_json(F.struct(*df.columns)).alias("value")).unionByName(frame).repartition(1).sortWithinPartitions("ord")
    # Row 0 is the head, row 1 the first record; the row number stands first, so that every row counts.
    comma = F.when((F.monotonically_increasing_id() > 1) & (F.col("ord") == 1), ",").otherwise("")
    rows.select(F.concat(comma, "value").alias("value")).write.mode("overwrite").text(path)


def write_statements(df: DataFrame, label: str, path: str) -> None:
    """Graph creation statements, one node per line; nulls are left out."""
    inner = lambda j: F.substr(j, F.lit(2), F.length(j) - 2)
    lit = lambda c: F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}: "), inner(F.to_json(F.array(F.col(c))))))
    body = F.concat_ws(", ", *[lit(c) for c in df.columns])
    df.select(F.concat(F.lit(f"CREATE (:{label} {{"), body, F.lit("});")).alias("value")).write.mode("overwrite").text(path)


def partitioned(df: DataFrame, path: str, by: str) -> None:
    """A cache with one folder per value, so that single values can be replaced."""
    df.write.mode("overwrite").partitionBy(by).json(path, compression="gzip")


def migration_summary(flows: DataFrame, people: DataFrame, top: int = 20, samples: int = 5) -> DataFrame:
    """One row: totals, the largest cross-border flows and sample people, both in a fixed order."""
    cross = flows.where("birth <> death")
    head = cross.orderBy(F.col("n").desc(), "birth", "death").limit(top).agg(F.collect_list(F.struct("birth", "death", "n")).alias("top_flows"))
    total = flows.agg(F.sum("n").alias("total"), F.count_if(F.col("birth") != F.col("death")).alias("cross_border_pairs"), F.count_if(F.col("birth") == F.col("death")).alias("domestic_countries"), F.sum(F.when(F.col("birth") == F.col("death"), F.col("n"))).alias("domestic_people"))
    few = people.orderBy("personId").limit(samples).agg(F.collect_list("personId").alias("sample_people"))
    return total.join(F.broadcast(head)).join(F.broadcast(few))
