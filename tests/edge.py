"""Tiny tables: empty ones, rows full of nulls, repeated rows, extra columns."""

from pathlib import Path

from pyspark.sql import functions as F

DATA = Path("/root/testdata/sf0.001")
TABLES = "place wikidataplace historicalperson personmatch placemention placeref country surveyzone documents evalitem mixtarget events embeddings".split()
KEYS = {"place": "geonameId", "wikidataplace": "qid", "historicalperson": "personId", "placemention": "mentionId", "placeref": "geonameId", "surveyzone": "zoneId", "documents": "doc_id", "evalitem": "item_id", "embeddings": "vec_id"}


def write(spark, folder, kind):
    for t in TABLES:
        df = spark.read.parquet(str(DATA / f"{t}.parquet"))
        if kind == "empty":
            df = df.limit(0)
        elif kind == "nulls":
            # A row with a key alone, one with nothing at all, and the first one twice.
            none = spark.createDataFrame([(1,), (1,), (2,)], "_n int").select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema], "_n")
            key = KEYS.get(t)
            if key:
                value = F.when(F.col("_n") == 1, F.lit("Q700000001" if t == "wikidataplace" else "raw:1" if t == "historicalperson" else "1").cast(df.schema[key].dataType))
                none = none.withColumn(key, value)
            df = none.drop("_n")
        else:
            few = df.limit(60)
            df = few.unionByName(few).withColumns({c: F.lit("x") for c in ("id", "lat", "line", "node", "total", "est", "h", "slice", "bucket", "value", "n") if c not in df.columns})
        df.write.mode("overwrite").parquet(f"{folder}/{t}.parquet")
    return str(folder)


def run(spark, folder, queries):
    return {name: f(spark, folder).count() for name, f in queries.items()}
