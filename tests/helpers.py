"""Small frames and plan text."""


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i long, v {kind}")


def apply(spark, values, fn, kind="string"):
    """Values of a column function, in the order of the input."""
    df = column(spark, values, kind)
    return [r.out for r in df.select("i", fn(df.v).alias("out")).orderBy("i").collect()]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
