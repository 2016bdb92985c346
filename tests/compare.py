"""Compare registered queries with their SQL: names, types, values."""

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


SPARK_TYPE = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
}


def _sorted(rows):
    return sorted(rows, key=lambda row: [(v is not None, str(v)) for v in row])


def difference(spark, db, query, sql, sf_dir):
    """None when equal, else a short text."""
    got = query(spark, sf_dir)
    found = db.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(got.columns):
        return f"columns {sorted(got.columns)} but SQL has {sorted(names)}"
    wanted = {d[0]: SPARK_TYPE[str(d[1])] for d in found.description}
    types = {f.name: f.dataType.simpleString() for f in got.schema.fields}
    if wanted != types:
        return "types " + str({n: (types[n], wanted[n]) for n in names if types[n] != wanted[n]})
    order = sorted(names)
    actual = _sorted(tuple(row[c] for c in order) for row in got.collect())
    at = [names.index(c) for c in order]
    expected = _sorted(tuple(row[i] for i in at) for row in found.fetchall())
    if len(actual) != len(expected):
        return f"{len(actual)} rows but SQL has {len(expected)}"
    for mine, theirs in zip(actual, expected):
        if mine != theirs:
            return f"{order}\n  {mine}\n  {theirs}"
    return None
