"""Named queries over the given tables, with SQL for the same result."""

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    """Register a function of (spark, sf_dir) under its own name."""

    def keep(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return keep
